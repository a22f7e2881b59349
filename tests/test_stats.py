import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from bazaar.functions import stats as ST

N = statistics.NormalDist()


def test_normal_tail_and_ppf_match_reference_values(spark):
    zs = [-3.0, -1.0, 0.0, 0.5, 1.959963984540054, 2.127016, 4.0]
    ps = [1e-6, 0.001, 0.025, 0.2, 0.5, 0.8, 0.975, 0.999]
    df = spark.createDataFrame([(z, p) for z, p in zip(zs + [0.0] * 8, ps + [0.5] * 7)], "z double, p double")
    rows = df.select("z", "p", ST.norm_sf("z").alias("sf"), ST.norm_ppf("p").alias("x")).collect()
    for r in rows:
        assert r.sf == pytest.approx(1 - N.cdf(r.z), abs=1e-12)
        assert r.x == pytest.approx(N.inv_cdf(r.p), abs=1e-9)


def test_t_tail_known_value(spark):
    row = spark.range(1).select(ST.t_sf(F.lit(2.0), F.lit(10.0)).alias("p"),
                                ST.t_sf(F.lit(-2.0), F.lit(10.0)).alias("q"),
                                ST.t_sf(F.lit(1.0), F.lit(1.0)).alias("cauchy")).first()
    assert row.p == pytest.approx(0.0366940173853702, abs=1e-9)
    assert row.q == pytest.approx(1 - 0.0366940173853702, abs=1e-9)
    assert row.cauchy == pytest.approx(0.25, abs=1e-9)


def test_sql_text_agrees_with_spark():
    con = duckdb.connect()
    got = con.execute(f"SELECT {ST.sql_norm_sf('2.127016')}, {ST.sql_norm_ppf('0.975')}, "
                      f"{ST.sql_t_sf('2.0', '10.0')}").fetchone()
    assert got[0] == pytest.approx(1 - N.cdf(2.127016), abs=1e-12)
    assert got[1] == pytest.approx(N.inv_cdf(0.975), abs=1e-10)
    assert got[2] == pytest.approx(0.0366940173853702, abs=1e-9)


def test_f_tail_known_values(spark):
    # d1 = 2: P(F > f) = (1 + 2 f / d2) ** (-d2 / 2) exactly
    cases = [(1.5, 2.0, 10.0), (3.0, 2.0, 40.0), (0.7, 2.0, 5000.0), (4.0, 2.0, 3.0)]
    df = spark.createDataFrame(cases, "f double, d1 double, d2 double")
    for r in df.select("f", "d1", "d2", ST.f_sf("f", "d1", "d2").alias("p")).collect():
        assert r.p == pytest.approx((1 + 2 * r.f / r.d2) ** (-r.d2 / 2), rel=1e-7, abs=1e-12)
    # F(1, nu) = T(nu)^2: P(F > t^2) = 2 P(T > t); d1 = 4 against the closed form for even d1
    row = spark.range(1).select(ST.f_sf(F.lit(2.5), F.lit(4.0), F.lit(12.0)).alias("p")).first()
    x = 12.0 / (12.0 + 4.0 * 2.5)           # P(F > f) = I_x(6, 2) = x^6 (1 + 6 (1 - x))
    assert row.p == pytest.approx(x ** 6 * (1 + 6 * (1 - x)), rel=1e-8)


def test_log_factorial(spark):
    import math
    df = spark.createDataFrame([(m,) for m in (0, 1, 2, 5, 9, 10, 11, 50, 1000)], "m long")
    for r in df.select("m", ST.log_factorial("m").alias("lf")).collect():
        assert r.lf == pytest.approx(math.lgamma(r.m + 1), abs=1e-10)


def test_tails_keep_their_precision(spark):
    import math
    zs = [0.0, 0.3, 2.5, 8.0, 20.0, 37.0, 40.0, 3000.0, -8.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(ST.norm_sf("z")).collect()]
    for z, p in zip(zs, got):
        want = 0.5 * math.erfc(z / math.sqrt(2))
        assert p >= 0 and abs(p - want) <= 1e-10 * want
    # closed forms: Cauchy and two degrees of freedom; no jump between large degrees of freedom
    cases = [(2.0, 1.0, 0.5 - math.atan(2) / math.pi), (3.0, 2.0, 0.5 * (1 - 3 / math.sqrt(11))),
             (1e6, 2.0, 0.5 * (1 - 1e6 / math.sqrt(2 + 1e12)))]
    rows = spark.createDataFrame([c[:2] for c in cases], "t double, n double").select(ST.t_sf("t", "n")).collect()
    for (_, _, want), r in zip(cases, rows):
        assert abs(r[0] - want) <= 1e-4 * want if want < 1e-10 else abs(r[0] - want) <= 1e-10 * want
    ns = [10.0 ** (k / 4) for k in range(12, 37)]
    ts = [r[0] for r in spark.createDataFrame([(n,) for n in ns], "n double").select(ST.t_sf(F.lit(2.0), "n")).collect()]
    assert all(a > b for a, b in zip(ts, ts[1:])) and abs(ts[-1] - 0.5 * math.erfc(math.sqrt(2))) < 1e-9
    # F with one numerator degree is t squared
    r = spark.range(1).select(ST.f_sf(F.lit(81.0), F.lit(1.0), F.lit(30.0)), 2 * ST.t_sf(F.lit(9.0), F.lit(30.0))).first()
    assert r[0] == pytest.approx(r[1], rel=1e-10)


def test_no_loops_in_expressions_for_data_rows(spark):
    df = spark.range(1).select(ST.norm_sf(F.lit(1.0)).alias("a"), ST.norm_ppf(F.col("id") / 2.0).alias("b"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" not in plan and "transform(" not in plan
    grid = [k / 997 for k in range(1, 997)] + [10.0 ** -k for k in range(4, 300, 5)]
    for r in spark.createDataFrame([(p,) for p in grid], "p double").select("p", ST.norm_ppf("p").alias("x")).collect():
        assert r.x == pytest.approx(N.inv_cdf(r.p), rel=1e-13, abs=1e-15)


def test_t_and_f_against_closed_forms(spark):
    import math
    # even degrees of freedom: P(|T| < t) is a finite sum (Abramowitz and Stegun 26.7.4)
    def upper(t, nu):
        theta, term, total = math.atan(t / math.sqrt(nu)), 1.0, 1.0
        for k in range(2, nu - 1, 2):
            term *= (k - 1) / k * math.cos(theta) ** 2
            total += term
        return 0.5 * (1 - math.sin(theta) * total)
    cases = [(t, n) for t in (0.1, 1.0, 1.7, 1.74, 2.5, 4.0) for n in (2, 4, 10, 50, 400)]
    rows = spark.createDataFrame([(t, float(n)) for t, n in cases], "t double, n double").select(ST.t_sf("t", "n").alias("p")).collect()
    for (t, n), r in zip(cases, rows):
        assert r.p == pytest.approx(upper(t, n), rel=1e-9, abs=1e-13)
    # F(f; d1, d2) = 1 - F(1 / f; d2, d1)
    cases = [(f, a, b) for f in (0.3, 0.97, 1.02, 1.4) for a, b in ((3.0, 7.5), (50.0, 2000.0), (900.0, 40.0), (1e5, 1e5))]
    rows = spark.createDataFrame(cases, "f double, a double, b double").select(
        (ST.f_sf("f", "a", "b") + ST.f_sf(1 / F.col("f"), "b", "a")).alias("one")).collect()
    assert all(r.one == pytest.approx(1.0, abs=1e-10) for r in rows)
