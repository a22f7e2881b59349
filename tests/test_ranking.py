import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaar.operators import ranking


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None, "d"])
        rows.append((i, g, rnd.choice([1.0, 2.0, 2.0, 3.5, None, 7.0, float(rnd.randint(0, 50))])))
    return spark.createDataFrame(rows, "id long, g string, v double")


def _expected(df, method):
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
    order = [F.col("v").desc_nulls_last()] + ([F.col("id")] if method == "row_number" else [])
    w = Window.partitionBy("g").orderBy(*order)
    return {r.id: r.r for r in df.select("id", fn().over(w).alias("r")).collect()}


def test_row_number_matches_window(spark):
    df = _frame(spark).repartition(5)
    got = ranking.rank_within(df, ["g"], ["v"], True, ["id"], "row_number", "r", num_partitions=7)
    assert {r.id: r.r for r in got.collect()} == _expected(df, "row_number")


def test_rank_and_dense_rank_match_window(spark):
    df = _frame(spark, 2000, 3)
    for method in ("rank", "dense_rank"):
        got = ranking.rank_within(df, ["g"], ["v"], True, ["id"], method, "r", num_partitions=6)
        assert {r.id: r.r for r in got.collect()} == _expected(df, method), method


def test_global_row_number_single_group(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 1000)
    got = ranking.row_number_within(df, [], [F.col("v"), F.col("id")], "rn", num_partitions=9)
    exp = df.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rn"))
    assert sorted(got.select("id", "rn").collect()) == sorted(exp.collect())


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    q = {r.prob: r.quantile for r in ranking.exact_quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 3.25}


def test_exact_quantiles_by_group_matches_percentile(spark):
    df = _frame(spark, 2500, 11).where(F.col("g").isNotNull())
    got = {(r.g, r.prob): round(r.quantile, 9)
           for r in ranking.exact_quantiles(df, "v", [0.1, 0.25, 0.9], by=["g"], num_partitions=5).collect()}
    exp = df.groupBy("g").agg(F.percentile("v", [0.1, 0.25, 0.9]).alias("p")).collect()
    want = {(r.g, p): round(v, 9) for r in exp for p, v in zip([0.1, 0.25, 0.9], r.p)}
    assert got == want


def test_dedup_first_and_duplicates(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 5, "b"), (2, 7, "c"), (2, 7, "c"), (3, 1, "d")],
                               "k long, t long, s string")
    first = {r.k: r.s for r in ranking.dedup_first(df, ["k"], ["t"]).collect()}
    assert first == {1: "b", 2: "c", 3: "d"}
    d = ranking.duplicate_rows(df).collect()
    assert len(d) == 2 and all(r.dup_count == 2 for r in d)


def test_top_per_group_uses_group_limit(spark):
    df = _frame(spark, 500, 5)
    top = ranking.top_per_group(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.groupBy("g").count().where("count > 3").count() == 0
