import datetime as dt
import random

from pyspark.sql import functions as F

from bazaar.operators import cohorts as CO

COLS = "customer_id long, invoice_date timestamp_ntz, quantity int, price double"


def lines(spark, rows):
    return spark.createDataFrame([(c, d, 1, 2.0) for c, d in rows], COLS)


def test_windows_against_sets_of_days(spark):
    rng = random.Random(5)
    start = dt.datetime(1969, 10, 1)                       # days before and after 1970
    rows = [(c, start + dt.timedelta(days=rng.choice([0, 1, 2, 5, 62, 63, 64, 65, 127, 128, 129, 300]) + c, hours=rng.randrange(24)))
            for c in range(40) for _ in range(rng.randrange(1, 9))]
    rows += [(None, start), (3, None)]
    windows = [(0, 0), (1, 1), (63, 64), (64, 64), (1, 62), (62, 130), (65, 65), (2, None), (301, None), (0, None), (128, 128)]
    got = {(r.cohort_date, r.from_day, r.to_day): (r.cohort_size, r.active_customers)
           for r in CO.retention_windows(lines(spark, rows), windows).collect()}
    days = {}
    for c, d in rows:
        if c is not None and d is not None:
            days.setdefault(c, set()).add(d.date())
    want = {}
    for lo, hi in windows:
        for c, ds in days.items():
            first = min(ds)
            key = (first.replace(day=1), lo, hi)
            size, n = want.get(key, (0, 0))
            want[key] = (size + 1, n + any(lo <= (d - first).days <= (hi if hi is not None else 10 ** 6) for d in ds))
    assert got == want
    assert CO.retention_windows(lines(spark, []), windows).collect() == []


def test_heavy_customer_is_spread_by_its_count(spark):
    t = dt.datetime(2020, 1, 5)
    rows = [(7, t + dt.timedelta(minutes=i)) for i in range(4000)] + [(100 + i % 1000, t + dt.timedelta(days=i)) for i in range(8000)]
    df = lines(spark, rows)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = CO.assign_cohort(df, shares=12, least=10)
        tasks = {r[0]: r[1] for r in out.where("customer_id = 7").groupBy(F.spark_partition_id()).count().collect()}
        assert sum(tasks.values()) == 4000 and out.count() == 12000
        assert len(tasks) >= 2 and max(tasks.values()) <= 3000          # 4 shares over 4 tasks
        plain = df.groupBy("customer_id").agg(F.min("invoice_date").alias("f"))
        assert out.join(plain, "customer_id").where("first_purchase_date <> f").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_first_purchases_from_lines_before_duplicates_were_dropped(spark):
    from bazaar.operators import cleaning as CL

    t = dt.datetime(2020, 3, 1)
    rows = [(f"i{i}", c, t + dt.timedelta(days=40 * (i % 3) + c), 1, 2.0) for c in range(5) for i in range(12)]
    rows += [("n", None, t, 1, 2.0), ("z", 0, t, 1, 2.0), ("q", 3, t - dt.timedelta(days=90), -1, 2.0)]
    raw = spark.createDataFrame(rows, "invoice string, customer_id long, invoice_date timestamp_ntz, quantity int, price double").repartition(3)
    lines, bought = CL.clean_retention(raw), CL.retention_purchases(raw)
    key = ["customer_id", "invoice_date"]
    plain = CO.assign_cohort(lines, shares=12, least=2).orderBy(*key).collect()
    got = CO.assign_cohort(lines, shares=12, least=2, purchases=bought).orderBy(*key).collect()
    assert got == plain and len(got) == 12 and bought.count() == 48          # four customers, three dates, each four times
    only = CO.assign_cohort(lines, purchases=bought.where("customer_id = 2"))      # it is these lines that are read for the dates
    assert {(r.customer_id, r.first_purchase_date) for r in only.collect()} == {(2, t + dt.timedelta(days=2))}
