"""Plan-shape tests: the scale properties the operators rely on."""
import datetime as dt

from pyspark.sql import functions as F

from bazaar.functions.columns import hour_floor, week_start
from bazaar.operators import profile as P
from bazaar.operators import ranking as R
from bazaar.operators.events import rank_sessions
from bazaar.sources import fixtures as X

from tests.paths import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_spread_over_tasks(spark):
    # one group holds every row: the numbering must still run in many partitions
    df = spark.range(0, 20000).withColumn("g", F.lit("hot")).withColumn("v", (F.col("id") * 37) % 1001)
    ranked = R.row_number_within(df, ["g"], [F.col("v"), F.col("id")], "rn", num_partitions=8)
    per_task = ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 6 and max(r["count"] for r in per_task) < 20000 / 2
    assert ranked.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (1, 20000, 20000)


def test_exact_quantiles_single_hot_group_many_partitions(spark):
    df = spark.range(0, 9999).withColumn("v", ((F.col("id") * 7919) % 9973).cast("double"))
    got = {r.prob: r.quantile for r in R.exact_quantiles(df, "v", [0.1, 0.5, 0.99], num_partitions=7).collect()}
    want = df.agg(F.percentile("v", [0.1, 0.5, 0.99]).alias("p")).first().p
    assert [got[0.1], got[0.5], got[0.99]] == want


def test_quantiles_do_not_use_percentile_buffers(spark):
    df = spark.range(0, 1000).withColumn("v", F.col("id").cast("double"))
    plan = _plan(P.iqr_bounds(df, ["v"]))
    assert "percentile(" not in plan.lower()


def test_top_k_ranking_limits_before_shuffle_and_pushes_filter(spark):
    df = rank_sessions(X.user_events(spark, SF_SMALL), k=10)
    plan = _plan(df)
    assert plan.count("WindowGroupLimit") >= 2       # partial (map side) + final
    assert "EqualTo(event_type,view)" in plan


def test_dedup_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 2, "a")], "k long, t long, s string")
    plan = _plan(R.dedup_first(df, ["k"], ["t"]))
    assert "Window" not in plan and "Aggregate" in plan


def test_time_buckets_ignore_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),), (dt.datetime(2024, 1, 7, 23, 5),)],
                               "ts timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = df.select(hour_floor(F.col("ts")).alias("h"), week_start(F.col("ts")).alias("w")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0].h == dt.datetime(2024, 3, 10, 2, 0) and got[0].w == dt.datetime(2024, 3, 4)
    assert got[1].h == dt.datetime(2024, 1, 7, 23, 0) and got[1].w == dt.datetime(2024, 1, 1)
