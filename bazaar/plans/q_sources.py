"""Registered queries of the scans."""
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.operators import incremental as I
from bazaar.plans.registry import finish, query
from bazaar.session import ensure_checkpoint_dir, materialize
from bazaar.sources import fixtures as X
from bazaar.sources import tables as S

_ORDER_FILE = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("order_date", T.DateType())])


@query("csv_quarantine")
def csv_quarantine(spark, sf):
    """A1-A3: orders written as text, some lines spoilt by rule, read back with the malformed ones set aside."""
    o = S.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    amount = F.concat(F.col("o_totalprice").cast("string"), F.when(key % 97 == 0, F.lit("x")).otherwise(F.lit("")))
    date = F.when(key % 83 == 7, F.lit("1995-13-40")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = [key.cast("string"), F.col("o_custkey").cast("string"), F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit(',"')), amount, date]
    line = F.when(key % 89 == 5, F.concat_ws(",", *fields[:4])).when(key % 71 == 3, F.concat_ws(",", *fields, F.lit("more"))) \
            .otherwise(F.concat_ws(",", *fields))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/orders-{uuid.uuid4().hex}"
    o.select(F.col("o_orderpriority").alias("arm"), line.alias("value")).write.partitionBy("arm").text(path)
    rows, rejects = S.read_checked(spark, path, _ORDER_FILE, header=False, date_format="yyyy-MM-dd")
    sums = rows.groupBy("arm").agg(F.round(F.sum("amount"), 2).alias("amount"))
    return S.rejects_by(rows, rejects, ["arm"]).join(sums, "arm", "left")


@query("incremental_export")
def incremental_export(spark, sf):
    """The event export without its newest day, then brought up to date: one folder is written."""
    ue = X.user_events(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/incremental-{uuid.uuid4().hex}"
    newest = ue.agg(F.to_date(F.max("ts"))).first()[0]
    I.export_changed_days(ue.where(F.to_date("ts") < F.lit(newest)), path)
    return I.export_changed_days(ue, path)


@query("merged_profile")
def merged_profile(spark, sf):
    """Order columns from sketches stored per month, with a check of each estimate against the exact values."""
    o = S.table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority", F.trunc("o_orderdate", "MM").alias("month"))
    cols = ["o_custkey", "o_totalprice", "o_orderpriority"]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/sketches-{uuid.uuid4().hex}"
    I.profile_sketches(o, cols, by=["month"]).write.partitionBy("month").parquet(path)
    merged = materialize(I.merge_profiles(spark.read.parquet(path)))
    # ranks of the estimated quantiles, and the distinct values, in the table itself
    long = o.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    exact = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")).join(merged, "column_name")
    x, probs = F.expr("try_cast(value AS double)"), {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    sums = [F.sum(F.when(x < F.col(q), F.col("n")).otherwise(0)).alias(f"below_{q}") for q in probs] \
        + [F.sum(F.when(x <= F.col(q), F.col("n")).otherwise(0)).alias(f"upto_{q}") for q in probs]
    ranks = exact.groupBy("column_name").agg(F.count("value").alias("values"), *sums)
    j = merged.join(ranks, "column_name")
    near = F.lit(True)
    for q, p in probs.items():
        near = near & ((F.col(f"below_{q}") / F.col("count")) <= p + I.RANK_ERROR) & ((F.col(f"upto_{q}") / F.col("count")) >= p - I.RANK_ERROR)
    return finish(j.select(
        "column_name", "total", "nulls", "count", "mean", "std", "min", "max",
        (F.abs(F.col("distinct") - F.col("values")) <= F.greatest(F.col("values") * I.DISTINCT_ERROR, F.lit(1))).alias("distinct_within_error"),
        F.when(F.col("mean").isNull(), F.lit(True)).otherwise(near).alias("quantiles_within_error")))
