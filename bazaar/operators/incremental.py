"""Work that only touches the days that changed (survey 2.L8, 2.A8) and profiles that merge (2.D17, 2.D18, 2.D23).

Export: a manifest keeps, per day, the number of source rows and a checksum of
them.  A rerun compares, computes the metrics of the days that differ and
overwrites only their folders (dynamic partition overwrite).

Profiles: per day and column a row of mergeable values - counts, moments,
extremes, an HLL sketch of the distinct values and a KLL sketch of the
quantiles, as binary columns.  A profile of any span is a merge of its rows,
so a new day costs one pass over that day.  Counts, moments and extremes are
exact, distincts and quantiles are estimates with stated errors; the exact
forms in :mod:`bazaar.operators.profile` stay the default.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from bazaar.functions.columns import ratio
from bazaar.operators.events import COMPACT_HOURLY, compact_types, hourly_metrics
from bazaar.operators.profile import attach
from bazaar.session import materialize

DAY = "event_date"


# ---- export of changed days ------------------------------------------------------

def day_checksums(events: DataFrame, ts: str = "ts") -> DataFrame:
    """(event_date, rows, checksum): rows of a day and the sum of their hashes, whatever their order.  Rows without a time have no day."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(events.columns)]).cast("decimal(38,0)")
    return (events.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias(DAY))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row).cast("string").alias("checksum")))


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def export_changed_days(events: DataFrame, path: str, ts: str = "ts") -> DataFrame:
    """L8 again and again: bring the hourly export below ``path`` up to date with ``events``; a one-row summary.

    Days whose rows or checksum differ from the manifest are computed anew and
    only their folders are overwritten; folders of days that no longer have
    rows are removed.  The manifest is written last: a run that dies before
    leaves days that the next run finds changed and writes again, so a repeat
    never loses or doubles an hour.  ``path`` is a folder that all executors
    share; one run at a time.
    Returns days (in the export), days_written, days_kept, days_removed, hours_written.
    """
    spark = events.sparkSession
    metrics, manifest = f"{path}/metrics", f"{path}/manifest"
    now = materialize(day_checksums(events, ts))
    if _exists(spark, manifest):
        before = spark.read.schema(f"rows bigint, checksum string, {DAY} date").parquet(manifest)
    else:
        before = now.limit(0)
    both = now.alias("n").join(before.alias("b"), DAY, "full").select(
        DAY, F.col("n.rows").alias("rows"), F.col("n.checksum").alias("checksum"), F.col("b.rows").alias("old"),
        (F.col("n.rows").eqNullSafe(F.col("b.rows")) & F.col("n.checksum").eqNullSafe(F.col("b.checksum"))).alias("same"))
    both = materialize(both)                                  # one row per day; the manifest read here is overwritten below
    changed = both.where(~F.col("same") & F.col("rows").isNotNull()).select(DAY)
    part = events.withColumn(DAY, F.to_date(ts)).join(changed, DAY, "left_semi")
    hourly = compact_types(hourly_metrics(part, ts), COMPACT_HOURLY).withColumn(DAY, F.to_date("hour"))

    def overwrite(df: DataFrame, to: str):
        df.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(to)

    overwrite(hourly, metrics)
    removed = [r[0] for r in both.where(F.col("rows").isNull()).select(F.date_format(DAY, "yyyy-MM-dd")).collect()]
    for root in (metrics, manifest):                          # at most one folder per day of the calendar
        for day in removed:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{DAY}={day}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    overwrite(both.where(~F.col("same") & F.col("rows").isNotNull()).select("rows", "checksum", DAY), manifest)
    written = spark.read.schema(f"hour timestamp_ntz, {DAY} date").parquet(metrics).join(changed, DAY, "left_semi")
    counts = both.agg(F.count("rows").alias("days"), F.count_if(~F.col("same") & F.col("rows").isNotNull()).alias("days_written"),
                      F.count_if("same").alias("days_kept"), F.count_if(F.col("rows").isNull()).alias("days_removed"))
    return attach(counts, written.agg(F.count(F.lit(1)).alias("hours_written")))


# ---- profiles that merge ----------------------------------------------------------

HLL_BITS, KLL_SIZE = 14, 800
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)       # relative, three standard errors
RANK_ERROR = 0.01                                     # of a quantile, in ranks


def profile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, total, n, mean, m2, low, high, values_hll, quantiles_kll): one mergeable row per group and column.

    Numeric columns have moments, extremes and quantiles; all have counts and
    distinct values (as text).  One pass: every column is an array element of
    the same aggregate.
    """
    out = []
    for c in cols:
        number = isinstance(df.schema[c].dataType, NumericType)
        x = F.col(f"`{c}`").cast("double") if number else F.lit(None).cast("double")
        out.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("total"), F.count(F.col(f"`{c}`")).alias("n"),
            F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high"),
            F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), HLL_BITS).alias("values_hll"),
            F.kll_sketch_agg_double(x, KLL_SIZE).alias("quantiles_kll")))
    return df.groupBy(*by).agg(F.array(*out).alias("__p")).select(*by, F.explode("__p").alias("__p")).select(*by, "__p.*")


def merge_profiles(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """D17/D18/D23 from stored sketches: counts, moments and extremes exact, distincts and quantiles estimated.

    The distinct estimate is within ``DISTINCT_ERROR`` of the truth (relative)
    and a quantile's rank within ``RANK_ERROR``, with more than 99 % certainty each.
    """
    w = Window.partitionBy(*by, "column_name")          # one row per stored part
    rows = sketches.withColumn("__all", F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(w)) \
                   .withColumn("__mean", F.try_divide(F.sum(F.col("n") * F.col("mean")).over(w), F.col("__all")))
    m2 = F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__mean"), F.lit(2.0)))
    merged = rows.groupBy(*by, "column_name").agg(
        F.sum("total").alias("total"), F.sum("n").alias("count"), F.max("__mean").alias("mean"), m2.alias("__m2"),
        F.min("low").alias("min"), F.max("high").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("values_hll")).alias("distinct"),
        F.kll_merge_agg_double("quantiles_kll").alias("__k"))
    std = F.when(F.col("mean").isNotNull() & (F.col("count") > 1), F.sqrt(F.col("__m2") / (F.col("count") - 1)))
    qs = [F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("__k", F.lit(float(p)))).alias(f"q{round(p * 100)}") for p in probs]
    return merged.select(*by, "column_name", "total", (F.col("total") - F.col("count")).alias("nulls"), "count",
                         F.bround(ratio(F.col("total") - F.col("count"), F.col("total")) * 100, 2).alias("null_pct"),
                         "distinct", "mean", std.alias("std"), "min", *qs, "max")
