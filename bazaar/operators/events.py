"""Event aggregation and session ranking (survey 2.D1, 2.E1-E3, 2.L8, 2.F1/F3)."""
from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.columns import hour_floor
from bazaar.operators.profile import attach
from bazaar.operators.ranking import rank_within, row_number_within
from bazaar.sources.tables import export_parquet


def hour_of(ts_col: str = "ts"):
    """Floor to the hour, kept as timestamp_ntz (the input type), independent of the session zone."""
    return hour_floor(F.col(ts_col))


def modal_value(df: DataFrame, by: list, col: str, out: str | None = None) -> DataFrame:
    """Most frequent value per group (ties -> smallest value), for any number of values.

    Counts per (group, value) are partially aggregated, then ``min_by`` picks
    the winner per group - no per-group buffer of all distinct values.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*by).agg(
        F.min_by(col, F.struct(-F.col("__n"), F.col(col))).alias(out or f"mode_{col}"))


def hourly_metrics(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Sessions, unique users, mean duration and the modal device per hour.

    Rows are counted per (hour, device, user) first; everything rolls up from
    those counts, so neither a user's nor a device's rows meet in one task and
    no buffer grows with the number of devices.  Modal ties go to the smallest
    device name (N8).
    """
    ev = events.withColumn("hour", hour_of(ts_col))
    per = ev.groupBy("hour", "device_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("session_duration_minutes").alias("total"),
        F.count("session_duration_minutes").alias("timed"))
    hours = per.groupBy("hour").agg(
        F.sum("n").alias("session_count"), F.count_distinct("user_id").alias("unique_users"),
        F.try_divide(F.sum("total"), F.sum("timed")).alias("avg_session_duration"))
    devices = per.groupBy("hour", "device_type").agg(F.sum("n").alias("n")).where(F.col("device_type").isNotNull())
    modal = devices.groupBy("hour").agg(
        F.min_by("device_type", F.struct(-F.col("n"), F.col("device_type"))).alias("most_popular_device"))
    return hours.join(modal, "hour", "left")


def rank_sessions(events: DataFrame, action: str | None = "view", k: int | None = 10,
                  frame: str | None = None, partition_col: str = "device_type",
                  value_col: str = "session_duration_minutes", tiebreak: str = "event_id",
                  method: str = "row_number") -> DataFrame:
    """Rank sessions by duration within each device.

    With ``k`` this is the top-k report of the reference's query (the
    ``LIMIT`` becomes a per-device limit with a tie-break, N7); ``row_number
    <= k`` is planned with a partial WindowGroupLimit.  ``frame='rows'`` is
    the explicit ``ROWS UNBOUNDED PRECEDING`` dialect - the same rows.
    Without ``k`` every session is ranked with the range-partitioned
    numbering of :mod:`bazaar.operators.ranking`, so a device holding most
    of the traffic is spread over many tasks.
    """
    df = events
    if action is not None:
        df = df.where(F.col("action_type") == action)
    df = df.select(tiebreak, "user_id", partition_col, value_col)
    if k is not None:
        w = Window.partitionBy(partition_col).orderBy(F.col(value_col).desc(), F.col(tiebreak))
        if frame == "rows":
            w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
        return (df.withColumn("session_rank", fn().over(w)).where(F.col("session_rank") <= k)
                  .withColumn("session_rank", F.col("session_rank").cast("long")))
    return rank_within(df, [partition_col], [value_col], True, [tiebreak], method, "session_rank")


def session_rank_methods(events: DataFrame, action: str = "view") -> DataFrame:
    """row_number, rank and dense_rank of every session, side by side."""
    base = events.where(F.col("action_type") == action).select(
        "event_id", "user_id", "device_type", "session_duration_minutes")
    dur = F.col("session_duration_minutes")
    # row number in the device, then within equal durations: rank = rn - rn_tie + 1
    r = row_number_within(base, ["device_type"], [dur.desc_nulls_last(), F.col("event_id")], "row_number")
    r = row_number_within(r, ["device_type", "session_duration_minutes"], [F.col("event_id")], "__rn_tie")
    r = r.withColumn("rank", F.col("row_number") - F.col("__rn_tie") + 1).drop("__rn_tie")
    return rank_within(r, ["device_type"], ["session_duration_minutes"], True, ["event_id"],
                       "dense_rank", "dense_rank")


def order_events(events: DataFrame, ts_col: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """events in time order (only meaningful at the output)."""
    return events.orderBy(ts_col, tiebreak)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """a deterministic head (ordered limit)."""
    return df.orderBy(*order).limit(n)


# Compact storage types of the hourly export.
COMPACT_HOURLY = {"session_count": "bigint", "unique_users": "bigint",
                  "avg_session_duration": "float", "most_popular_device": "string"}


def compact_types(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Narrow column types by an explicit spec (Parquet dictionary-encodes strings)."""
    return df.select(*[F.col(c).cast(spec[c]).alias(c) if c in spec else F.col(c)
                       for c in df.columns])


def create_analytics_pipeline(events: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Aggregate -> compact types -> Parquet (partitioned by day) -> summary.

    Returns (exported hourly metrics read back, one-row summary).  ``path`` is a
    folder that all executors share.
    """
    spark = events.sparkSession
    hourly = compact_types(hourly_metrics(events), COMPACT_HOURLY).withColumn(
        "event_date", F.to_date("hour"))
    # one file per day: the hourly aggregate is tiny, so cluster it by day before the write
    export_parquet(hourly.repartition("event_date"), path, partition_by=["event_date"])
    exported = spark.read.parquet(path)
    span = events.agg(F.count(F.lit(1)).alias("rows_in"),
                      F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))
    out = exported.agg(F.count(F.lit(1)).alias("rows_out"))
    files = exported.select(F.col("_metadata.file_path").alias("f"),
                            F.col("_metadata.file_size").alias("s")).dropDuplicates(["f"])
    size = files.agg(F.count(F.lit(1)).alias("files_written"), F.sum("s").alias("bytes_written"))
    summary = attach(attach(span, out), size)
    return exported.drop("event_date"), summary
