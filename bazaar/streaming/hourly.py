"""Hourly event metrics as a Structured Streaming query.

The batch twin is :func:`bazaar.operators.events.hourly_metrics`.  A stream
refuses the exact distinct count, so there are two forms: ``approx_count_distinct``
(HyperLogLog++, bounded state per window), or exact counts by two chained
stateful operators (a de-duplication of (hour, user) within the watermark, then
the window count).  The watermark bounds the state: a window is emitted
(append mode) once the watermark passes its end, and later rows for it are
dropped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("device_type", T.StringType()),
    T.StructField("action_type", T.StringType()), T.StructField("session_duration_minutes", T.DoubleType())])


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType = USER_EVENTS_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet directory as an event stream with a fixed schema."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def hourly_metrics_stream(events: DataFrame, watermark: str = "1 hour", rsd: float = 0.01) -> DataFrame:
    """Tumbling one-hour windows: sessions, approx unique users, mean duration, modal device."""
    ev = events.withColumn("ts", F.col("ts").cast("timestamp"))   # watermarks need timestamp (not _ntz)
    agg = (ev.withWatermark("ts", watermark)
             .groupBy(F.window("ts", "1 hour"))
             .agg(F.count(F.lit(1)).alias("session_count"),
                  F.approx_count_distinct("user_id", rsd).alias("unique_users_approx"),
                  F.avg("session_duration_minutes").alias("avg_session_duration"),
                  F.mode("device_type", deterministic=True).alias("most_popular_device")))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "session_count",
                      "unique_users_approx", "avg_session_duration", "most_popular_device")


def hourly_metrics_exact_stream(events: DataFrame, delay_hours: int = 1) -> DataFrame:
    """Tumbling one-hour windows: sessions, exact unique users, mean duration, modal device.

    The first row of every (hour, user) passes a de-duplication within the
    watermark and counts one user; all rows count the rest.  Both go through one
    window aggregate.  The de-duplication forgets a pair ``delay_hours`` after
    its first row; as that is no less than the hour, a row that could still find
    the pair forgotten is late and dropped.  Null users count no user, as in
    the batch twin; null times are in no window.
    """
    if delay_hours < 1:
        raise ValueError("delay_hours: at least the hour of a window")
    ev = (events.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "device_type", "session_duration_minutes")
          .where(F.col("ts").isNotNull()).withWatermark("ts", f"{delay_hours} hours"))
    users = (ev.where(F.col("user_id").isNotNull()).withColumn("hour", F.date_trunc("HOUR", "ts"))
             .dropDuplicatesWithinWatermark(["hour", "user_id"])
             .select("ts", F.lit(1).alias("user"), F.lit(None).cast("string").alias("device_type"),
                     F.lit(None).cast("double").alias("session_duration_minutes")))
    rows = ev.select("ts", F.lit(0).alias("user"), "device_type", F.col("session_duration_minutes").cast("double"))
    agg = (rows.unionByName(users).groupBy(F.window("ts", "1 hour"))
           .agg(F.count_if(F.col("user") == 0).alias("session_count"), F.sum("user").alias("unique_users"),
                F.avg("session_duration_minutes").alias("avg_session_duration"),
                F.mode("device_type", deterministic=True).alias("most_popular_device")))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "session_count", "unique_users",
                      "avg_session_duration", "most_popular_device")


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str) -> None:
    """Drain everything available into Parquet (exactly-once file sink) and stop."""
    q = (df.writeStream.outputMode("append").format("parquet")
           .option("path", sink_path).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
