import os
import tempfile

from pyspark.sql import functions as F

from bazaar.operators import events as E
from bazaar.sources import fixtures as X
from bazaar.streaming import hourly as S

from tests.paths import SF_SMALL


def test_stream_matches_batch_on_closed_windows(spark):
    work = tempfile.mkdtemp(prefix="bazaar-stream-")
    src = os.path.join(work, "events")
    ue = X.user_events(spark, SF_SMALL)
    (ue.withColumn("day", F.to_date("ts")).repartition("day")
       .write.partitionBy("day").parquet(src))
    stream = S.read_event_stream(spark, src)
    out = os.path.join(work, "out")
    S.run_available_now(S.hourly_metrics_stream(stream), out, os.path.join(work, "ckpt"))
    got = {r.hour: r for r in spark.read.parquet(out).collect()}
    batch = {r.hour: r for r in E.hourly_metrics(ue).collect()}
    assert got, "no closed windows emitted"
    assert set(got) <= set(batch)
    # the newest windows are held back until the watermark passes them
    assert len(batch) - len(got) <= 2
    for h, r in got.items():
        b = batch[h]
        assert r.session_count == b.session_count
        assert abs(r.avg_session_duration - b.avg_session_duration) < 1e-9
        assert r.most_popular_device == b.most_popular_device
        assert abs(r.unique_users_approx - b.unique_users) <= max(2, 0.05 * b.unique_users)


def test_exact_users_over_many_batches(spark):
    """Files that arrive hour by hour: users who come back in later batches of an hour count once."""
    import datetime as dt
    work = tempfile.mkdtemp(prefix="bazaar-stream-")
    src = os.path.join(work, "events")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, i * 7 % 5 if i % 11 else None, t0 + dt.timedelta(minutes=7 * i), ["tv", "phone", "desk"][i % 3], "view", float(i)) for i in range(120)]
    for k in range(0, 120, 4):                       # 28 minutes a file
        part = rows[k:k + 4] + rows[k:k + 1]         # and one row twice
        spark.createDataFrame(part, S.USER_EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = os.path.join(work, "out")
    stream = S.read_event_stream(spark, src, max_files_per_trigger=1)
    S.run_available_now(S.hourly_metrics_exact_stream(stream), out, os.path.join(work, "ckpt"))
    got = {r.hour: (r.session_count, r.unique_users, r.avg_session_duration, r.most_popular_device) for r in spark.read.parquet(out).collect()}
    batch = {r.hour: (r.session_count, r.unique_users, r.avg_session_duration, r.most_popular_device)
             for r in E.hourly_metrics(spark.read.parquet(src)).collect()}
    last = max(r[2] for r in rows) - dt.timedelta(hours=1)
    closed = {h: v for h, v in batch.items() if h + dt.timedelta(hours=1) <= last}
    assert got == closed and len(got) >= 10


def test_delay_below_the_window_is_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        S.hourly_metrics_exact_stream(spark.createDataFrame([], S.USER_EVENTS_SCHEMA), 0)
