import uuid

from bazaar.operators import events as E
from bazaar.plans.registry import finish, query
from bazaar.session import ensure_checkpoint_dir
from bazaar.sources import fixtures as X
from bazaar.sources.tables import table_stream
from bazaar.streaming import hourly as ST


@query("hourly_metrics")
def hourly_metrics(spark, sf):
    return finish(E.hourly_metrics(X.user_events(spark, sf)))


@query("session_rank_ansi")
def session_rank_ansi(spark, sf):
    return finish(E.rank_sessions(X.user_events(spark, sf), k=10))


@query("session_rank_rows_frame")
def session_rank_rows_frame(spark, sf):
    return finish(E.rank_sessions(X.user_events(spark, sf), k=10, frame="rows"))


@query("session_rank_full")
def session_rank_full(spark, sf):
    return finish(E.session_rank_methods(X.user_events(spark, sf)))


def _export_path(spark, name="hourly_metrics"):
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


@query("hourly_metrics_export")
def hourly_metrics_export(spark, sf):
    return E.create_analytics_pipeline(X.user_events(spark, sf), _export_path(spark))[0]


@query("pipeline_summary")
def pipeline_summary(spark, sf):
    """L8 summary: rows in and out and the time span."""
    _, summary = E.create_analytics_pipeline(X.user_events(spark, sf), _export_path(spark))
    return summary.select("rows_in", "rows_out", "first_event", "last_event")


@query("pipeline_files")
def pipeline_files(spark, sf):
    """L8 summary: files and bytes written (rows-only check)."""
    _, summary = E.create_analytics_pipeline(X.user_events(spark, sf), _export_path(spark))
    return summary.select("files_written", "bytes_written")


@query("hourly_metrics_stream")
def hourly_metrics_stream(spark, sf):
    """The event table read as a stream to its end; the hours that the watermark has closed, exact users."""
    events = table_stream(spark, sf, "events")
    ue = X.user_events_of(events)
    out = _export_path(spark, "hourly_stream")
    ST.run_available_now(ST.hourly_metrics_exact_stream(ue), f"{out}/rows", f"{out}/state")
    return finish(spark.read.parquet(f"{out}/rows"))
