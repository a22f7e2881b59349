"""Registered queries of single operators and of the segment follow-ups."""
import uuid

from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.operators import cohorts as CO
from bazaar.operators import events as E
from bazaar.operators import experiments as X1
from bazaar.operators import profile as P
from bazaar.operators import segments as S
from bazaar.plans.q_segments import _all_segments
from bazaar.plans.registry import AS_OF, finish, query
from bazaar.sources import fixtures as X
from bazaar.sources.tables import register

DEVICE_CLASS = {"smart_tv": "large", "desktop": "large", "tablet": "small"}     # mobile has no entry: NULL


@query("device_classes")
def device_classes(spark, sf):
    """Sessions per mapped device label; unmapped devices are NULL."""
    return CL.map_labels(X.user_events(spark, sf), "device_type", DEVICE_CLASS, "device_class").groupBy(
        "device_class").agg(F.count(F.lit(1)).alias("sessions"))


@query("countries_by_revenue")
def countries_by_revenue(spark, sf):
    """Lines per country in the order of another aggregate, the revenue."""
    lines = X.retail_lines(spark, sf)
    counts = lines.groupBy("country").agg(F.count(F.lit(1)).alias("lines"))
    revenue = lines.groupBy("country").agg(F.sum(F.col("quantity") * F.col("price")).alias("revenue"))
    return CL.order_like(counts, revenue, "country", "revenue")


@query("valid_assignments")
def valid_assignments(spark, sf):
    """C11: rows whose (arm, page) pair is valid, as a semi join."""
    kept = CL.consistent_assignment(X.ab_units(spark, sf), X1.VALID_PAIRS, how="semi")
    return kept.groupBy("experiment_id", "grp").agg(F.count(F.lit(1)).alias("rows"))


@query("users_by_device")
def users_by_device(spark, sf):
    """Distinct users per device."""
    return P.distinct_by(X.user_events(spark, sf), ["device_type"], "user_id")


@query("events_in_order")
def events_in_order(spark, sf):
    """all events by time."""
    return E.order_events(X.user_events(spark, sf)).select("event_id", "user_id", "ts", "device_type", "action_type")


@query("events_preview")
def events_preview(spark, sf):
    """the first five events (the preview is the feature)."""
    return E.preview(X.user_events(spark, sf), ["ts", "event_id"], 5).select("event_id", "user_id", "ts", "action_type")


@query("distinct_actions")
def distinct_actions(spark, sf):
    """The distinct action types."""
    return CL.distinct_values(X.user_events(spark, sf), "action_type")


@query("session_rank_sql")
def session_rank_sql(spark, sf):
    """The session ranking as SQL text over a registered view."""
    view = f"user_events_{uuid.uuid4().hex}"
    register(X.user_events(spark, sf), view)
    return finish(spark.sql(f"""
        SELECT event_id, user_id, device_type, session_duration_minutes, session_rank FROM (
          SELECT *, row_number() OVER (PARTITION BY device_type ORDER BY session_duration_minutes DESC, event_id)
                    AS session_rank
          FROM {view} WHERE action_type = 'view')
        WHERE session_rank <= 10"""))


@query("cluster_retention")
def cluster_retention(spark, sf):
    """Retention by customer segment (whales and clusters); customers without one are left out."""
    lines = CL.clean_retention(X.retail_lines(spark, sf))
    labels = _all_segments(spark, sf).select("customer_id", "segment")
    return finish(CO.segment_retention(lines.join(labels, "customer_id"), "segment"))


@query("segment_splits")
def segment_splits(spark, sf):
    """Customers per segment after both splits."""
    segs = S.split_dormant(_all_segments(spark, sf))
    first = CO.first_purchase(CL.clean_retention(X.retail_lines(spark, sf)))
    split = S.split_by_account_age(segs, first, AS_OF, days=2000)
    return split.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
