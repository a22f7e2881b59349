"""Shared column expressions (CASE ladders, bands, safe ratios)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order-count segment ladder of the customer mart
# (0 inactive, fewer than 5 occasional, fewer than 15 regular, else vip).
SEGMENT_LABELS = ("inactive", "occasional", "regular", "vip")
SEGMENT_OCCASIONAL_BELOW = 5
SEGMENT_REGULAR_BELOW = 15


def order_count_segment(n: Column) -> Column:
    """Behavioural segment from an order count."""
    return (F.when(n == 0, F.lit("inactive"))
             .when(n < SEGMENT_OCCASIONAL_BELOW, F.lit("occasional"))
             .when(n < SEGMENT_REGULAR_BELOW, F.lit("regular"))
             .otherwise(F.lit("vip")))


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe, N5)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts: Column) -> Column:
    """Floor a timestamp_ntz to the hour without a session time-zone round trip."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the ISO week of a timestamp_ntz (time-zone independent)."""
    d = F.to_date(ts)
    monday = F.date_sub(d, ((F.dayofweek(d) + 5) % 7).cast("int"))
    return F.make_timestamp_ntz(F.year(monday), F.month(monday), F.dayofmonth(monday),
                                F.lit(0), F.lit(0), F.lit(0))


def fill(template: str, **values) -> Column:
    """A string column from a ``{name}`` template whose fields are columns."""
    import re
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [F.lit(p) if i % 2 == 0 else values[p] for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*pieces)
