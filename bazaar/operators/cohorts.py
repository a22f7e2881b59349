"""Cohort retention (survey 2.I1-I9 with 2.D8-D10, 2.E6, 2.E10, 2.E11).

Lines are first reduced to distinct (customer, month) pairs - a partial
aggregate, so even a customer with a third of all lines becomes at most
one row per month - and the cohort of each customer is taken from those
pairs.  Only the row-level ``assign_cohort`` joins the first purchase back
to every line; customers with many lines are cut over salts in that join, as
many as their count asks for, all others are not copied.

Day retention keeps a bitmap of purchase days per customer (64 days to a
word, put together by ``bit_or``), so one pass answers any set of days and
windows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.columns import ratio
from bazaar.operators.profile import attach
from bazaar.session import materialize

SHARES = 10_000          # a customer is heavy with more than this part of all lines: at most so many are


def first_purchase(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date") -> DataFrame:
    """E6 as an aggregate: first purchase per customer."""
    return lines.groupBy(user).agg(F.min(ts).alias("first_purchase_date"))


def _cohort_cols(first: str = "first_purchase_date"):
    return [F.trunc(F.col(first), "MM").alias("cohort_date"),
            F.year(first).cast("long").alias("cohort_year"), F.month(first).cast("long").alias("cohort_month"),
            F.dayofmonth(first).cast("long").alias("cohort_day")]


def cohort_index(year, month, cohort_year, cohort_month):
    """1-based month distance from the cohort month."""
    return ((year - cohort_year) * 12 + (month - cohort_month) + 1).cast("long")


def assign_cohort(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date", shares: int = SHARES,
                  least: int = 1000, purchases: DataFrame | None = None) -> DataFrame:
    """Every line with its customer's cohort fields and cohort index.

    The lines per customer are counted with the first purchase.  A customer
    with more than 1 / ``shares`` of all lines is heavy: his lines are dealt by
    hash over as many salts as he has such shares, and his first purchase is
    copied to each.  There are fewer than ``shares`` heavy customers and salts
    together stay below twice that, whatever the data, so the table of heavy
    ones is broadcast; all others meet their one row.  Lines without a customer
    have no cohort and go.

    ``purchases``: the lines before duplicates were dropped.  Their first dates
    are the same and their counts cover those of ``lines``, but no line has to
    be compared with others for them, so only customer and date are moved.
    """
    source = lines if purchases is None else purchases
    per = source.where(F.col(user).isNotNull()).groupBy(user).agg(F.min(ts).alias("first_purchase_date"), F.count(F.lit(1)).alias("__n"))
    per = materialize(per)
    share = per.agg(F.greatest(F.ceil(F.sum("__n") / shares), F.lit(least)).alias("__share"))
    per = attach(per, share).withColumn("__cut", F.ceil(F.col("__n") / F.col("__share")).cast("int"))
    heavy = F.broadcast(per.where(F.col("__cut") > 1).select(user, F.col("__cut").alias("__of")))
    fp = per.select(user, "first_purchase_date", *_cohort_cols(), F.explode(F.sequence(F.lit(0), F.col("__cut") - 1)).alias("__salt"))
    salt = F.pmod(F.xxhash64(*lines.columns), F.coalesce("__of", F.lit(1))).cast("int")
    j = lines.join(heavy, user, "left").withColumn("__salt", salt).join(fp, [user, "__salt"])
    return j.select(*lines.columns,
                    F.year(ts).cast("long").alias("year"), F.month(ts).cast("long").alias("month"),
                    F.dayofmonth(ts).cast("long").alias("day"),
                    (F.col("quantity") * F.col("price")).alias("revenue"),
                    "first_purchase_date", "cohort_date", "cohort_year", "cohort_month", "cohort_day",
                    cohort_index(F.year(ts), F.month(ts), F.col("cohort_year"), F.col("cohort_month"))
                    .alias("cohort_index"))


def active_months(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date",
                  extra_keys: Sequence[str] = ()) -> DataFrame:
    """Distinct (customer, year, month) with revenue and the month's first purchase."""
    return (lines.groupBy(user, *extra_keys, F.year(ts).cast("long").alias("year"),
                          F.month(ts).cast("long").alias("month"))
                 .agg(F.sum(F.col("quantity") * F.col("price")).alias("revenue"),
                      F.min(ts).alias("__first_in_month")))


def _with_cohort(months: DataFrame, user: str) -> DataFrame:
    # window over one customer's active months only (bounded by the calendar)
    w = Window.partitionBy(user)
    m = months.withColumn("first_purchase_date", F.min("__first_in_month").over(w))
    return m.select("*", *_cohort_cols()).withColumn(
        "cohort_index", cohort_index(F.col("year"), F.col("month"), F.col("cohort_year"), F.col("cohort_month")))


def customer_month(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date") -> DataFrame:
    """Per customer, year, month: revenue and the cohort fields."""
    m = _with_cohort(active_months(lines, user, ts), user)
    return m.select(user, "year", "month", "revenue", "cohort_index", "first_purchase_date", "cohort_date")


def cohort_activity(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date",
                    segment: str | None = None) -> DataFrame:
    """D9/I4 (I9 with ``segment``): distinct active customers per cohort and index."""
    extra = [segment] if segment else []
    m = _with_cohort(active_months(lines, user, ts, extra), user)
    keys = extra + ["cohort_date", "cohort_index"]
    return m.groupBy(*keys).agg(F.count_distinct(user).alias("active_customers"))


def retention_pct(activity: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Active customers as a percentage of the cohort's month-1 size."""
    w = Window.partitionBy(*keys, "cohort_date")   # one cohort's indexes only
    size = F.max(F.when(F.col("cohort_index") == 1, F.col("active_customers"))).over(w)
    return activity.select(*keys, "cohort_date", "cohort_index", "active_customers",
                           size.alias("cohort_size"),
                           (ratio(F.col("active_customers"), size) * 100).alias("retention_pct"))


def retention_triangle(activity: DataFrame, months: int | None = None,
                       value: str = "active_customers") -> DataFrame:
    """The wide triangle, one column per cohort index, NULL outside.

    ``months`` is the length of the data's calendar: it fixes the columns
    1..months up front (no extra job), and an index beyond it is an error, so
    none is dropped.  Without it Spark collects the distinct indexes first.
    """
    if months is None:
        return activity.groupBy("cohort_date").pivot("cohort_index").agg(F.first(value))
    index = F.when(F.col("cohort_index").between(1, months), F.col("cohort_index")).otherwise(
        F.raise_error(F.lit("cohort index beyond the calendar")).cast("long"))
    known = activity.withColumn("cohort_index", index)
    return known.groupBy("cohort_date").pivot("cohort_index", list(range(1, months + 1))).agg(F.first(value))


def retention_cells(pct: DataFrame) -> DataFrame:
    """I7: "count (pct%)" labels (and the "pct%" / yyyy-MM-dd axis labels), percent
    rounded half-to-even like numpy."""
    pr = F.rint(F.col("retention_pct")).cast("long").cast("string")
    n = F.col("active_customers").cast("string")
    return pct.select("cohort_date", "cohort_index",
                      F.date_format("cohort_date", "yyyy-MM-dd").alias("cohort_label"),
                      F.concat(pr, F.lit("%")).alias("retention_label"),
                      F.concat(n, F.lit(" ("), pr, F.lit("%)")).alias("cell"),
                      F.concat(n, F.lit("\n("), pr, F.lit("%)")).alias("cell_multiline"))


def purchase_days(lines: DataFrame, user: str = "customer_id", ts: str = "invoice_date") -> DataFrame:
    """(user, first_day, words): a bitmap of the days with a purchase per customer.

    ``words`` holds (word, bits) with bit d of word w for day 64 w + d since
    1970.  Words are put together by ``bit_or`` before and after the shuffle, so
    a customer with a third of all lines comes as one row per task and word; a
    customer has no more words than the calendar has spans of 64 days.
    """
    day = F.unix_date(F.to_date(ts))
    bits = (lines.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).withColumn("__day", day)
            .groupBy(user, F.floor(F.col("__day") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pmod(__day, 64))")).alias("bits"), F.min("__day").alias("__first")))
    return bits.groupBy(user).agg(F.min("__first").alias("first_day"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


# whether a customer's bitmap has a day from first_day + lo to first_day + hi: the words between them, cut to those days
_ACTIVE = """exists(words, w -> w.word BETWEEN floor((first_day + {lo}) / 64) AND floor((first_day + {hi}) / 64)
  AND (shiftrightunsigned(shiftleft(w.bits, 63 - least(63, first_day + {hi} - 64 * w.word)),
                          63 - least(63, first_day + {hi} - 64 * w.word) + greatest(0, first_day + {lo} - 64 * w.word))) <> 0)"""
FOREVER = 1 << 20        # days; the open end of a window


def retention_windows(lines: DataFrame, windows: Sequence[tuple[int, int | None]], user: str = "customer_id",
                      ts: str = "invoice_date") -> DataFrame:
    """Customers per monthly cohort active in each window of days after their first purchase.

    ``windows`` are (from, to) offsets, both inclusive, ``to`` None for ever.
    Every window is read from the same bitmaps in one aggregate, so hundreds of
    windows cost one pass and one plan.  Returns cohort_date, from_day, to_day
    (NULL for ever), cohort_size, active_customers; a window in which no
    customer of a cohort is active has 0.
    """
    spans = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(FOREVER if hi is None else hi).alias("hi")) for lo, hi in windows])
    per = purchase_days(lines, user, ts).withColumn("cohort_date", F.trunc(F.date_from_unix_date("first_day"), "MM"))
    each = per.select("cohort_date", "first_day", "words", F.explode(spans).alias("s"))
    counted = each.groupBy("cohort_date", "s.lo", "s.hi").agg(
        F.count(F.lit(1)).alias("cohort_size"), F.count_if(F.expr(_ACTIVE.format(lo="s.lo", hi="s.hi"))).alias("active_customers"))
    return counted.select("cohort_date", F.col("lo").cast("long").alias("from_day"),
                          F.when(F.col("hi") < FOREVER, F.col("hi")).cast("long").alias("to_day"), "cohort_size", "active_customers")


def rolling_retention(lines: DataFrame, days: Sequence[int] = (1, 7, 30, 90),
                      user: str = "customer_id", ts: str = "invoice_date") -> DataFrame:
    """N-day retention per monthly cohort.

    ``active_on_day``: bought exactly N days after the first purchase;
    ``active_on_or_after``: bought on day N or later (rolling retention).  Both
    are windows of :func:`retention_windows`.
    """
    counts = retention_windows(lines, [w for n in days for w in ((n, n), (n, None))], user, ts)
    on, after = F.col("to_day").isNotNull(), F.col("to_day").isNull()
    long = counts.groupBy("cohort_date", F.col("from_day").alias("day_n")).agg(
        F.max("cohort_size").alias("cohort_size"), F.max(F.when(on, F.col("active_customers"))).alias("active_on_day"),
        F.max(F.when(after, F.col("active_customers"))).alias("active_on_or_after"))
    return long.select("cohort_date", "day_n", "cohort_size", "active_on_day", "active_on_or_after",
                       (ratio(F.col("active_on_day"), F.col("cohort_size")) * 100).alias("day_retention_pct"),
                       (ratio(F.col("active_on_or_after"), F.col("cohort_size")) * 100)
                       .alias("rolling_retention_pct"))


def segment_retention(lines: DataFrame, segment: str, user: str = "customer_id",
                      ts: str = "invoice_date") -> DataFrame:
    """Retention percentages per segment and cohort."""
    act = cohort_activity(lines, user, ts, segment=segment)
    return retention_pct(act, keys=[segment])
