"""Registered cohort-retention queries (on the retention-cleaned retail lines)."""
from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.operators import cohorts as CO
from bazaar.plans.registry import finish, query
from bazaar.sources import fixtures as X


def _lines(spark, sf):
    return CL.clean_retention(X.retail_lines(spark, sf))


@query("retention_cleaning")
def retention_cleaning(spark, sf):
    return _lines(spark, sf).agg(F.count(F.lit(1)).alias("rows"),
                                 F.count_distinct("customer_id").alias("customers"))


@query("cohort_assignment")
def cohort_assignment(spark, sf):
    lines = X.retail_lines(spark, sf)
    cohorts = CO.assign_cohort(CL.clean_retention(lines), purchases=CL.retention_purchases(lines))
    return finish(cohorts, money={"revenue": 2})


@query("customer_month")
def customer_month(spark, sf):
    return finish(CO.customer_month(_lines(spark, sf)), money={"revenue": 2})


@query("cohort_activity")
def cohort_activity(spark, sf):
    return finish(CO.cohort_activity(_lines(spark, sf)))


CALENDAR_MONTHS = 80        # the orders run from 1995-01 to 2001-08 at every scale


@query("retention_triangle")
def retention_triangle(spark, sf):
    tri = CO.retention_triangle(CO.cohort_activity(_lines(spark, sf)), months=CALENDAR_MONTHS)
    return finish(tri, nullable_ints=tuple(c for c in tri.columns if c != "cohort_date"))


@query("retention_pct")
def retention_pct(spark, sf):
    return finish(CO.retention_pct(CO.cohort_activity(_lines(spark, sf))))


@query("retention_cells")
def retention_cells(spark, sf):
    return finish(CO.retention_cells(CO.retention_pct(CO.cohort_activity(_lines(spark, sf)))))


@query("rolling_retention")
def rolling_retention(spark, sf):
    return finish(CO.rolling_retention(_lines(spark, sf)))


CURVE_DAYS = range(1, 61)


@query("retention_curve")
def retention_curve(spark, sf):
    """I8: for each of 60 days the customers active on it, in the week it starts and from it on."""
    windows = [w for n in CURVE_DAYS for w in ((n, n), (n, n + 6), (n, None))]
    return finish(CO.retention_windows(_lines(spark, sf), windows), nullable_ints=("to_day",))


@query("segment_retention")
def segment_retention(spark, sf):
    return finish(CO.segment_retention(_lines(spark, sf), "country"))
