"""Literal edge-case frames from FIXTURES.md section 3."""
import datetime as dt

from pyspark.sql import functions as F

from bazaar.operators import customers as C
from bazaar.operators import events as EV
from bazaar.operators import experiments as E


def _star(spark):
    customers = spark.createDataFrame(
        [(1, "a@x", "GOLD", "NL", dt.date(2020, 1, 1)), (2, "b@x", "SILVER", "DE", dt.date(2020, 6, 1))],
        "customer_id long, email string, tier string, country string, registration_date date")
    orders = spark.createDataFrame([(10, 1, dt.date(2021, 1, 1), 100.0), (11, 1, dt.date(2021, 1, 11), 50.0)],
                                   "order_id long, customer_id long, order_date date, total_amount double")
    items = spark.createDataFrame([(10, 100, 1, 2.0), (10, 200, 1, 2.0), (11, 300, 1, 5.0)],
                                  "order_id long, product_id long, quantity int, price double")
    products = spark.createDataFrame([(100, "toys"), (200, "books"), (300, "games")],
                                     "product_id long, category string")
    return customers, orders, items, products


def test_customer_without_orders(spark):
    cu, o, i, p = _star(spark)
    rows = {r.customer_id: r for r in C.customer_analytics(cu, o, i, p, as_of="2022-01-01").collect()}
    none = rows[2]
    assert (none.total_orders, none.lifetime_value, none.avg_order_value, none.customer_segment,
            none.customer_lifespan_days, none.favorite_category) == (0, 0.0, None, "inactive", None, None)
    one = rows[1]
    assert (one.total_orders, one.lifetime_value, one.customer_lifespan_days, one.customer_segment) == \
        (2, 150.0, 10, "occasional")
    assert one.days_since_registration == (dt.date(2022, 1, 1) - dt.date(2020, 1, 1)).days


def test_favorite_category_tie_goes_to_smaller_name(spark):
    cu, o, i, p = _star(spark)
    # books and toys both 2.0 in order 10, games 5.0 in order 11 -> games wins; drop order 11 to tie
    fav = C.favorite_category(o.where("order_id = 10"), i, p).first()
    assert fav.favorite_category == "books"


def test_mode_tie_and_session_tiebreak(spark):
    ev = spark.createDataFrame(
        [(1, 7, dt.datetime(2024, 1, 1, 10, 5), "tablet", "view", 30.0),
         (2, 8, dt.datetime(2024, 1, 1, 10, 15), "mobile", "view", 30.0),
         (3, 9, dt.datetime(2024, 1, 1, 10, 25), "mobile", "view", 5.0),
         (4, 9, dt.datetime(2024, 1, 1, 10, 35), "tablet", "click", 1.0)],
        "event_id long, user_id long, ts timestamp_ntz, device_type string, action_type string, "
        "session_duration_minutes double")
    h = EV.hourly_metrics(ev).first()
    assert (h.session_count, h.unique_users, h.most_popular_device) == (4, 3, "mobile")
    # two mobile sessions: 30.0 (event 2) and 5.0; tablet 30.0 (event 1): explicit tie-break on event_id
    r = {(x.device_type, x.session_rank): x.event_id for x in EV.rank_sessions(ev, k=10).collect()}
    assert r == {("mobile", 1): 2, ("mobile", 2): 3, ("tablet", 1): 1}


def test_welch_zero_variance_gives_null(spark):
    df = spark.createDataFrame([("test", 0.5), ("test", 0.5), ("control", 0.5), ("control", 0.5)],
                               "arm string, ctr double")
    r = E.welch_t(df, "ctr").first()
    assert r.t_stat is None and r.p_two_sided is None


def test_campaign_null_day_is_skipped(spark):
    daily = spark.createDataFrame([("control", 100, 10, 5.0, 1), ("control", None, None, None, None),
                                   ("test", 100, 20, 5.0, 2)],
                                  "arm string, impressions long, clicks long, spend double, purchases long")
    t = {r.arm: r for r in E.campaign_totals(daily).collect()}
    assert t["control"].days == 1 and t["control"].pooled_ctr == 0.1
    rates = E.add_campaign_metrics(daily.withColumn("add_to_cart", F.lit(0)).withColumn("view_content", F.lit(0)))
    assert rates.where("ctr IS NULL").count() == 1


def test_retention_dedup_ignores_invoice(spark):
    from bazaar.operators.cleaning import clean_retention
    lines = spark.createDataFrame(
        [("000002", "10001", "a", 1, dt.datetime(2020, 1, 1), 2.0, 7, "NL"),
         ("000001", "10001", "a", 1, dt.datetime(2020, 1, 1), 2.0, 7, "NL"),
         ("000003", "10001", "a", 2, dt.datetime(2020, 1, 1), 2.0, 7, "NL")],
        "invoice string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, "
        "price double, customer_id long, country string")
    kept = sorted((r.invoice, r.quantity) for r in clean_retention(lines).collect())
    assert kept == [("000001", 1), ("000003", 2)]
    assert clean_retention(lines, dedup_ignore=()).count() == 3


def test_fk_audit_orphans_and_findings(spark):
    from bazaar.operators import profile as P
    from bazaar.operators import quality as Q
    parent = spark.createDataFrame([(1,), (2,)], "customer_id long")
    child = spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, None)], "order_id long, customer_id long")
    fk = Q.fk_audit([Q.FkEdge("orders", child, "customer_id", "customers", parent, "customer_id")])
    r = fk.first()
    assert (r.child_rows, r.null_keys, r.orphan_rows, r.orphan_keys, r.max_fanout) == (4, 1, 1, 1, 2)
    nulls = P.null_rates(child, "orders")
    dups = Q.duplicate_keys(child, "orders", ["order_id"])
    got = {x.section: (x.issue, x.priority) for x in Q.findings(nulls, fk, dups).collect()}
    assert got[1] == ("Orphan keys: orders.customer_id (1 rows without a customers row)", "HIGH")
    assert got[2] == ("orders.customer_id has 25.0% nulls", "MEDIUM")
    assert got[3][1] == "OK"


def test_modal_device_equals_buffered_mode(spark):
    from bazaar.sources import fixtures as X
    from tests.paths import SF_SMALL
    ue = X.user_events(spark, SF_SMALL)
    a = {r.hour: r.most_popular_device for r in EV.hourly_metrics(ue).collect()}
    b = {r.hour: r.d for r in ue.groupBy(EV.hour_of("ts").alias("hour")).agg(
        F.mode("device_type", deterministic=True).alias("d")).collect()}
    assert a == b and len(a) > 100


def test_table_audit_equals_separate_checks(spark):
    from bazaar.operators import profile as P
    from bazaar.operators import quality as Q
    df = spark.createDataFrame([(1, 1, "a", None), (1, 1, None, 2.0), (2, None, "b", 3.0), (None, 5, None, None),
                                (2, None, "c", 1.0)], "k1 long, k2 long, s string, v double")
    nulls, dups = Q.table_audit(df, "t", ["k1", "k2"])
    want = {r.column_name: tuple(r)[2:] for r in P.null_rates(df, "t").collect()}
    got = {r.column_name: tuple(r)[2:] for r in nulls.collect()}
    assert got == want
    assert dups.first().duplicate_keys == Q.duplicate_keys(df, "t", ["k1", "k2"]).first().duplicate_keys == 2
