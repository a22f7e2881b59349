"""Analytic inputs derived from the driver tables (see FIXTURES.md).

The reference works on five kinds of input (an event log, retail invoice
lines, a customer/product/order star, A/B unit rows and daily campaign
rows).  None of its data files ships, so each is derived here from the
driver tables with plain column expressions and joins.  ``nation`` and
``region`` have a fixed size (25 and 5 rows), so they are the only sides
broadcast by hint; every other join is left to the optimiser's size check.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.sources.tables import table


def zpad(c: Column, width: int) -> Column:
    """Left-pad with zeros to ``width`` without truncating longer keys."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def device_of(event_id: Column) -> Column:
    d = event_id % 10
    return (F.when(d == 0, "smart_tv").when(d <= 2, "tablet")
             .when(d <= 5, "desktop").otherwise("mobile"))


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_events <- events: one row per session event."""
    return user_events_of(table(spark, sf_dir, "events"))


def user_events_of(e: DataFrame) -> DataFrame:
    """The session events of an ``events`` table or stream."""
    return e.select(
        "event_id", "user_id", "ts",
        device_of(F.col("event_id")).alias("device_type"),
        F.col("event_type").alias("action_type"),
        F.col("value").alias("session_duration_minutes"))


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """retail_lines <- lineitem x orders x part x customer x nation.

    Mirrors the invoice-line shape: cancellations carry a ``C`` invoice and a
    negative quantity, postage lines a ``POST`` code, some customers are
    missing and some prices are zero.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(F.broadcast(n), c.c_nationkey == n.n_nationkey))
    cancel = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0)
    code = F.when(F.col("p_size") == 1, F.lit("POST")).otherwise(
        F.concat(zpad(F.col("p_partkey") % 100_000, 5),     # five digits for any number of parts
                 F.when(F.col("p_size") % 5 == 0, F.lit("A")).otherwise(F.lit(""))))
    qty = F.col("l_quantity").cast("int")
    return j.select(
        F.concat(F.when(cancel, F.lit("C")).otherwise(F.lit("")),
                 zpad(F.col("o_orderkey"), 6)).alias("invoice"),
        code.alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(cancel, -qty).otherwise(qty).alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0), F.lit(0.0))
         .otherwise(F.col("p_retailprice")).alias("price"),
        F.when(F.col("o_orderkey") % 20 == 0, F.lit(None).cast("long"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"))


# ---- star schema -----------------------------------------------------------

def customers(spark: SparkSession, sf_dir: str, null_email_every: int | None = None) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    email = F.concat(F.lower(F.col("c_name")), F.lit("@example.com"))
    if null_email_every:
        email = F.when(F.col("c_custkey") % null_email_every == 0, F.lit(None).cast("string")).otherwise(email)
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").alias("customer_id"), email.alias("email"),
                     F.date_add(F.lit("1994-01-01").cast("date"),
                                (F.col("c_custkey") % 365).cast("int")).alias("registration_date"),
                     F.col("n_name").alias("country"),
                     F.col("c_mktsegment").alias("tier")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock_quantity"))


def orders(spark: SparkSession, sf_dir: str, with_region: bool = True) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"),
                    F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("total_amount"))
    if not with_region:
        return base
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
            .select("c_custkey", F.col("r_name").alias("region")))
    return (base.join(geo, base.customer_id == geo.c_custkey, "left").drop("c_custkey"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     F.col("l_linenumber").alias("line_number"),
                     F.col("l_quantity").cast("int").alias("quantity"),
                     F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"))


# ---- experiments -------------------------------------------------------------

def ab_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A/B unit rows <- orders: arm by customer parity, page swapped on 1 in 50.

    ``experiment_id`` is the order priority, so the table holds several
    experiments that all operators process at once.
    """
    o = table(spark, sf_dir, "orders")
    grp = F.when(F.col("o_custkey") % 2 == 0, "control").otherwise("treatment")
    matched = F.when(F.col("o_custkey") % 2 == 0, "old_page").otherwise("new_page")
    swapped = F.when(F.col("o_custkey") % 2 == 0, "new_page").otherwise("old_page")
    return o.select(
        F.col("o_orderpriority").alias("experiment_id"),
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ts"), grp.alias("grp"),
        F.when(F.col("o_orderkey") % 50 == 0, swapped).otherwise(matched).alias("landing_page"),
        (F.col("o_orderstatus") == "F").cast("int").alias("converted"))


def campaign_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily campaign rows per arm <- events (user parity picks the arm)."""
    e = table(spark, sf_dir, "events")
    arm = F.when(F.col("user_id") % 2 == 0, "control").otherwise("test")
    et = F.col("event_type")
    return (e.groupBy(arm.alias("arm"), F.to_date("ts").alias("date"))
             .agg(F.sum("value").alias("spend"),
                  F.count(F.lit(1)).alias("impressions"),
                  F.count_if(et.isin("click", "purchase")).alias("clicks"),
                  F.count_if(et == "view").alias("view_content"),
                  F.count_if(et == "signup").alias("add_to_cart"),
                  F.count_if(et == "purchase").alias("purchases")))
