"""Customer mart (survey 2.L1 with 2.C1-C4, 2.D5-D7, 2.E4, 2.B16).

``customer_analytics`` is one row per customer.  Orders are aggregated per
customer *before* the join with the customer table (the reference groups
after a left join, which shuffles every order row together with five
customer attributes).  Category spend is summed straight to
(customer, category) - the per-order level of the reference adds nothing
to a sum - and the favourite is picked with ``min_by`` (a partial
aggregate) instead of a window, so a customer with a huge order history is
never one task's whole input.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.columns import order_count_segment


def customer_order_stats(orders: DataFrame) -> DataFrame:
    """D5 pre-aggregate: order count, spend, first/last date, mean per customer."""
    return orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_amount").alias("lifetime_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.avg("total_amount").alias("avg_order_value"))


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """C1 + D5: every customer, with zero orders coalesced to 0."""
    stats = customer_order_stats(orders)
    c = customers.select("customer_id", "email", "tier", "country", "registration_date")
    j = c.join(stats, "customer_id", "left")
    return j.select(
        "customer_id", "email", "tier", "country", "registration_date",
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("lifetime_value"), F.lit(0.0)).alias("lifetime_value"),
        "first_order_date", "last_order_date", "avg_order_value")


def category_spend(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """C2 + D6/D7: spend per (customer, category) over order items."""
    o = orders.select("order_id", "customer_id")
    p = products.select("product_id", "category")
    j = items.select("order_id", "product_id", "quantity", "price").join(o, "order_id").join(p, "product_id")
    return j.groupBy("customer_id", "category").agg(
        F.sum(F.col("quantity") * F.col("price")).alias("total_category_spend"))


def favorite_category(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The top category by spend per customer; ties go to the smaller name."""
    spend = category_spend(orders, items, products)
    rank_key = F.struct(F.col("total_category_spend").isNull(),
                        -F.col("total_category_spend"), F.col("category"))
    return spend.groupBy("customer_id").agg(
        F.min_by("category", rank_key).alias("favorite_category"),
        F.max("total_category_spend").alias("favorite_category_spend"))


def customer_analytics(customers: DataFrame, orders: DataFrame, items: DataFrame,
                       products: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """L1: the customer-360 mart.  ``as_of`` replaces current_date."""
    as_of_col = F.lit(str(as_of or dt.date.today())).cast("date")
    co = customer_orders(customers, orders)
    fav = favorite_category(orders, items, products).select("customer_id", "favorite_category")
    j = co.join(fav, "customer_id", "left")
    return j.select(
        "customer_id", "email", "tier", "country", "registration_date", "total_orders",
        "lifetime_value", "first_order_date", "last_order_date", "avg_order_value",
        "favorite_category",
        F.datediff(as_of_col, F.col("registration_date")).cast("long").alias("days_since_registration"),
        F.datediff(F.col("last_order_date"), F.col("first_order_date")).cast("long")
         .alias("customer_lifespan_days"),
        order_count_segment(F.col("total_orders")).alias("customer_segment"))


def revenue_by_customer(customers: DataFrame, orders: DataFrame, k: int = 20) -> DataFrame:
    """C4 + F4: top-k customers by revenue (inner join, aggregate, ordered limit).

    Orders are aggregated per customer first; the top-k is a bounded
    TakeOrderedAndProject.  Ties are broken by customer id.
    """
    rev = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"), F.sum("total_amount").alias("revenue"))
    j = customers.select("customer_id", "country", "tier").join(rev, "customer_id")
    return j.orderBy(F.col("revenue").desc(), F.col("customer_id")).limit(k)
