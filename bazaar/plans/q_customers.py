from pyspark.sql import functions as F

from bazaar.operators import customers as C
from bazaar.plans.registry import AS_OF, finish, query
from bazaar.sources import fixtures as X


def _star(spark, sf):
    return (X.customers(spark, sf), X.orders(spark, sf, with_region=False),
            X.order_items(spark, sf), X.products(spark, sf))


@query("customer_analytics")
def customer_analytics(spark, sf):
    cu, o, i, p = _star(spark, sf)
    return finish(C.customer_analytics(cu, o, i, p, as_of=AS_OF), money={"lifetime_value": 2},
                  nullable_ints=("customer_lifespan_days",))


@query("customer_analytics_since_2000")
def customer_analytics_since_2000(spark, sf):
    cu, o, i, p = _star(spark, sf)
    o = o.where(F.col("order_date") >= F.lit("2000-01-01").cast("date"))
    return finish(C.customer_analytics(cu, o, i, p, as_of=AS_OF), money={"lifetime_value": 2},
                  nullable_ints=("customer_lifespan_days",))


@query("revenue_by_customer")
def revenue_by_customer(spark, sf):
    cu, o, _, _ = _star(spark, sf)
    return finish(C.revenue_by_customer(cu, o, k=20), money={"revenue": 2})


@query("favorite_category")
def favorite_category(spark, sf):
    _, o, i, p = _star(spark, sf)
    return finish(C.favorite_category(o, i, p), money={"favorite_category_spend": 2})
