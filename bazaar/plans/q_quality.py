"""Registered cleaning, profile and data-quality queries."""
from pyspark.sql import functions as F

from bazaar.operators import cleaning as CL
from bazaar.operators import customers as C
from bazaar.operators import profile as P
from bazaar.operators import quality as Q
from bazaar.operators import ranking as R
from bazaar.plans.registry import AS_OF, finish, query
from bazaar.sources import fixtures as X
from bazaar.sources.tables import TABLES

INVOICE_PATTERNS = {"cancellation": CL.CANCELLED_INVOICE, "plain": CL.PLAIN_INVOICE}


def _star(spark, sf):
    return {"customers": X.customers(spark, sf), "products": X.products(spark, sf),
            "orders": X.orders(spark, sf, with_region=False), "order_items": X.order_items(spark, sf)}


@query("cleaning_funnel")
def cleaning_funnel(spark, sf):
    return finish(CL.cleaning_funnel(X.retail_lines(spark, sf), CL.rfm_steps()),
                  nullable_ints=("dropped",))


@query("pattern_profile")
def pattern_profile(spark, sf):
    return CL.pattern_profile(X.retail_lines(spark, sf), "invoice", INVOICE_PATTERNS)


@query("stock_code_strays")
def stock_code_strays(spark, sf):
    return CL.pattern_strays(X.retail_lines(spark, sf), "stock_code",
                             {"standard": CL.STANDARD_STOCK_CODE})


@query("customer_id_format")
def customer_id_format(spark, sf):
    return CL.pattern_profile(X.retail_lines(spark, sf), "customer_id",
                              {"five_digit": CL.FIVE_DIGIT_CUSTOMER}, dropna=False)


@query("consistency_check")
def consistency_check(spark, sf):
    lines = X.retail_lines(spark, sf)
    return CL.consistency_check(lines, F.col("quantity") < 0, F.col("invoice").startswith("C"),
                                "negative_qty", "cancelled")


@query("code_catalog")
def code_catalog(spark, sf):
    return CL.code_catalog(X.retail_lines(spark, sf))


@query("value_sets")
def value_sets(spark, sf):
    standard = CL.clean(X.retail_lines(spark, sf), match={"stock_code": CL.STANDARD_STOCK_CODE})
    return CL.value_sets(standard, "stock_code", "description")


@query("value_counts")
def value_counts(spark, sf):
    return P.value_counts(X.retail_lines(spark, sf), "country")


@query("column_profile")
def column_profile(spark, sf):
    return finish(P.column_profile(X.retail_lines(spark, sf)))


@query("describe_numeric")
def describe_numeric(spark, sf):
    return finish(P.describe_numeric(X.retail_lines(spark, sf), ["quantity", "price"]))


@query("describe_categorical")
def describe_categorical(spark, sf):
    return P.describe_categorical(X.retail_lines(spark, sf),
                                  ["invoice", "stock_code", "description", "country"])


@query("null_rates")
def null_rates(spark, sf):
    star = _star(spark, sf)
    star["customers"] = X.customers(spark, sf, null_email_every=12)
    star["retail_lines"] = X.retail_lines(spark, sf)
    parts = [P.null_rates(df, name) for name, df in star.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return finish(out)


@query("table_profile")
def table_profile(spark, sf):
    return P.table_profile(spark, sf, TABLES)


def _edges(star):
    return [Q.FkEdge("orders", star["orders"], "customer_id", "customers", star["customers"], "customer_id"),
            Q.FkEdge("order_items", star["order_items"], "order_id", "orders", star["orders"], "order_id"),
            Q.FkEdge("order_items", star["order_items"], "product_id", "products", star["products"],
                     "product_id")]


@query("fk_audit")
def fk_audit(spark, sf):
    return Q.fk_audit(_edges(_star(spark, sf)))


@query("selectivity_profile")
def selectivity_profile(spark, sf):
    return finish(P.selectivity_profile(_star(spark, sf)["orders"], ["status", "customer_id"]))


@query("expectations")
def expectations(spark, sf):
    star = _star(spark, sf)
    mart = C.customer_analytics(star["customers"], star["orders"], star["order_items"],
                                star["products"], as_of=AS_OF)
    suite = [{"check": "not_null", "column": "customer_id"},
             {"check": "unique", "column": "customer_id"},
             {"check": "not_null", "column": "email"},
             {"check": "not_null", "column": "lifetime_value"},
             {"check": "not_null", "column": "customer_segment"},
             {"check": "accepted_values", "column": "customer_segment",
              "values": ["inactive", "occasional", "regular", "vip"]},
             {"check": "not_null", "column": "total_orders"}]
    items = Q.run_expectations(star["order_items"],
                               [{"check": "unique", "column": ["order_id", "line_number"]}])
    return (Q.run_expectations(mart, suite).withColumn("model", F.lit("customer_analytics"))
            .unionByName(items.withColumn("model", F.lit("order_items"))))


@query("findings")
def findings(spark, sf):
    star = _star(spark, sf)
    star["customers"] = X.customers(spark, sf, null_email_every=12)
    # null rates and duplicate keys of a keyed table come from one pass
    n_items, d_items = Q.table_audit(star["order_items"], "order_items", ["order_id", "line_number"])
    n_cust, d_cust = Q.table_audit(star["customers"], "customers", ["customer_id"])
    nulls = P.union_all(n_cust, P.null_rates(star["products"], "products"),
                        P.null_rates(star["orders"], "orders"), n_items)
    return Q.findings(nulls, Q.fk_audit(_edges(star)), P.union_all(d_items, d_cust))


@query("duplicate_rows")
def duplicate_rows(spark, sf):
    items = _star(spark, sf)["order_items"]
    dups = R.duplicate_rows(items, ["order_id", "line_number"])
    # unit prices are exact 7-digit decimals (ties at any rounding); the
    # line amount is a 2-decimal money value
    return finish(dups.withColumn("line_amount", F.col("quantity") * F.col("price")).drop("price"),
                  money={"line_amount": 2})


@query("duplicate_summary")
def duplicate_summary(spark, sf):
    # the retention data is indexed by invoice: duplicates compare the other columns
    return P.duplicate_summary(X.retail_lines(spark, sf), ignore=["invoice"])


@query("date_range")
def date_range(spark, sf):
    return P.date_range(X.retail_lines(spark, sf), "invoice_date")


@query("histogram")
def histogram(spark, sf):
    return finish(P.histogram(X.user_events(spark, sf), "session_duration_minutes", 20,
                              by=["device_type"]))


@query("density")
def density(spark, sf):
    return finish(P.density(X.user_events(spark, sf), "session_duration_minutes", 64,
                            by=["device_type"]))


@query("file_inventory")
def file_inventory(spark, sf):
    from bazaar.sources.tables import table_files
    return table_files(spark, sf, TABLES)


@query("active_orders")
def active_orders(spark, sf):
    return CL.active_orders(_star(spark, sf)["orders"], ["O", "P"]).groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("total_amount"), 2).alias("amount"))
