"""Row cleaning, code-pattern checks and the cleaning funnel (survey 2.B, D15, D16, D32, I1, J1)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Code patterns of the retail data.
STANDARD_STOCK_CODE = r"^\d{5}[A-Za-z]?$"
FIVE_DIGIT_STOCK_CODE = r"^\d{5}$"
CANCELLED_INVOICE = r"^C\d{6}$"
PLAIN_INVOICE = r"^\d{6}$"
FIVE_DIGIT_CUSTOMER = r"^\d{5}$"


def clean(df: DataFrame, not_null: Sequence[str] = (), nonzero: Sequence[str] = (),
          positive: Sequence[str] = (), exclude_prefix: dict[str, str] | None = None,
          match: dict[str, str] | None = None) -> DataFrame:
    """B1-B5 as one filter: Catalyst pushes the simple parts into the scan."""
    cond = F.lit(True)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c in nonzero:
        cond = cond & (F.col(c) != 0)
    for c in positive:
        cond = cond & (F.col(c) > 0)
    for c, p in (exclude_prefix or {}).items():
        cond = cond & ~F.coalesce(F.col(c).cast("string").startswith(p), F.lit(False))
    for c, rx in (match or {}).items():
        cond = cond & F.coalesce(F.col(c).cast("string").rlike(rx), F.lit(False))
    return df.where(cond)


def rfm_steps() -> list[tuple[str, Column]]:
    """J1 cleaning profile as named cumulative steps (the reference's order)."""
    return [
        ("after_remove_cancelled", ~F.col("invoice").startswith("C")),
        ("after_remove_nonstandard_stockcode",
         F.coalesce(F.col("stock_code").rlike(STANDARD_STOCK_CODE), F.lit(False))),
        ("after_remove_null_customerid", F.col("customer_id").isNotNull()),
        ("after_remove_nonpositive_price", F.col("price") > 0),
    ]


def clean_rfm(lines: DataFrame) -> DataFrame:
    """Drop cancellations, non-standard codes, missing customers, price <= 0."""
    cond = F.lit(True)
    for _, p in rfm_steps():
        cond = cond & p
    return lines.where(cond)


def drop_duplicates_except(df: DataFrame, ignore: Sequence[str]) -> DataFrame:
    """One row per distinct combination of the other columns.

    The ignored columns keep their smallest value (an explicit tie-break
    instead of file order); with nothing ignored this is ``dropDuplicates()``.
    Either way it is an aggregate, partially combined map-side.
    """
    ignore = [c for c in ignore if c in df.columns]
    if not ignore:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in ignore]
    agg = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in ignore])
    return agg.select(*df.columns)


def retention_purchases(lines: DataFrame) -> DataFrame:
    """I1 before duplicates are dropped: known customer (not 0), positive quantity and price."""
    return clean(lines, not_null=["customer_id"], nonzero=["customer_id"],
                 positive=["quantity", "price"])


def clean_retention(lines: DataFrame, dedup_ignore: Sequence[str] = ("invoice",)) -> DataFrame:
    """Known customer (not 0), positive quantity and price, duplicates dropped.

    The retention data is read with the invoice number as the row index, so
    its duplicate check compares every column except the invoice; that is
    the default here (``dedup_ignore=()`` drops only exact duplicates).
    """
    return drop_duplicates_except(retention_purchases(lines), dedup_ignore)


def cleaning_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]],
                    first: str = "original") -> DataFrame:
    """D32 + E5: rows left after each cumulative step and rows dropped by it.

    All step counts come from one aggregate pass (``count_if`` of the
    cumulative conjunction); the small result is unpivoted and ``lag``
    runs over at most len(steps)+1 rows.
    """
    aggs = [F.count(F.lit(1)).alias("s0")]
    cond = F.lit(True)
    for i, (_, pred) in enumerate(steps, 1):
        cond = cond & F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(cond).alias(f"s{i}"))
    counts = df.agg(*aggs)
    names = [first] + [n for n, _ in steps]
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("step_no"), F.lit(n).alias("step"),
                 F.col(f"s{i}").alias("rows")) for i, n in enumerate(names)])).alias("r")).select("r.*")
    w = Window.orderBy("step_no")    # at most len(steps)+1 rows
    return stacked.withColumn("dropped", F.lag("rows").over(w) - F.col("rows"))


def pattern_profile(df: DataFrame, col: str, patterns: dict[str, str], dropna: bool = True,
                    other: str = "unexpected") -> DataFrame:
    """Classify values by the first matching pattern, count per class."""
    s = F.col(col).cast("string")
    label = F.lit(other)
    for name, rx in reversed(list(patterns.items())):
        label = F.when(s.rlike(rx), F.lit(name)).otherwise(label)
    label = F.when(s.isNull(), F.lit(None)).otherwise(label)
    out = df.select(label.alias("pattern"))
    if dropna:
        out = out.where(F.col("pattern").isNotNull())
    return out.groupBy("pattern").agg(F.count(F.lit(1)).alias("rows"))


def pattern_strays(df: DataFrame, col: str, patterns: dict[str, str]) -> DataFrame:
    """The values matching no pattern, with their counts (most frequent first)."""
    s = F.col(col).cast("string")
    cond = F.lit(True)
    for rx in patterns.values():
        cond = cond & ~F.coalesce(s.rlike(rx), F.lit(False))
    return (df.where(s.isNotNull() & cond).groupBy(s.alias("value"))
              .agg(F.count(F.lit(1)).alias("rows")))


def consistency_check(df: DataFrame, when: Column, then: Column,
                      when_name: str = "when", then_name: str = "then") -> DataFrame:
    """Does ``when`` imply ``then`` and vice versa (one aggregate pass)."""
    w, t = F.coalesce(when, F.lit(False)), F.coalesce(then, F.lit(False))
    return df.agg(
        F.count_if(w).alias(f"{when_name}_rows"),
        F.count_if(t).alias(f"{then_name}_rows"),
        F.count_if(w & ~t).alias(f"{when_name}_not_{then_name}"),
        F.count_if(t & ~w).alias(f"{then_name}_not_{when_name}"),
        F.bool_and(~w | t).alias(f"all_{when_name}_are_{then_name}"),
        F.bool_and(~t | w).alias(f"all_{then_name}_are_{when_name}"))


def code_catalog(df: DataFrame, code: str = "stock_code", desc: str = "description",
                 order: Sequence[str] = ("invoice_date", "invoice")) -> DataFrame:
    """First non-null description (by an explicit order) and its count per code."""
    key = F.struct(*[F.col(o) for o in order], F.col(desc))
    return df.groupBy(code).agg(F.count(desc).alias("description_count"),
                                F.min_by(desc, F.when(F.col(desc).isNotNull(), key)).alias("first_description"))


def value_sets(df: DataFrame, key: str, col: str) -> DataFrame:
    """The distinct values per key, one row per (key, value) with its rows.

    A key with very many values is many rows, never one long list.
    """
    return df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("rows"))


def map_labels(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    """Dictionary mapping; unknown keys give NULL (a join, not a UDF).

    The label table is the mapping itself, so its size is the dict's.
    """
    spark = df.sparkSession
    key_type = df.schema[col].dataType.simpleString()
    labels = spark.createDataFrame([(k, v) for k, v in mapping.items()],
                                   f"__k {key_type}, {out} string")
    return df.join(F.broadcast(labels), df[col] == labels["__k"], "left").drop("__k")


def consistent_assignment(df: DataFrame, pairs: Sequence[tuple[str, str]],
                          arm: str = "grp", page: str = "landing_page",
                          how: str = "filter") -> DataFrame:
    """Keep rows whose (arm, page) is an allowed pair."""
    if how == "semi":
        spark = df.sparkSession
        allowed = spark.createDataFrame(list(pairs), f"{arm} string, {page} string")
        return df.join(F.broadcast(allowed), [arm, page], "left_semi")
    cond = F.lit(False)
    for a, p in pairs:
        cond = cond | ((F.col(arm) == a) & (F.col(page) == p))
    return df.where(cond)


def active_orders(orders: DataFrame, statuses: Sequence[str], col: str = "status") -> DataFrame:
    """The 'active' subset as an IN-list filter (pushed into the scan)."""
    return orders.where(F.col(col).isin(*statuses))


def exclude_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is absent from ``keys_df`` (left anti join, no collected set)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys_df.select(*on), on, "left_anti")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column."""
    return df.select(col).distinct()


def zero_fill(counts: DataFrame, labels: DataFrame, on: Sequence[str] | str, value: str) -> DataFrame:
    """Reindex ``counts`` to the label table, missing labels as 0."""
    on = [on] if isinstance(on, str) else list(on)
    j = labels.join(counts, on, "left")
    return j.withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def order_like(df: DataFrame, ranking: DataFrame, on: str, by: str, descending: bool = True) -> DataFrame:
    """Order ``df`` by another aggregate's values (ties by the key)."""
    r = ranking.select(on, F.col(by).alias("__order"))
    o = F.col("__order").desc() if descending else F.col("__order").asc()
    return df.join(r, on, "left").orderBy(o, F.col(on)).drop("__order")
