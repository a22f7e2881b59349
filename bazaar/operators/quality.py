"""Data-quality checks: expectations, foreign-key audit, findings (survey 2.L2-L7, 2.C9)."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.columns import fill

# Finding texts and priorities of the audit summary (the
# orphan and duplicate texts are this library's re-aimed checks).
FK_ISSUE = "Orphan keys: {table}.{column} ({rows} rows without a {parent} row)"
DUP_ISSUE = "{table}: {count} duplicate key values on ({key})"
NULL_ISSUE = "{table}.{column} has {pct}% nulls"
NULL_IMPACT = "Possible data quality issue"
NULL_OK = ("No high-null columns (> 5%)", "Data completeness is healthy", "OK")
FK_IMPACT = "Rows lost on inner joins"
FK_OK = ("All foreign keys resolve", "Joins keep every row", "OK")
DUP_IMPACT = "Double counting in aggregates"
DUP_OK = ("No duplicate keys", "Keys identify rows", "OK")


def _row(check: str, column: str, failures) -> list:
    return [F.lit(check).alias("check"), F.lit(column).alias("column_name"),
            failures.cast("long").alias("failures")]


def expect_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """L2: rows with NULL per column (one pass)."""
    return run_expectations(df, [{"check": "not_null", "column": c} for c in cols])


def expect_unique(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """L3: number of key values that occur more than once."""
    return run_expectations(df, [{"check": "unique", "column": key}])


def expect_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """L4: rows whose (non-null) value is outside the accepted list."""
    return run_expectations(df, [{"check": "accepted_values", "column": col, "values": list(values)}])


def run_expectations(df: DataFrame, suite: Sequence[dict]) -> DataFrame:
    """(check, column_name, failures, passed) for a suite of checks.

    Row-level checks share one aggregate; each uniqueness check is one more
    grouping (counts per key value, pre-aggregated map-side).
    """
    row_checks, uniq = [], []
    for i, t in enumerate(suite):
        chk, col = t["check"], t["column"]
        if chk == "not_null":
            row_checks.append((i, chk, col, F.count_if(F.col(col).isNull())))
        elif chk == "accepted_values":
            ok = F.col(col).isin(*t["values"])
            row_checks.append((i, chk, col, F.count_if(F.col(col).isNotNull() & ~ok)))
        elif chk == "unique":
            uniq.append((i, chk, col))
        else:
            raise ValueError(chk)
    parts = []
    if row_checks:
        agg = df.agg(*[e.alias(f"__c{i}") for i, _, _, e in row_checks])
        arr = F.array(*[F.struct(F.lit(i).alias("check_no"), F.lit(chk).alias("check"),
                                 F.lit(col).alias("column_name"), F.col(f"__c{i}").cast("long").alias("failures"))
                        for i, chk, col, _ in row_checks])
        parts.append(agg.select(F.inline(arr)))
    for i, chk, col in uniq:
        keys = [col] if isinstance(col, str) else list(col)
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
                 .agg(F.count(F.lit(1)).alias("failures")))
        parts.append(dup.select(F.lit(i).alias("check_no"), F.lit(chk).alias("check"),
                                F.lit(",".join(keys)).alias("column_name"),
                                F.col("failures").cast("long").alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


@dataclass
class FkEdge:
    child_table: str
    child: DataFrame
    fk: str
    parent_table: str
    parent: DataFrame
    pk: str


def fk_audit(edges: Sequence[FkEdge]) -> DataFrame:
    """Per foreign-key edge: child rows, NULL keys, orphan rows/keys, max fan-out.

    One pass per edge: child rows are counted per key value (partial
    aggregation, so a hot key is one row), left-joined to the distinct
    parent keys (both sides already hash-partitioned on the key), and one
    aggregate produces every figure.
    """
    parts = []
    for e in edges:
        per_key = e.child.groupBy(F.col(e.fk).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        parent_keys = (e.parent.select(F.col(e.pk).alias("__k")).where(F.col("__k").isNotNull())
                       .distinct().withColumn("__hit", F.lit(True)))
        j = per_key.join(parent_keys, "__k", "left")
        orphan = F.col("__k").isNotNull() & F.col("__hit").isNull()
        stats = j.agg(
            F.sum("__n").alias("child_rows"),
            F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(orphan, F.col("__n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(orphan).alias("orphan_keys"),
            F.max(F.when(F.col("__k").isNotNull(), F.col("__n"))).alias("max_fanout"))
        parts.append(stats.select(
            F.lit(e.child_table).alias("child_table"), F.lit(e.fk).alias("fk_column"),
            F.lit(e.parent_table).alias("parent_table"),
            *[F.col(c).cast("long").alias(c) for c in
              ("child_rows", "null_keys", "orphan_rows", "orphan_keys", "max_fanout")]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def findings(null_rates: DataFrame, fk: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(issue, impact, priority) from the three audits.

    ``duplicates``: rows (table_name, key, duplicate_keys).  Every input is
    already an aggregate (one row per column / edge / key), so the
    collect_list calls below hold at most that many short strings.
    """
    def section(detail: DataFrame, ok: tuple, sort_key: str) -> DataFrame:
        agg = detail.agg(F.count(F.lit(1)).alias("__n"))
        none = agg.where(F.col("__n") == 0).select(
            F.lit(ok[0]).alias("issue"), F.lit(ok[1]).alias("impact"), F.lit(ok[2]).alias("priority"),
            F.lit("").alias("sort_key"))
        return detail.select("issue", "impact", "priority", F.col(sort_key).alias("sort_key")).unionByName(none)

    nulls = null_rates.where("flagged").select(
        fill(NULL_ISSUE, table=F.col("table_name"), column=F.col("column_name"),
             pct=F.col("null_pct").cast("string")).alias("issue"),
        F.lit(NULL_IMPACT).alias("impact"), F.lit("MEDIUM").alias("priority"),
        F.concat_ws(".", "table_name", "column_name").alias("k"))
    orphans = fk.where(F.col("orphan_rows") > 0).select(
        fill(FK_ISSUE, table=F.col("child_table"), column=F.col("fk_column"),
             rows=F.col("orphan_rows").cast("string"), parent=F.col("parent_table")).alias("issue"),
        F.lit(FK_IMPACT).alias("impact"), F.lit("HIGH").alias("priority"),
        F.concat_ws(".", "child_table", "fk_column").alias("k"))
    dups = duplicates.where(F.col("duplicate_keys") > 0).select(
        fill(DUP_ISSUE, table=F.col("table_name"), count=F.col("duplicate_keys").cast("string"),
             key=F.col("key")).alias("issue"),
        F.lit(DUP_IMPACT).alias("impact"), F.lit("MEDIUM").alias("priority"),
        F.concat_ws(".", "table_name", "key").alias("k"))
    parts = [section(orphans, FK_OK, "k").withColumn("section", F.lit(1)),
             section(nulls, NULL_OK, "k").withColumn("section", F.lit(2)),
             section(dups, DUP_OK, "k").withColumn("section", F.lit(3))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("section", "sort_key", "issue", "impact", "priority")


def duplicate_keys(df: DataFrame, table_name: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values occurring more than once (input to ``findings``)."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
             .agg(F.count(F.lit(1)).alias("duplicate_keys")))
    return dup.select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key"),
                      F.col("duplicate_keys").cast("long").alias("duplicate_keys"))


def table_audit(df: DataFrame, table_name: str, keys: Sequence[str], threshold: float = 5.0):
    """Null rates and duplicate keys of one table from a single pass.

    Rows are counted per key value together with each column's NULL count
    (partial aggregation); one more aggregate over those per-key rows gives
    the table's NULL counts and the number of keys seen more than once.
    Returns (null_rates, duplicate_keys) shaped like ``profile.null_rates``
    and ``duplicate_keys``.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                    *[F.count_if(F.col(c).isNull()).alias(f"__z{i}") for i, c in enumerate(others)])
    null_of = {c: F.sum(F.when(F.col(c).isNull(), F.col("__n")).otherwise(F.lit(0))) for c in keys}
    null_of.update({c: F.sum(f"__z{i}") for i, c in enumerate(others)})
    tot = per_key.agg(F.sum("__n").alias("__total"), F.count_if(F.col("__n") > 1).alias("__dups"),
                      *[null_of[c].alias(f"__null_{j}") for j, c in enumerate(df.columns)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__null_{j}").cast("long").alias("null_count"))
                    for j, c in enumerate(df.columns)])
    long = tot.select("__total", F.inline(arr))
    pct = F.round(F.try_divide(F.col("null_count") * 100.0, F.col("__total")), 1)
    nulls = long.select(F.lit(table_name).alias("table_name"), "column_name", "null_count",
                        F.col("__total").alias("total_rows"), pct.alias("null_pct"), (pct > threshold).alias("flagged"))
    dups = tot.select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key"),
                      F.col("__dups").cast("long").alias("duplicate_keys"))
    return nulls, dups
