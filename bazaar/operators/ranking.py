"""Ranking, top-k, de-duplication and exact quantiles that survive hot keys.

A ``Window.partitionBy(g)`` sends every row of a group to one task.  With a
group holding a third of the data that task is the whole job, so the
full-ranking operators here never do that:

``row_number_within``
    1. range-partition the rows on (group, order) - a hot group is split
       over many partitions of bounded size - and sort inside partitions;
    2. one pass over each sorted partition (Arrow batches) records the first
       and the last run of equal group keys with its length: at most two
       rows per partition;
    3. a window over that small table gives, for the first run of every
       partition, the number of rows of the same group in earlier
       partitions (the carry).  At most one row per partition survives, so
       the broadcast is bounded by the partition count;
    4. a second pass numbers rows inside each run and adds the carry.

``exact_quantiles`` needs only a few ranks per group, so it stays in the
JVM: per-(group, partition) counts over the same range partitioning locate
the partitions holding the target ranks, and only those are ranked.

Top-k per group uses ``row_number() <= k``, which Spark plans with a
partial ``WindowGroupLimit`` before the shuffle, so each task ships at most
k rows per group.  Keep-first de-duplication is an aggregate (``min_by``)
with map-side partial aggregation instead of a window.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.session import ship_code, shuffle_partitions

_PID, _CARRY, _SIDE, _CNT = "__pid", "__carry", "__side", "__cnt"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                   right_cols: Sequence[str]) -> DataFrame:
    """Equi-join on ``keys`` treating null = null; keeps left columns + ``right_cols``."""
    l, r = left.alias("__l"), right.alias("__r")
    cond = None
    for k in keys:
        c = F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}"))
        cond = c if cond is None else cond & c
    return l.join(r, cond, how).select(*[F.col(f"__l.{c}").alias(c) for c in left.columns],
                                       *[F.col(f"__r.{c}").alias(c) for c in right_cols])


def _same_as_prev(col: pd.Series, prev) -> np.ndarray:
    """Per row: equal to the previous row (nulls equal nulls); row 0 compares with ``prev``."""
    v = col.to_numpy()
    na = pd.isna(v)
    same = np.empty(len(v), dtype=bool)
    if len(v) > 1:
        same[1:] = (v[1:] == v[:-1]) | (na[1:] & na[:-1])
    if len(v):
        if prev is _NO_PREV:
            same[0] = False
        else:
            p_na = prev is None or (isinstance(prev, float) and np.isnan(prev)) or prev is pd.NaT
            same[0] = bool(na[0]) if p_na else (not na[0] and v[0] == prev)
    return same


_NO_PREV = object()


def _run_starts(keys: pd.DataFrame, prev: tuple | None) -> np.ndarray:
    """True where a row starts a new run of equal keys (nulls compare equal)."""
    same = np.ones(len(keys), dtype=bool)
    for i, c in enumerate(keys.columns):
        same &= _same_as_prev(keys[c], _NO_PREV if prev is None else prev[i])
    return ~same


def _runs(keys: pd.DataFrame, prev: tuple | None):
    """Runs of equal keys in a sorted batch: (continues_prev, [(key, size), ...]).

    Only the first and last run matter to the caller, but the number of
    runs is needed to know whether the partition holds more than one.
    """
    starts = _run_starts(keys, prev)
    idx = starts.nonzero()[0]
    bounds = list(idx) + [len(keys)]
    runs = []
    if len(idx) == 0 or idx[0] != 0:          # leading rows continue the previous run
        runs.append((None, int(bounds[0])))
    if len(idx):
        first, last = idx[0], idx[-1]
        runs.append((tuple(keys.iloc[first]), int(bounds[1] - first)))
        if len(idx) > 2:
            runs.append((None, -1))           # middle runs: only their existence matters
        if len(idx) > 1:
            runs.append((tuple(keys.iloc[last]), int(len(keys) - last)))
    return (len(idx) == 0 or idx[0] != 0), runs


def _edges_fn(by: list[str]):
    """Per sorted partition: the first and the last run of equal group keys."""
    def edges(it):
        pid, first, last, n_runs, prev = None, None, None, 0, None
        for pdf in it:
            if pdf.empty:
                continue
            pid = int(pdf[_PID].iat[0])
            keys = pdf[by]
            cont, runs = _runs(keys, prev)
            for i, (key, size) in enumerate(runs):
                if i == 0 and cont:
                    last = (last[0], last[1] + size)
                    if n_runs == 1:
                        first = (first[0], first[1] + size)
                    continue
                n_runs += 1
                if n_runs == 1:
                    first = (key, size)
                last = (key, size)
            prev = tuple(keys.iloc[-1])
        if pid is None:
            return
        rows = [(pid, 0, *first[0], first[1])]
        if n_runs > 1:
            rows.append((pid, 1, *last[0], last[1]))
        yield pd.DataFrame(rows, columns=[_PID, _SIDE, *by, _CNT])
    return edges


def _number_fn(by: list[str], out: str, keep: list[str]):
    def number(it):
        prev, run_len = None, 0
        for pdf in it:
            if pdf.empty:
                continue
            keys = pdf[by]
            starts = _run_starts(keys, prev)
            pos = np.arange(len(pdf), dtype=np.int64)
            start_pos = np.maximum.accumulate(np.where(starts, pos, 0))
            local = pos - start_pos + 1
            if not starts[0]:                          # first run continues the previous batch
                cont = start_pos == 0
                local[cont] += run_len
            carry = pdf[_CARRY].fillna(0).to_numpy(dtype=np.int64)
            res = pdf[keep]
            res = res.assign(**{out: local + carry})
            run_len = int(local[-1])
            prev = tuple(keys.iloc[-1])
            yield res
    return number


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by by order by order)`` for any group size.

    ``order`` should end in a unique tie-break for a deterministic result.
    """
    by = list(by)
    if not by:                       # one global sequence: a single (hot) group
        res = row_number_within(df.withColumn("__all", F.lit(0)), ["__all"], order, out,
                                num_partitions)
        return res.drop("__all")
    order = [_as_col(o) for o in order]
    ship_code(df.sparkSession)          # the passes below run in Python workers
    n = num_partitions or shuffle_partitions(df.sparkSession)
    sort_exprs = [F.col(b).asc_nulls_first() for b in by] + order
    keep = list(df.columns)
    ranged = (df.repartitionByRange(n, *sort_exprs)
                .sortWithinPartitions(*sort_exprs)
                .withColumn(_PID, F.spark_partition_id()))
    key_fields = [df.schema[b] for b in by]
    edge_schema = T.StructType([T.StructField(_PID, T.IntegerType()),
                                T.StructField(_SIDE, T.IntegerType()),
                                *[T.StructField(f.name, f.dataType) for f in key_fields],
                                T.StructField(_CNT, T.LongType())])
    # Both passes must read the very same exchange: the range bounds come from
    # a sample seeded by the RDD id, so a second (pruned) exchange would cut
    # the partitions elsewhere.  Feeding the full rows keeps the subtrees
    # identical and the exchange is reused (one shuffle, one set of bounds).
    edges = ranged.mapInPandas(_edges_fn(by), edge_schema)
    w = Window.partitionBy(*by).orderBy(_PID, _SIDE).rowsBetween(Window.unboundedPreceding, -1)
    carries = (edges.withColumn(_CARRY, F.sum(_CNT).over(w))
                    .where((F.col(_SIDE) == 0) & (F.col(_CARRY) > 0))
                    .select(F.col(_PID).alias("__cpid"),
                            *[F.col(b).alias(f"__c_{b}") for b in by], _CARRY))
    cond = F.col(_PID) == F.col("__cpid")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__c_{b}"))
    # at most one carry row per range partition: a bounded broadcast
    joined = ranged.join(F.broadcast(carries), cond, "left")
    out_schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    return joined.mapInPandas(_number_fn(by, out, keep), out_schema)


def rank_within(df: DataFrame, by: Sequence[str], value_cols: Sequence[str], descending: bool,
                tiebreak: Sequence[str], method: str = "row_number", out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """row_number / rank / dense_rank within groups, hot-group safe.

    rank       = row number in the group - row number among equal values + 1
    dense_rank = row number of the value among the distinct values of the group
    """
    by = list(by)
    vals = [F.col(v).desc_nulls_last() if descending else F.col(v).asc_nulls_first()
            for v in value_cols]
    tb = [F.col(t).asc() for t in tiebreak]
    if method == "row_number":
        return row_number_within(df, by, vals + tb, out, num_partitions)
    if method == "rank":
        r1 = row_number_within(df, by, vals + tb, "__rn_g", num_partitions)
        r2 = row_number_within(r1, by + list(value_cols), tb, "__rn_v", num_partitions)
        return (r2.withColumn(out, F.col("__rn_g") - F.col("__rn_v") + 1)
                  .drop("__rn_g", "__rn_v"))
    if method == "dense_rank":
        distinct_vals = df.select(*by, *value_cols).dropDuplicates()
        ranks = row_number_within(distinct_vals, by, vals, out, num_partitions)
        return join_null_safe(df, ranks, by + list(value_cols), "left", [out])
    raise ValueError(method)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence, k: int = 1,
                  out: str | None = None) -> DataFrame:
    """Top-k rows per group (F5, E1 with a limit).

    ``row_number() <= k`` becomes a partial WindowGroupLimit before the
    shuffle, so no task receives more than k rows per group per map task.
    """
    w = Window.partitionBy(*by).orderBy(*[_as_col(o) for o in order])
    name = out or "__rn"
    res = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return res if out else res.drop(name)


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top-k (F4): planned as TakeOrderedAndProject, bounded by k."""
    return df.orderBy(*[_as_col(o) for o in order]).limit(k)


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (E8) as an aggregate.

    ``min_by`` is partially aggregated map-side, so a hot key costs one
    buffered row per task instead of one task holding the whole key.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest])


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None,
                   out: str = "dup_count") -> DataFrame:
    """All members of duplicate sets with the set size.

    Counts per key are pre-aggregated, only keys seen more than once are
    joined back; AQE splits a hot key on the big side of that join.
    """
    keys = list(keys or df.columns)
    dups = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1))
    return join_null_safe(df, dups, keys, "inner", [out])


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles (pandas / quantile_cont semantics), JVM only.

    Returns (*by, prob, quantile).  Spark's exact ``percentile`` keeps every
    distinct value of a group in one buffer; here equal values are counted
    first, so ties are one row, and no task sees more than one range partition
    of (group, value, count):

    1. count rows per (group, value) (partial aggregation) and range-partition
       the counts - a hot group spans many partitions, a hot value is one row;
    2. sum the counts per (group, partition) and turn them into each
       partition's rank interval;
    3. locate the partition holding each target rank (a join of two small
       tables: targets x partitions of the same group);
    4. cumulate the counts only inside the located partitions and pick the
       values whose rank interval holds a target.

    Steps 2 and 4 read the same exchange (the aggregate also takes the
    maximum value so no column is pruned below it), hence the same bounds.
    Group keys must be non-null.
    """
    by = list(by)
    if not by:
        res = exact_quantiles(df.withColumn("__all", F.lit(0)), value, probs, ["__all"], num_partitions)
        return res.drop("__all")
    n = num_partitions or shuffle_partitions(df.sparkSession)
    vals = df.select(*by, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    vals = vals.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__w"))
    ranged = (vals.repartitionByRange(n, *[F.col(b).asc_nulls_first() for b in by], F.col("__v").asc())
                  .withColumn(_PID, F.spark_partition_id()))
    parts = ranged.groupBy(*by, _PID).agg(F.sum("__w").alias("__c"), F.max("__v").alias("__mx"))
    w = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (parts.withColumn("__end", F.sum("__c").over(w))        # one group's partitions only
                  .withColumn("__start", F.col("__end") - F.col("__c")))
    totals = parts.groupBy(*by).agg(F.sum("__c").alias("__n"))
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    pos = (totals.select(*by, "__n", F.explode(probs_arr).alias("prob"))
                 .withColumn("__h", (F.col("__n") - 1) * F.col("prob"))
                 .withColumn("__d", F.col("__h") - F.floor("__h")))
    targets = pos.select(*by, "prob", "__d", F.explode(F.array(
        F.struct(F.lit(0).alias("__side"), (F.floor("__h").cast("long") + 1).alias("__r")),
        F.struct(F.lit(1).alias("__side"), (F.ceil("__h").cast("long") + 1).alias("__r")))).alias("__t")
    ).select(*by, "prob", "__d", "__t.__side", "__t.__r")
    loc = (targets.join(parts.select(*by, _PID, "__start", "__end"), by)
                  .where((F.col("__r") > F.col("__start")) & (F.col("__r") <= F.col("__end")))
                  .select(*by, "prob", "__d", "__side", _PID, (F.col("__r") - F.col("__start")).alias("__j")))
    hot = loc.select(*by, _PID).distinct()
    cand = ranged.join(hot, by + [_PID], "left_semi")
    wj = Window.partitionBy(*by, _PID).orderBy("__v")               # one range partition
    picked = (cand.withColumn("__upto", F.sum("__w").over(wj.rowsBetween(Window.unboundedPreceding, 0)))
                  .join(loc, by + [_PID])
                  .where((F.col("__j") > F.col("__upto") - F.col("__w")) & (F.col("__j") <= F.col("__upto"))))
    agg = picked.groupBy(*by, "prob", "__d").agg(
        F.max(F.when(F.col("__side") == 0, F.col("__v"))).alias("__vlo"),
        F.max(F.when(F.col("__side") == 1, F.col("__v"))).alias("__vhi"))
    return agg.select(*by, "prob",
                      (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__d")).alias("quantile"))
