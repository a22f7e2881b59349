"""K-means as aggregates (survey 2.J6, 2.J8, 2.J16): all runs of all K take each Lloyd step together.

A run is one (K, starting feature) pair.  Its starting centroids are the
feature means of K equally filled bands of one feature, so nothing is drawn at
random and a rerun, another layout or another engine takes the same steps; the
several features give each K several starts, of which the one with the least
inertia wins.

One step is one aggregate over the points: every point finds its nearest
centroid in each run, and the means per (run, centroid) are the next centroids.
The points are packed once into blocks of doubles, a task goes through its
blocks in numpy and hands on its sums, so a step moves (sum of K) rows per task
whatever the number of points.  Only those centroids (their number is fixed by
the arguments) come to the driver.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators.profile import unpivot
from bazaar.operators.ranking import exact_quantiles
from bazaar.session import materialize

State = dict[int, list[tuple[float, ...] | None]]
BLOCK = 10_000           # points in one block at most
TASK = 2_000_000         # points in one task of a Lloyd step, about, where there are more than cores take


def _centroids(state: State) -> list:
    """The centroids that exist, by run (as JSON a constant of the plan; doubles are written in full)."""
    return [{"run": run, "cents": [{"cluster": i, "c": list(c)} for i, c in enumerate(cents) if c is not None]}
            for run, cents in sorted(state.items())]


def _nearest(cents: Column, cols: Sequence[str]) -> Column:
    """(d, cluster) of the nearest of an array of centroids."""
    def distance(cent):
        d = F.lit(0.0)
        for i, name in enumerate(cols):
            d = d + (F.col(name) - cent["c"][i]) * (F.col(name) - cent["c"][i])
        return F.struct(d.alias("d"), cent["cluster"].alias("cluster"))
    return F.array_min(F.transform(cents, distance))


def _assigned(points: DataFrame, state: State, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, run, cluster, d, cols): every point with its nearest centroid of each run (ties: the lower one)."""
    runs = F.from_json(F.lit(json.dumps(_centroids(state))), "array<struct<run: int, cents: array<struct<cluster: int, c: array<double>>>>>")

    each = F.explode(F.transform(runs, lambda r: F.struct(r["run"].alias("run"), _nearest(r["cents"], cols).alias("best"))))
    return (points.select(*keep, *cols, each.alias("__e"))
            .select(*keep, F.col("__e.run").alias("run"), F.col("__e.best.cluster").alias("cluster"),
                    F.col("__e.best.d").alias("d"), *cols))


def _packed(points: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x0, x1, ...): blocks of up to ``BLOCK`` points, one binary of doubles per feature."""
    names = [f"x{i}" for i in range(len(cols))]

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in part.columns], names)

    return (points.select(*[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
            .mapInArrow(pack, ", ".join(f"{n} binary" for n in names)))


def _nearest_of(x: list, cents: Sequence[Sequence[float]]) -> tuple:
    """(position, distance) of the nearest of ``cents`` for each point of the feature arrays ``x`` (ties: the first; NaN is far)."""
    near, low = np.zeros(len(x[0]), np.int64), np.full(len(x[0]), np.inf)
    for j, cent in enumerate(cents):
        d = np.zeros(len(low))
        for values, at in zip(x, cent):
            move = values - at
            move *= move
            d += move
        np.copyto(near, j, where=d < low)
        np.fmin(low, d, out=low)
    return near, low


def _sums(blocks: DataFrame, state: State, cols: Sequence[str]) -> DataFrame:
    """(run, cluster, n, d, s0, s1, ...): points, squared distances and feature sums per centroid that is nearest to any."""
    runs = [(run, [i for i, c in enumerate(cents) if c is not None], [c for c in cents if c is not None]) for run, cents in sorted(state.items())]
    sums = ["d", *[f"s{i}" for i in range(len(cols))]]

    def add(batches):
        totals = [np.zeros((len(sums) + 1, len(cents))) for _, _, cents in runs]
        for batch in batches:
            for row in range(batch.num_rows):
                x = [np.frombuffer(c[row].as_buffer(), np.float64) for c in batch.columns]
                for (_, _, cents), total in zip(runs, totals):
                    near, d = _nearest_of(x, cents)
                    total[0] += np.bincount(near, minlength=len(cents))
                    for i, values in enumerate([d, *x], 1):
                        total[i] += np.bincount(near, values, len(cents))
        found = [(run, i, int(t[0]), *t[1:]) for (run, ids, _), total in zip(runs, totals) for i, t in zip(ids, total.T) if t[0]]
        if found:
            types = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * len(sums)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], ["run", "cluster", "n", *sums])

    parts = blocks.mapInArrow(add, "run int, cluster int, n long, " + ", ".join(f"{c} double" for c in sums))
    return parts.groupBy("run", "cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])


def band_starts(points: DataFrame, ks: Sequence[int], cols: Sequence[str]) -> State:
    """Starting centroids of run K * 100 + i: the means of K bands of feature i, the highest values first.

    The inner quantiles of every K and feature come from one exact quantile
    pass; a value equal to a bound belongs to the lower band.  A band that
    ties leave empty starts no centroid.
    """
    probs = sorted({j / k for k in ks for j in range(1, k)})
    if probs:
        found = exact_quantiles(unpivot(points, cols, "double"), "value", probs, by=["column_name"]).collect()
    else:
        found = []
    at = {(r.column_name, r.prob): r.quantile for r in found}
    bands = []
    for k in ks:
        for i, name in enumerate(cols):
            above = F.lit(0)
            for j in range(1, k):
                above = above + (F.col(name) <= F.lit(at.get((name, j / k)))).cast("int")
            bands.append(F.struct(F.lit(k * 100 + i).alias("run"), above.alias("cluster")))
    sums = (points.select(*cols, F.explode(F.array(*bands)).alias("__b"))
            .groupBy("__b.run", "__b.cluster").agg(*[F.avg(c).alias(c) for c in cols]).collect())
    state: State = {k * 100 + i: [None] * k for k in ks for i in range(len(cols))}
    for r in sums:
        state[r.run][r.cluster] = tuple(r[c] for c in cols)
    return state


def lloyd(points: DataFrame, state: State, cols: Sequence[str], tol: float = 1e-4, max_iter: int = 1000) -> tuple[State, dict[int, int]]:
    """Lloyd's iteration of all runs of ``state``; the centroids reached and the steps of each run.

    A run stops after the step in which its centroids move by no more than
    ``tol`` (sum of squared moves).  A centroid that no point is nearest to
    stays where it is.  Points with a NULL feature must be left out before.
    """
    state, steps, open_ = dict(state), dict.fromkeys(state, 0), {run for run, cents in state.items() if any(cents)}
    if open_:       # a step is short: no more tasks than cores, unless they were too large
        tasks = max(points.sparkSession.sparkContext.defaultParallelism, -(-points.count() // TASK))
        blocks = materialize(_packed(points.coalesce(tasks), cols))
    while open_:
        means = _sums(blocks, {run: state[run] for run in open_}, cols).collect()
        moved = dict.fromkeys(open_, 0.0)
        for run in open_:
            state[run] = list(state[run])
        for r in sorted(means, key=lambda r: (r.run, r.cluster)):
            new = tuple(r[f"s{i}"] / r.n for i in range(len(cols)))
            moved[r.run] += sum((a - b) ** 2 for a, b in zip(new, state[r.run][r.cluster]))
            state[r.run][r.cluster] = new
        for run in list(open_):
            steps[run] += 1
            if moved[run] <= tol or steps[run] >= max_iter:
                open_.discard(run)
    return state, steps


def fit(points: DataFrame, ks: Sequence[int], cols: Sequence[str], tol: float = 1e-4, max_iter: int = 1000) -> dict[int, tuple[list, float, int]]:
    """Per K the centroids of its best start (by falling first feature), their inertia and the steps taken.

    Inertia is compared to nine digits; equal starts go to the earlier feature.
    """
    state, steps = lloyd(points, band_starts(points, ks, cols), cols, tol, max_iter)
    state = {run: cents for run, cents in state.items() if any(cents)}
    if not state:
        return {}
    inertia = {r.run: r.inertia for r in _sums(_packed(points, cols), state, cols).groupBy("run").agg(F.sum("d").alias("inertia")).collect()}
    out = {}
    for k in ks:
        runs = [run for run in state if run // 100 == k]
        if runs:
            best = min(runs, key=lambda run: (round(inertia[run], 9), run))
            cents = sorted((c for c in state[best] if c is not None), key=lambda c: tuple(-x for x in c))
            out[k] = (cents, inertia[best], steps[best])
    return out


def kmeans_segments(features: DataFrame, k: int = 4, cols: Sequence[str] = (), tol: float = 1e-4, max_iter: int = 1000) -> DataFrame:
    """Every row with its cluster (numbered by falling first feature) and squared distance.

    Rows with a NULL feature are in no cluster (NULL); an empty table gives no
    rows; with fewer distinct points than K there are fewer clusters.
    """
    features = materialize(features)
    points = features.dropna(subset=list(cols))
    fits = fit(points, [k], cols, tol, max_iter)
    if not fits:
        return features.select("*", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("sq_distance"))
    cents = F.from_json(F.lit(json.dumps([{"cluster": i, "c": list(c)} for i, c in enumerate(fits[k][0])])),
                        "array<struct<cluster: int, c: array<double>>>")
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    return (features.withColumn("__best", F.when(whole, _nearest(cents, cols)))
            .select(*features.columns, F.col("__best.cluster").alias("cluster"), F.col("__best.d").alias("sq_distance")))


def silhouettes(assigned: DataFrame, by: str, label: str, cols: Sequence[str]) -> DataFrame:
    """(by, silhouette, points): mean silhouette with squared distances per value of ``by``, exact in O(points * K).

    Per cluster the count, the feature sums and the sum of squared norms give
    every point's mean distance to it; they travel as one array per ``by``, of
    which there are as many as clusterings, so the points stay where they are.
    """
    sq = F.lit(0.0)
    for c in cols:
        sq = sq + F.col(c) * F.col(c)
    pts = assigned.select(by, F.col(label).alias("__lab"), *cols, sq.alias("__sq"))
    stats = (pts.groupBy(by, "__lab").agg(F.count(F.lit(1)).alias("n"), F.sum("__sq").alias("q"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)])
             .groupBy(by).agg(F.collect_list(F.struct("__lab", "n", "q", *[f"s{i}" for i in range(len(cols))])).alias("__st")))

    def mean(s):
        dot = F.lit(0.0)
        for i, c in enumerate(cols):
            dot = dot + F.col(c) * s[f"s{i}"]
        return F.col("__sq") + (s["q"] - 2 * dot) / s["n"]

    own = F.element_at(F.filter("__st", lambda s: s["__lab"] == F.col("__lab")), 1)
    a = F.try_divide(mean(own) * own["n"], own["n"] - 1)
    b = F.array_min(F.transform(F.filter("__st", lambda s: s["__lab"] != F.col("__lab")), mean))
    j = pts.join(F.broadcast(stats), by).withColumn("__a", a).withColumn("__b", b).withColumn("__n", own["n"])
    value = (F.when(F.col("__n") == 1, 0.0).when(F.col("__a") < F.col("__b"), 1 - F.col("__a") / F.col("__b"))
             .when(F.col("__a") > F.col("__b"), F.col("__b") / F.col("__a") - 1).otherwise(0.0))
    return j.groupBy(by).agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("points"))


def kmeans_sweep(features: DataFrame, ks: Sequence[int] = range(2, 11), cols: Sequence[str] = (),
                 tol: float = 1e-4, max_iter: int = 1000) -> DataFrame:
    """Inertia, silhouette and steps of the best start per K; every step serves all K."""
    points = materialize(features.dropna(subset=list(cols)).select(*cols))
    fits = fit(points, list(ks), cols, tol, max_iter)
    spark = features.sparkSession
    table = spark.createDataFrame([(k, float(f[1]), f[2]) for k, f in fits.items()], "k long, inertia double, steps long")
    if not fits:
        return table.withColumn("silhouette", F.lit(None).cast("double"))
    assigned = _assigned(points, {k: f[0] for k, f in fits.items()}, cols).withColumn("k", F.col("run").cast("long"))
    return table.join(silhouettes(assigned, "k", "cluster", cols), "k").select("k", "inertia", "silhouette", "steps")
