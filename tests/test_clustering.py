import numpy as np
import pytest

from bazaar.operators import clustering as C

COLS = ["a", "b"]


def plain(points, k, tol=1e-4):
    """Lloyd's iteration from the bands of each feature, in numpy; the best start."""
    best = None
    for i in range(points.shape[1]):
        bounds = [np.quantile(points[:, i], j / k) for j in range(1, k)]
        band = np.array([sum(v <= b for b in bounds) for v in points[:, i]])
        cents = {c: points[band == c].mean(0) for c in sorted(set(band))}
        while True:
            ids = sorted(cents)
            d = np.stack([((points - cents[c]) ** 2).sum(1) for c in ids])
            near = np.array(ids)[d.argmin(0)]
            new = {c: points[near == c].mean(0) if (near == c).any() else cents[c] for c in ids}
            moved = sum(((new[c] - cents[c]) ** 2).sum() for c in ids)
            cents = new
            if moved <= tol:
                break
        inertia = np.stack([((points - c) ** 2).sum(1) for c in cents.values()]).min(0).sum()
        if best is None or round(inertia, 9) < round(best[0], 9):
            best = (inertia, sorted(map(tuple, cents.values()), reverse=True))
    return best


def blobs(n, seed):
    rng = np.random.default_rng(seed)
    centre = np.array([[0, 0], [4, 1], [-3, 5], [2, -4.0]])
    return centre[rng.integers(0, 4, n)] + rng.normal(size=(n, 2))


@pytest.mark.parametrize("layout", [1, 5])
def test_lloyd_against_numpy(spark, layout):
    x = blobs(300, 1)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double").repartition(layout)
    fits = C.fit(df, [2, 3, 4], COLS)
    for k in (2, 3, 4):
        inertia, cents = plain(x, k)
        assert fits[k][1] == pytest.approx(inertia, rel=1e-9)
        assert np.allclose(fits[k][0], cents, atol=1e-9)
    seg = {r.id: r for r in C.kmeans_segments(df, 4, COLS).collect()}
    cents = np.array(plain(x, 4)[1])
    for i, p in enumerate(x):
        d = ((cents - p) ** 2).sum(1)
        assert seg[i].cluster == int(d.argmin()) and seg[i].sq_distance == pytest.approx(d.min())


def test_silhouette_against_all_pairs(spark):
    x = blobs(60, 2)
    label = np.arange(60) % 3
    label[0] = 7                                       # a cluster of one point
    df = spark.createDataFrame([(1, int(c), float(a), float(b)) for c, (a, b) in zip(label, x)], "k long, c int, a double, b double")
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    s = []
    for i in range(60):
        own = (label == label[i]) & (np.arange(60) != i)
        if not own.any():
            s.append(0.0)
            continue
        a, b = d[i][own].mean(), min(d[i][label == c].mean() for c in set(label) if c != label[i])
        s.append((b - a) / max(a, b))
    row = C.silhouettes(df, "k", "c", COLS).first()
    assert row.silhouette == pytest.approx(np.mean(s), rel=1e-9) and row.points == 60


def test_nulls_ties_and_few_points(spark):
    schema = "id long, a double, b double"
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 5.0, 5.0), (4, None, 1.0)], schema)
    out = {r.id: (r.cluster, r.sq_distance) for r in C.kmeans_segments(df, 4, COLS).collect()}
    assert out[4] == (None, None) and out[1] == out[2] == (1, 0.0) and out[3] == (0, 0.0)
    assert C.kmeans_segments(spark.createDataFrame([], schema), 3, COLS).collect() == []
    assert [r.cluster for r in C.kmeans_segments(spark.createDataFrame([(1, None, None)], schema), 3, COLS).collect()] == [None]
    assert C.kmeans_sweep(spark.createDataFrame([], schema), [2, 3], COLS).collect() == []
    one = C.kmeans_sweep(df, [1, 2], COLS).orderBy("k").collect()
    assert [r.k for r in one] == [1, 2] and one[1].inertia == 0.0


def test_step_sums_in_blocks(spark):
    x = blobs(500, 5)
    x[3] = x[4] = [1.0, 1.0]                            # as near to the first as to the second centroid: the lower one
    state = {200: [(0.0, 1.0), (2.0, 1.0)], 301: [(4.0, 1.0), None, (-3.0, 5.0)], 202: [(9e9, 9e9), (0.0, 0.0)]}
    df = spark.createDataFrame(x.tolist(), "a double, b double").repartition(3)
    blocks = C._packed(df, COLS)
    assert blocks.count() <= 4 and C._sums(C._packed(df.limit(0), COLS), state, COLS).collect() == []
    got = {(r.run, r.cluster): r for r in C._sums(blocks, state, COLS).collect()}
    want = set()
    for run, cents in state.items():
        ids = [i for i, c in enumerate(cents) if c]
        d = np.stack([((x - np.array(cents[i])) ** 2).sum(1) for i in ids])
        near = np.array(ids)[d.argmin(0)]
        for i in set(near.tolist()):
            own, r = x[near == i], got[run, i]
            want.add((run, i))
            assert r.n == len(own) and np.allclose((r.s0, r.s1), own.sum(0)) and np.isclose(r.d, d.min(0)[near == i].sum())
    assert set(got) == want and (202, 0) not in got


def test_points_stay_where_they_are_for_silhouettes(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 1.0), (1, 1, 2.0, 3.0)], "k long, c int, a double, b double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = C.silhouettes(df, "k", "c", COLS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
