import numpy as np
from pyspark.sql import functions as F

from bazaar.llm.negatives import ThresholdIndex, mine_hard_negatives

COLS = "vec_id long, embedding array<float>, label int"


def brute(rows, every, n_pos=5, n_neg=3):
    """Full sorts in whole numbers."""
    ok = sorted({(i, lab, tuple(v)) for i, v, lab in rows if i is not None and lab is not None and v
                 and None not in v and np.isfinite(v).all()})
    z = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in ok]
    out = []
    for a, la, x in z:
        if a % every:
            continue
        s = [(-sum(p * q for p, q in zip(x, y)), b, lb) for b, lb, y in z if b != a and len(x) == len(y)]
        for v, b, lb in sorted(t for t in s if t[2] == la)[:n_pos]:
            near = sorted(t for t in s if t[2] != la and 50 * -v <= 100 * -t[0] <= 95 * -v)[:n_neg]
            out += [(a, b, r + 1, c, -v, -w) for r, (w, c, _) in enumerate(near)]
    return sorted(out)


def run(spark, rows, every=5, extra=None, **kw):
    df = spark.createDataFrame(rows, COLS)
    for name in extra or ():
        df = df.withColumn(name, F.lit("x"))
    return sorted(tuple(r) for r in mine_hard_negatives(df, F.col("id") % every == 0, **kw).collect())


def vectors(n, d, labels, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, d))
    lab = rng.integers(0, labels, n)
    m = (0.6 * centre[lab] + rng.normal(size=(n, d)) + 0.7).astype(np.float32)
    return [(i, [float(x) for x in m[i]], int(lab[i])) for i in range(n)]


def test_index_gives_every_pair_above_the_threshold():
    rng = np.random.default_rng(5)
    rows = np.floor(256 * rng.normal(size=(300, 21)) * rng.uniform(0.1, 2, size=21))
    anchors = np.floor(256 * rng.normal(size=(17, 21)))
    whole = anchors @ rows.T
    index = ThresholdIndex(rows)
    for share in (0.001, 0.05, 0.5, 1.0):
        t = np.quantile(whole, 1 - share, axis=1)
        got = [(i, j, s) for part in index.join(anchors, t) for i, j, s in zip(*part)]
        want = [(i, j, whole[i, j]) for i, j in zip(*np.nonzero(whole >= t[:, None]))]
        assert sorted(got) == sorted(want)


def test_against_brute_force(spark):
    rows = vectors(160, 12, 3, 1)
    rows += [(1000 + i, rows[7][1], 1 + i % 2) for i in range(12)]               # ties
    rows += [rows[3], rows[5], rows[5]]                                          # repeated rows
    want = brute(rows, 5)
    assert len(want) > 100
    for tiles in ({}, {"tile_bytes": 2000, "block_bytes": 1000}):
        assert run(spark, rows, **tiles) == want


def test_one_label_holds_most_rows(spark):
    rows = [(i, v, 0 if i % 10 else 1) for i, v, _ in vectors(150, 9, 2, 2)]
    assert run(spark, rows) == brute(rows, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 4, 2, 3) + [(None, [1.0] * 4, 1), (100, None, 1), (105, [1.0, None, 1.0, 1.0], 1), (110, [nan, 1.0, 1.0, 1.0], 0),
                                   (115, [inf, 1.0, 1.0, 1.0], 0), (120, [1.0] * 4, None), (125, [], 1), (130, [1.0, 2.0], 1),
                                   (135, [1.0, 2.0], 1), (136, [1.0, 1.0], 2), (140, [0.0] * 4, 1), (145, [-1.0] * 4, 0)]
    assert run(spark, rows, extra=("id", "key", "shard", "dims")) == brute(rows, 5)
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0], 1)]) == []
    big = [(0, [3e6, 1.0], 1), (1, [3e6, 0.5], 1), (2, [2.4e6, 0.25], 2), (3, [2.5e6, 1e6], 2), (4, [2.9e6, 7.0], 2)]
    assert run(spark, big) == brute(big, 5) != []                                # beyond exact doubles
