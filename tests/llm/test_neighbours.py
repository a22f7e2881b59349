import numpy as np

from bazaar.llm.neighbours import embedding_duplicates

COLS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = (label, np.array(v, dtype=np.float32).astype(float))
    par = {i: i for i, _, _ in rows if i is not None}
    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    n = dict.fromkeys(par, 0)
    ids = sorted(ok)
    for a in ids:
        for b in ids:
            (la, x), (lb, y) = ok[a], ok[b]
            if a < b and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                n[a] += 1
                n[b] += 1
                lo, hi = sorted((find(a), find(b)))
                par[hi] = lo
    return {i: (n[i], find(i), find(i) == i) for i in par}


def run(spark, rows, **kw):
    got = embedding_duplicates(spark.createDataFrame(rows, COLS), **kw).collect()
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for label in (1, 2):
        centres = rng.normal(size=(12, 16))
        for k, c in enumerate(centres):
            for _ in range(60 if k == 0 else rng.integers(1, 9)):                # one group far beyond a list
                rows.append((i, [float(x) for x in (c + rng.normal(size=16) * 0.09 * np.abs(c).mean()).astype(np.float32)], label))
                i += 1
    rows += [(i + k, rows[0][1], 1) for k in range(40)]                          # one vector many times
    rows += [(i + 50, [2 * x for x in rows[0][1]], 1), (i + 51, rows[0][1], 2)]
    want = brute(rows)
    assert max(n for n, _, _ in want.values()) > 60 and sum(not k for _, _, k in want.values()) > 60
    assert run(spark, rows, leaf_rows=32, tile_rows=16) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [-1.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [], 1),
            (13, [3e38, 0.0], 1), (14, [1e-40, 0.0], 1)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows)[1] == (3, 1, True)
    assert run(spark, []) == {}
    twice = embedding_duplicates(spark.createDataFrame([*rows[:2], rows[1], (None, [1.0, 0.0], 1)], COLS)).collect()
    assert len(twice) == 4 and sorted((r["vec_id"] or 0, r["n_links"]) for r in twice) == [(0, 0), (1, 1), (2, 1), (2, 1)]


def test_families_beyond_saturated_lists_are_joined(spark):
    """Two families, 0.999 alike within and 0.985 across: no list holds a cross link."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=32)
    a /= np.linalg.norm(a)
    b = rng.normal(size=32)
    b -= (b @ a) * a
    b = 0.985 * a + np.sqrt(1 - 0.985 ** 2) * b / np.linalg.norm(b)
    rows = [(k, [float(x) for x in ((a, b)[k % 2] + rng.normal(size=32) * 0.003).astype(np.float32)], 1) for k in range(300)]
    rows += [(300 + k, [float(x) for x in rng.normal(size=32).astype(np.float32)], 1) for k in range(20)]
    want = brute(rows)
    assert sum(k for _, _, k in want.values()) == 21 and want[0][0] > 200
    assert run(spark, rows, tile_rows=64) == want


def test_lost_small_groups_fail_the_audit(spark):
    """A hot group with all its links does not hide pairs that one coarse tree misses."""
    rng = np.random.default_rng(9)
    hot = rng.normal(size=24)
    near = lambda c: [float(x) for x in (c + rng.normal(size=24) * 0.02).astype(np.float32)]
    rows = [(k, near(hot), 1) for k in range(300)]
    for k in range(120):
        c = rng.normal(size=24)
        rows += [(1000 + 2 * k, near(c), 1), (1001 + 2 * k, near(c), 1)]
    want = brute(rows)
    assert want[1][0] > 250 and sum(want[1000 + k][0] for k in range(240)) >= 230
    assert run(spark, rows, trees=1, leaf_rows=2, turns=1, max_tries=1, tile_rows=64) == want
