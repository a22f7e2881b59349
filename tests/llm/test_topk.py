import numpy as np
from pyspark.sql import functions as F

from bazaar.llm.topk import exact_top_k

COLS = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    ok = {(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    z = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in sorted(ok)]
    out = set()
    for q, a in z:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in z if c != q and len(a) == len(b))[:k]
            out |= {(q, r + 1, c, -v) for r, (v, c) in enumerate(s)}
    return out


def run(spark, rows, every=5, k=5, **kw):
    df = spark.createDataFrame(rows, COLS)
    return {tuple(r) for r in exact_top_k(df, F.col("id") % every == 0, k, **kw).collect()}


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)], 1) for i in range(90)]
    rows += [(100 + i, rows[7][1], 2) for i in range(20)]                    # ties: one vector many times
    rows += [rows[3], rows[3]]                                               # repeated rows
    for tiles in ({}, {"tile_queries": 4, "tile_rows": 9, "fan_in": 3}):
        assert run(spark, rows, **tiles) == brute(rows, 5, 5)


def test_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0], 1), (5, [1.0, -0.3], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1),
            (4, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (6, [3.0], 1), (10, [2.0, 2.0, 2.0], 1)]
    assert run(spark, rows) == brute(rows, 5, 5) == {(0, 1, 5, 256 * 256 + 512 * -77), (5, 1, 0, 256 * 256 + 512 * -77)}
    assert run(spark, []) == set()
    big = [(0, [2e6, 1.0], 1), (1, [2e6, 0.5], 1), (2, [-2e6, 0.25], 1)]     # beyond exact doubles
    assert run(spark, big, 5, 2) == brute(big, 5, 2)


def test_oracle(spark):
    import duckdb

    from bazaar.llm.queries import QUERIES
    from bazaar.llm.sql import SQL
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("op4_chat_formatting", "op8_topk_search", "op11_hard_negatives"):
        text = SQL[name]
        df = QUERIES[name](spark, sf)
        want = con.execute(text).df()[df.columns]
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.itertuples(index=False))), name
