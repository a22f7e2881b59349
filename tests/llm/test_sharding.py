from collections import Counter

from tests.llm.helpers import crc, documents
from pyspark.sql import functions as F

from bazaar.llm.sharding import shuffle_shards, write_shards

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "", r["shard"], r["slot"]) for r in df.collect())


def check_law(rows, n_shards):
    by = {}
    for _, _, shard, slot in rows:
        by.setdefault(shard, []).append(slot)
    counts = [len(by.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_permutation_law_and_determinism(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = rows_of(shuffle_shards(docs, bucket_bytes=20_000))
    check_law(a, 24)
    assert Counter((i, t) for i, t, _, _ in a) == Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert a == rows_of(shuffle_shards(docs.repartition(7), bucket_bytes=20_000))      # input layout does not matter
    assert a != rows_of(shuffle_shards(docs, seed=18, bucket_bytes=20_000))
    order = [i for i, _, s, p in sorted(a, key=lambda r: (r[2], r[3]))]
    rising = sum(x < y for x, y in zip(order, order[1:])) / len(order)
    assert 0.35 < rising < 0.65                                                        # no trace of the input order


def test_uniform_over_seeds(spark):
    docs = documents(spark, [f"t{i}" for i in range(30)])
    at = Counter()
    for seed in range(40):
        for r in shuffle_shards(docs, n_shards=3, seed=seed, bucket_bytes=60).collect():
            if r["doc_id"] == 4:
                at[r["shard"]] += 1
    assert min(at[s] for s in range(3)) >= 4


def test_edges(spark):
    docs = documents(spark, [(1, None), (None, "x"), (None, None), (2, ""), (3, "dup"), (3, "dup"), (4, "long " * 50_000)],
                     {"SHARD": 9, "slot": "old"})
    out = shuffle_shards(docs, n_shards=24, bucket_bytes=1000)
    rows = rows_of(out)
    check_law(rows, 24)
    assert len(rows) == 7
    sizes = {r["doc_id"]: r["size"] for r in out.collect()}
    assert sizes[1] == 8 and sizes[4] == 250_008
    assert shuffle_shards(docs.limit(0)).count() == 0
    assert out.columns.count("shard") == 1 and "SHARD" not in out.columns


def test_written_shards_keep_order(spark, tmp_path):
    docs = documents(spark, [f"t{i}" for i in range(50)])
    out = shuffle_shards(docs, n_shards=4, bucket_bytes=100)
    write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows_of(back) == rows_of(out)


def test_query(spark):
    from bazaar.llm.queries import QUERIES
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    assert all(r["text_crc32"] == crc(docs[r["doc_id"]]) and r["law"] == "rows" and r["grown_shard"] is None for r in rows)
    assert all(r["size"] == len((docs[r["doc_id"]] or "").encode()) + 8 for r in rows)
    plan = QUERIES["op2_sharding"](spark, SF).select(F.count("*"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_spread_over_buckets(spark):
    """A third of all rows alike, and as many with null id and text: no bucket holds them all."""
    docs = documents(spark, [(i, f"text {i} " * 5) for i in range(300)] + [(7, "same row " * 5)] * 300 + [(None, None)] * 300)
    out = shuffle_shards(docs, n_shards=3, bucket_bytes=2000)
    a = rows_of(out)
    check_law(a, 3)
    assert Counter((i, t) for i, t, _, _ in a) == Counter((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in docs.collect())
    assert a == rows_of(shuffle_shards(docs.repartition(5), n_shards=3, bucket_bytes=2000))
    # a bucket is a run of places: neither kind fills a long one
    placed = [i for i, _, _, _ in sorted(a, key=lambda r: (r[2], r[3]))]
    for kind in (7, -1):
        assert all(placed[k:k + 60].count(kind) < 50 for k in range(0, len(placed), 20))
