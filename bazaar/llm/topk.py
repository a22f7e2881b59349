"""Exact top-k search: tiled matrix products, partial selection per tile, tree merge."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import prepared

_TILE = pa.schema([("query_id", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def finite_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec) rows whose id is not null and whose vector is whole and finite; repeated rows once."""
    ok = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ok)
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .distinct())


def _inner(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of floored vectors; BLAS while every partial sum is below 2^53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if top < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in c], dtype=object).T
    lim = 2 ** 63 - 1
    return np.array([[max(-lim, min(lim, v)) for v in r] for r in big], dtype=np.int64).reshape(big.shape)


def _tile(k: int, scale: float):
    def select(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        is_query = table["is_query"].to_numpy(zero_copy_only=False)
        d = table["dims"][0].as_py()
        m = np.floor(scale * table["vec"].combine_chunks().flatten().to_numpy().reshape(len(ids), d))
        order = np.argsort(ids[~is_query], kind="stable")           # ties go to the smaller id
        c_id, c = ids[~is_query][order], m[~is_query][order]
        q_id, q = ids[is_query], m[is_query]
        if not len(q_id) or not len(c_id):
            return _TILE.empty_table()
        s = _inner(q, c)
        own = q_id[:, None] == c_id[None, :]
        kk = min(k, len(c_id))
        if kk < len(c_id):
            # partial selection: all above the (k + own)-th score, then an exact order of the few kept
            need = min(kk + int(own.sum(1).max(initial=0)), len(c_id))
            floor_ = np.partition(s, len(c_id) - need, axis=1)[:, len(c_id) - need]
            rows, cols = np.nonzero((s >= floor_[:, None]) & ~own)
        else:
            rows, cols = np.nonzero(~own)
        v = s[rows, cols]
        o = np.lexsort((c_id[cols], -v, rows))
        rows, cols, v = rows[o], cols[o], v[o]
        first = np.searchsorted(rows, rows)
        keep = np.arange(len(rows)) - first < kk
        rows, cols, v = rows[keep], cols[keep], v[keep]
        shard = np.full(len(rows), table["shard"][0].as_py(), dtype=np.int32)
        return pa.table([pa.array(q_id[rows]), pa.array(shard), pa.array(c_id[cols]), pa.array(v)], schema=_TILE)
    return select


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: float = 256.0,
                tile_queries: int = 512, tile_rows: int = 2048, fan_in: int = 32) -> DataFrame:
    """The ``k`` highest integer inner products per query over every other row.

    Vectors become floor(scale * x).  Queries (rows where ``is_query`` over the
    id holds) are hashed into blocks of about ``tile_queries`` and candidates
    into shards of about ``tile_rows``; each (block, shard) tile is one matrix
    product whose rows keep their k best by partial selection.  Per-query lists
    are merged ``fan_in`` shards at a time and then once more, so a task holds
    one tile and a merge holds fan_in * k rows.  Nothing is broadcast.

    Ties go to the smaller id.  Null, null-holding and non-finite vectors and
    null ids take no part; repeated (id, vector) rows count once; vectors of
    different lengths are never compared; scores beyond 64 bits saturate; an
    empty input gives no rows.
    Returns query_id long, rank int (from 1), vec_id long, score long.
    """
    prepared(vectors.sparkSession)
    clean = finite_vectors(vectors, id_col, vec_col).withColumn("dims", F.size("vec"))
    clean = clean.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    n, n_q = clean.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0))).first()
    blocks, shards = max(1, -(-n_q // tile_queries)), max(1, -(-n // tile_rows))
    spot = F.xxhash64("id", "vec")
    asked = (clean.where("is_query")
             .withColumn("block", F.pmod(spot, F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    given = (clean.withColumn("is_query", F.lit(False))
             .withColumn("shard", F.pmod(spot, F.lit(shards)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    tiles = asked.unionByName(given).groupBy("dims", "block", "shard")
    lists = tiles.applyInArrow(_tile(k, scale), "query_id long, shard int, vec_id long, score long")
    best = [F.col("score").desc(), F.col("vec_id")]
    branch = F.floor(F.col("shard") / fan_in)
    lists = (lists.withColumn("branch", branch)
             .withColumn("r", F.row_number().over(Window.partitionBy("query_id", "branch").orderBy(*best)))
             .where(F.col("r") <= k))
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
