"""Hard-negative mining: threshold joins over an inverted index with suffix-norm bounds, lowered until windows fill."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, saved

PANEL = 8                        # dimensions accumulated between two prunings
CELLS = 2_000_000                # partial scores held at once (16 MB)
_LIMIT = 2 ** 63 - 1
_POSITIVES = "a_id long, a_key long, id long, key long, score long"
_NEGATIVES = "a_id long, a_key long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


class ThresholdIndex:
    """Inverted index of a block of integer vectors for joins "inner product >= t".

    Dimensions are taken heaviest first.  For a lowest threshold t and a
    largest anchor norm, a row's trailing dimensions are left out of the lists
    as soon as the norm of that suffix cannot reach t any more: a row that
    shares no posted dimension with an anchor is never a result.  Rows are
    ordered by their number of posted dimensions, so the list of a dimension is
    a leading slice of the rows.
    """

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows * rows).sum(0), kind="stable")
        self.rows = np.ascontiguousarray(rows[:, self.order])
        self.norms = self._suffix_norms(self.rows)
        self.top = float(np.abs(rows).max(initial=0))

    @staticmethod
    def _suffix_norms(m: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from k on, for every k (d + 1 columns; a little above the truth)."""
        squares = np.concatenate([(m * m)[:, ::-1].cumsum(1)[:, ::-1], np.zeros((len(m), 1))], axis=1)
        return np.sqrt(squares) * (1 + 1e-9)

    def join(self, anchors: np.ndarray, t: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All (anchor, row, score) with score >= t[anchor], some whole anchors at a time."""
        step = max(1, CELLS // max(len(self.rows), 1))
        a = anchors[:, self.order]
        exact = self.top * float(np.abs(a).max(initial=0)) * max(a.shape[1], 1) < 2 ** 53
        for lo in range(0, len(a), step):
            part, floor = a[lo:lo + step], t[lo:lo + step]
            i, j, s = self._block(part, floor) if exact else self._wide(part, floor)
            yield i + lo, j, s

    def _block(self, a: np.ndarray, t: np.ndarray):
        n, d = self.rows.shape
        a_norms = self._suffix_norms(a)
        # posted dimensions of each row: up to where its suffix can no longer reach the lowest threshold
        reach = self.norms[:, :d] * a_norms[:, :d].max(0) + 0.5 >= t.min()
        posted = np.minimum(-(-reach.sum(1) // PANEL) * PANEL, d)
        alive = np.argsort(-posted, kind="stable")
        alive = alive[:np.count_nonzero(posted)]
        posted = posted[alive]
        done, scores = 0, np.zeros((len(a), len(alive)))
        out_i, out_j, out_s = [], [], []

        def verify(columns: np.ndarray, upto: int):
            """Pairs of some finished rows whose bound still reaches: add the dimensions left out."""
            bound = scores[:, columns] + a_norms[:, upto, None] * self.norms[alive[columns], upto] + 0.5
            i, k = np.nonzero(bound >= t[:, None])
            s, j = scores[i, columns[k]], alive[columns[k]]
            for at in range(0, len(i), CELLS // 16):
                cut = slice(at, at + CELLS // 16)
                s[cut] += np.einsum("ij,ij->i", a[i[cut], upto:], self.rows[j[cut], upto:])
            keep = s >= t[i]
            out_i.append(i[keep]), out_j.append(j[keep]), out_s.append(s[keep])

        while len(alive) and done < d:
            upto = min(done + PANEL, d)
            scores += a[:, done:upto] @ self.rows[alive, done:upto].T
            done = upto
            bound = scores + a_norms[:, done, None] * self.norms[alive, done] + 0.5
            possible = bound >= t[:, None]
            able = possible.any(0)
            few = possible.sum() * 20 < possible.size       # hardly any pair left: finish them one by one
            ends = able & ((posted <= done) | few)
            if ends.any():
                verify(np.flatnonzero(ends), done)
            stay = able & ~ends
            if not stay.all():
                alive, posted, scores = alive[stay], posted[stay], scores[:, stay]
        if len(alive) and done >= d:
            verify(np.arange(len(alive)), d)
        if not out_i:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_i), np.concatenate(out_j), np.concatenate(out_s).astype(np.int64)

    def _wide(self, a: np.ndarray, t: np.ndarray):
        """Scores beyond exact doubles: whole products in unbounded integers, saturated at 64 bits."""
        if not hasattr(self, "whole"):
            self.whole = np.array([[int(x) for x in r] for r in self.rows], dtype=object).reshape(self.rows.shape)
        big = np.array([[int(x) for x in r] for r in a], dtype=object).reshape(a.shape) @ self.whole.T
        s = np.array([max(-_LIMIT, min(_LIMIT, int(v))) for v in big.ravel()], dtype=np.int64).reshape(len(a), -1)
        i, j = np.nonzero(s >= t[:, None])
        return i, j, s[i, j]


def _table(table: pa.Table, scale: float):
    """(anchors, rows): ids, keys, labels and floored vectors of one tile; rows by id."""
    d = table["dims"][0].as_py()
    m = np.floor(scale * table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d))
    ids, keys, labels = (table[c].to_numpy() for c in ("id", "key", "label"))
    is_anchor = table["is_anchor"].to_numpy(zero_copy_only=False)
    anchors = np.flatnonzero(is_anchor)
    rows = np.flatnonzero(~is_anchor)
    rows = rows[np.lexsort((keys[rows], ids[rows]))]
    return m, ids, keys, labels, anchors, rows


def _best_first(i, j, s):
    """Pairs by anchor, score (high first) and row; the rows are in id order, so ties go to the smaller id."""
    o = np.lexsort((j, -s, i))
    return i[o], j[o], s[o]


def _tile_positives(k: int, scale: float):
    def find(table: pa.Table) -> pa.Table:
        m, ids, keys, labels, anchors, rows = _table(table, scale)
        out = []
        anchors = anchors[np.isin(labels[anchors], labels[rows])]
        for label in np.unique(labels[anchors]):
            mine, same = anchors[labels[anchors] == label], rows[labels[rows] == label]
            index = ThresholdIndex(m[same])
            top = np.sqrt((m[mine] ** 2).sum(1)) * index.norms[:, 0].max(initial=0)
            level, open_ = 0.8, np.arange(len(mine))
            while len(open_):
                t = top[open_] * level if level > 0.1 else np.full(len(open_), -np.inf)
                left = []
                for i, j, s in index.join(m[mine[open_]], t):
                    other = ids[same[j]] != ids[mine[open_[i]]]
                    i, j, s = _best_first(i[other], j[other], s[other])
                    nth = np.arange(len(i)) - np.searchsorted(i, i)
                    full = np.bincount(i, minlength=len(open_)) >= k
                    take = (nth < k) & (full[i] | (level <= 0.1))
                    a = mine[open_[i[take]]]
                    out.append((ids[a], keys[a], ids[same[j[take]]], keys[same[j[take]]], s[take]))
                    left.append(np.flatnonzero(full))
                if level <= 0.1:
                    break
                filled = np.concatenate(left) if left else np.zeros(0, np.int64)
                open_ = np.delete(open_, np.unique(filled))
                level *= 0.75
        cols = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 5)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a_id", "a_key", "id", "key", "score"), cols)})
    return find


def _tile_negatives(k: int, scale: float):
    def find(table: pa.Table) -> pa.Table:
        m, ids, keys, labels, anchors, rows = _table(table, scale)
        index = ThresholdIndex(m[rows])
        wins = table["wins"].to_pylist()
        open_ = {a: [(w["place"], w["id"], w["score"], w["low"], w["high"]) for w in wins[a]] for a in anchors.tolist()}
        out, share = [], 1 / 16
        while open_:
            at = np.array(sorted(open_), dtype=np.int64)
            high = np.array([max(w[4] for w in open_[a]) for a in at.tolist()], dtype=np.float64)
            low = np.array([min(w[3] for w in open_[a]) for a in at.tolist()], dtype=np.float64)
            t = np.floor(high - (high - low) * share) if share < 1 else low
            for i, j, s in index.join(m[at], t):
                other = (labels[rows[j]] != labels[at[i]]) & (ids[rows[j]] != ids[at[i]])
                i, j, s = _best_first(i[other], j[other], s[other])
                who, first = np.unique(i, return_index=True)
                for x, lo, hi in zip(who.tolist(), first.tolist(), [*first[1:].tolist(), len(i)]):
                    a, rest, falling = int(at[x]), [], -s[lo:hi]
                    for w in open_[a]:
                        start, end = np.searchsorted(falling, -w[4]), np.searchsorted(falling, -w[3], side="right")
                        if end - start >= k or t[x] <= w[3]:
                            for p in range(lo + start, lo + min(start + k, end)):
                                out.append((ids[a], keys[a], *w[:3], ids[rows[j[p]]], s[p]))
                        else:
                            rest.append(w)
                    open_[a] = rest
            # windows that the threshold has passed are done, whether or not it found rows
            floor = dict(zip(at.tolist(), t.tolist()))
            open_ = {a: ws for a in open_ if (ws := [w for w in open_[a] if floor[a] > w[3]])}
            share *= 2
        names = [c.split()[0] for c in _NEGATIVES.split(", ")]
        cols = list(zip(*out)) if out else [()] * len(names)
        types = [pa.int32() if n == "place" else pa.int64() for n in names]
        return pa.table({n: pa.array(np.array(c, dtype=np.int64), pa.int64()).cast(t) for n, c, t in zip(names, cols, types)})
    return find


def labelled_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec, dims, key): whole, finite, labelled vectors with an id; repeated rows once."""
    ok = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ok)
            .where(F.size(vec_col) > 0)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                    F.col(vec_col).alias("vec")).distinct())
    return rows.withColumn("dims", F.size("vec")).withColumn("key", F.xxhash64("id", "label", "vec"))


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3,
                        low: int = 50, high: int = 95, id_col: str = "vec_id", vec_col: str = "embedding",
                        label_col: str = "label", scale: float = 256.0, tile_bytes: int = 32 << 20,
                        block_bytes: int = 16 << 20) -> DataFrame:
    """Rows of another label that score between ``low`` and ``high`` percent of an anchor's positives.

    Vectors become floor(scale * x); a score is the integer inner product.  An
    anchor (a row where ``is_anchor`` over the column ``id`` holds) has as
    positives its ``n_positives`` best other rows of its label; per positive the
    ``n_negatives`` best rows of other labels with low * positive <= 100 *
    negative <= high * positive are returned.  Ties go to the smaller id.

    Both searches are threshold joins of blocks of anchors with shards of rows
    (sizes follow from the bytes of a vector).  In a tile a
    :class:`ThresholdIndex` leaves out dimensions that suffix norms cover,
    accumulates partial scores and prunes pairs by the norms that remain; the
    threshold of an anchor falls until its positives, then its windows, are full
    or the window's lower end is reached, so every tile gives its exact best
    rows and their union holds the best of all.  A row is copied once for
    every block of anchors (tens of thousands), an anchor once per shard.

    Null ids, labels and vectors, empty vectors and null or non-finite
    components take no part; repeated (id, label, vector) rows count once; a
    row is never its own anchor's positive or negative, nor are other rows of
    the anchor's id; vectors of different lengths are never compared; scores
    beyond 64 bits saturate; labels are whole numbers of at most 64 bits; other
    columns are ignored; an empty table gives no rows.
    Returns anchor_id long, positive_id long, rank int (from 1), negative_id
    long, positive_score long, negative_score long.
    """
    spark = prepared(vectors.sparkSession)
    rows = saved(labelled_vectors(vectors, id_col, vec_col, label_col).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "labelled")
    n, n_a, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_anchor").cast("long")), F.lit(0)),
                             F.coalesce(F.max("dims"), F.lit(1))).first()
    tasks = spark.sparkContext.defaultParallelism
    shards = max(1, -(-n * width * 8 // tile_bytes), min(2 * tasks, n // 2048))
    blocks = max(1, -(-n_a * width * 8 // block_bytes))
    given = rows.select("id", "key", "label", "dims", "vec", F.pmod("key", F.lit(shards)).cast("int").alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(False).alias("is_anchor"))

    def tiles(anchors: DataFrame):
        asked = (anchors.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
                 .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("is_anchor", F.lit(True)))
        return asked.unionByName(given, allowMissingColumns=True).groupBy("dims", "block", "shard")

    anchors = rows.where("is_anchor").select("id", "key", "label", "dims", "vec")
    found = tiles(anchors).applyInArrow(_tile_positives(n_positives, scale), _POSITIVES)
    place = F.row_number().over(Window.partitionBy("a_id", "a_key").orderBy(F.col("score").desc(), "id", "key"))
    positives = found.withColumn("place", place).where(F.col("place") <= n_positives)
    # the window in whole scores: ceil(low * s / 100) to floor(high * s / 100), in decimals so that no product overflows
    s = F.col("score").cast("decimal(20,0)")
    bounds = positives.select("a_id", "a_key", "place", "id", "score", F.ceil(s * low / 100).cast("long").alias("low"),
                              F.floor(s * high / 100).cast("long").alias("high"))
    wins = (bounds.where(F.col("low") <= F.col("high")).groupBy("a_id", "a_key")
            .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score", "low", "high"))).alias("wins")))
    asked = anchors.join(wins, (F.col("key") == F.col("a_key")) & (F.col("id") == F.col("a_id"))).drop("a_id", "a_key")
    negatives = tiles(asked).applyInArrow(_tile_negatives(n_negatives, scale), _NEGATIVES)
    order = Window.partitionBy("a_id", "a_key", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return (negatives.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
            .select(F.col("a_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
