"""Spelling variants: dense prefix-suffix tiling of padded code-point matrices, and chains of forms."""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, saved

RUN = "[a-z\u00C0-\u00FF]+"      # after A-Z are lower-cased
WINDOWS = 3                      # parts of a word; an edit lies in one, the others are a key
CELLS = 1 << 22                  # code points compared at once
BLOCK = 4096                     # words of one key compared at once
_PARTIAL = "word string, n_near long, form_n long, form string"


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = RUN,
                min_length: int = 6, min_count: int = 5, thin: int | None = 199, held: int = 200_000) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points with at least ``min_count`` occurrences in all texts.

    Only A-Z are lower-cased; words are the maximal runs of ``pattern``.  Where
    ``thin`` divides h, the crc32 of "<id>:<run>", the run loses its code point
    h % length (None: runs stay).  A task counts the words of its rows and hands
    the counts on whenever it holds ``held`` words, so one very frequent word is
    summed before the shuffle.  Null texts have no words; a null id is written
    as nothing.
    """
    find = re.compile(pattern).findall

    def count(batches):
        total: Counter = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                               names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{i or ''}:".encode())
                for run, k in Counter(find(text.encode().lower().decode())).items():
                    if len(run) < min_length:
                        continue
                    if thin:
                        h = zlib.crc32(run.encode(), start)
                        if h % thin == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < min_length:
                                continue
                    total[run] += k
                if len(total) >= held:
                    yield rows()
        yield rows()

    parts = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string"), F.col(text_col))
             .mapInArrow(count, "word string, n long"))
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code-point matrices of the words, aligned to the left and to the right; 0 where a word has no point."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    kind = np.uint16 if not len(flat) or flat.max() < 0xFFFF else np.uint32
    left, right = np.zeros((len(words), width), kind), np.zeros((len(words), width), kind)
    left[row, at] = flat + 1
    right[row, width - 1 - (np.repeat(size, size) - 1 - at)] = flat + 1
    return left, right


def single_edits(left: np.ndarray, right: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray):
    """(near, prefix, suffix) of the pairs (a, b): near if common prefix plus common suffix reach the
    longer length less one and the words differ."""
    width = left.shape[1]
    same = left[a] == left[b]
    prefix = np.where(same.all(1), width, same.argmin(1))
    same = right[a] == right[b]
    suffix = np.where(same.all(1), width, same[:, ::-1].argmin(1))
    longer = np.maximum(size[a], size[b])
    whole = np.minimum(size[a], size[b])
    prefix, suffix = np.minimum(prefix, whole), np.minimum(suffix, whole)
    differ = (prefix < whole) | (size[a] != size[b])
    return differ & (prefix + suffix >= longer - 1), prefix, suffix


def edges(length: int, window: int) -> tuple[int, int]:
    """Code points before and after a window of a word of ``length``."""
    return length * window // WINDOWS, length - length * (window + 1) // WINDOWS


def _pairs(group: np.ndarray, limit: int):
    """All index pairs a < b within equal runs of the sorted ``group``, about ``limit`` at a time."""
    n = len(group)
    count = np.searchsorted(group, group, side="right") - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(count)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, side="right")) - 1)
        c = count[lo:hi]
        a = np.repeat(np.arange(lo, hi), c)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        lo = hi


def _tiles(table: pa.Table) -> pa.Table:
    """Near words within the tiles of one bucket: per word their number and the best candidate for its form."""
    words = table["word"].to_pylist()
    names = sorted(set(words))
    rank = {w: i for i, w in enumerate(names)}
    ident = np.fromiter(map(rank.__getitem__, words), dtype=np.int64, count=len(words))
    n = np.zeros(len(names), dtype=np.int64)
    n[ident] = table["n"].to_numpy()
    length, window, key, block, i, j = (table[c].to_numpy() for c in ("length", "window", "key", "block", "i", "j"))
    longer = table["longer"].to_numpy(zero_copy_only=False)
    found = []
    for cls in np.unique(length).tolist():
        rows = np.flatnonzero(length == cls)
        rows = rows[np.lexsort((j[rows], i[rows], key[rows], window[rows]))]
        tile = np.stack([window[rows], key[rows], i[rows], j[rows]])
        group = np.concatenate([[0], np.cumsum((tile[:, 1:] != tile[:, :-1]).any(0))])
        left, right = padded([words[r] for r in rows.tolist()], cls + 1)
        size, long_, across, own = cls + longer[rows], longer[rows], i[rows] != j[rows], block[rows]
        bounds = [edges(cls, w) for w in range(WINDOWS)]
        for a, b in _pairs(group, max(1, CELLS // (cls + 1))):
            # two longer words meet in their own class; a tile of two blocks compares only across them
            keep = ~(long_[a] & long_[b]) & (~across[a] | (own[a] != own[b]))
            a, b = a[keep], b[keep]
            near, prefix, suffix = single_edits(left, right, size, a, b)
            a, b, prefix, suffix = a[near], b[near], prefix[near], suffix[near]
            first = np.full(len(a), WINDOWS)
            for w in reversed(range(WINDOWS)):
                first[(prefix >= bounds[w][0]) & (suffix >= bounds[w][1])] = w
            mine = first == window[rows[a]]          # a pair that shares several keys counts under the first
            found.append((ident[rows[a[mine]]], ident[rows[b[mine]]]))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    o = np.lexsort((dst, -n[dst], src))              # the form: largest n, then the first in code-point order
    src, dst = src[o], dst[o]
    who, first, count = np.unique(src, return_index=True, return_counts=True)
    best = dst[first]
    return pa.table({"word": pa.array([names[w] for w in who.tolist()], pa.string()), "n_near": pa.array(count, pa.int64()),
                     "form_n": pa.array(n[best], pa.int64()), "form": pa.array([names[w] for w in best.tolist()], pa.string())})


def near_words(words: DataFrame, block: int = BLOCK, bucket_points: int = 2_000_000) -> DataFrame:
    """(word, n_near, form_n, form): words of ``words`` (word, n) with near ones, their number and the best of them.

    Words are near if one inserted, deleted or replaced code point makes one
    the other.  Such an edit lies in one of ``WINDOWS`` parts of the shorter
    word, so both agree before and after that part: words are brought together
    by (length, part, prefix, suffix), under their own length and, as the
    longer word, under one less.  Keys are dealt over buckets of bounded size; a
    key with more than ``block`` words is cut into blocks by hash and every
    pair of blocks is a tile of its own.  A tile compares padded code-point
    matrices: common prefix plus common suffix reaching the longer length less
    one.  A pair that shares several keys counts under the first one only.
    Tiles hand over one row per word, not the pairs.
    """
    spark = words.sparkSession
    size = F.length("word")
    total = words.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    classes = F.explode(F.array(F.struct(size.alias("length"), F.lit(False).alias("longer")),
                                F.struct((size - 1).alias("length"), F.lit(True).alias("longer"))))
    keyed = words.select("word", "n", classes.alias("c")).select("word", "n", "c.*").withColumn("window", F.explode(F.sequence(F.lit(0), F.lit(WINDOWS - 1))))
    before = F.floor(F.col("length") * F.col("window") / WINDOWS).cast("int")
    after = F.col("length") - F.floor(F.col("length") * (F.col("window") + 1) / WINDOWS).cast("int")
    keyed = keyed.withColumn("key", F.xxhash64(F.substring("word", F.lit(1), before), F.substring("word", size - after + 1, after)))
    group = ["length", "window", "key"]
    crowded = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block)
    cut = F.coalesce(F.ceil(F.col("rows") / block).cast("int"), F.lit(1))
    dealt = (keyed.join(crowded, group, "left").withColumn("cut", cut)
             .withColumn("block", F.pmod(F.xxhash64("word"), F.col("cut")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1))))
    tiles = dealt.select("word", "n", *group, "longer", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    buckets = max(2 * spark.sparkContext.defaultParallelism, -(-total * 2 * WINDOWS // bucket_points))
    tiles = tiles.withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets)).cast("int"))
    found = tiles.groupBy("bucket").applyInArrow(_tiles, _PARTIAL)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form")))


def group_variants(words: DataFrame, ratio: int = 5, block: int = BLOCK, bucket_points: int = 2_000_000) -> DataFrame:
    """Spelling variants of ``words`` (word, n; each word once).

    A word's form is its near word of largest n (ties: the first in
    code-point order) if that n is at least ``ratio`` times its own, else null;
    its root is the last word on the way from form to form (the word itself
    without a form).  As n grows by ``ratio`` at every step, the way is short:
    its length is bounded from the largest n, and the roots are found by that
    bound's binary logarithm of joins of the words that have a form.

    Rows with a null word or n take no part; words of any length are compared
    whole; extra columns are ignored; an empty table gives no rows.
    Returns word, form, root string, n, n_near (0 if none), form_n (the form's n or null) long.
    """
    if ratio < 2:
        raise ValueError("ratio: at least 2, or forms could go in circles")
    prepared(words.sparkSession)
    words = saved(words.where(F.col("word").isNotNull() & F.col("n").isNotNull())
                  .select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words, block, bucket_points)
    grows = F.col("form_n") >= ratio * F.col("n")
    out = saved(words.join(near, "word", "left")
                .select("word", F.when(grows, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                        F.when(grows, F.col("form_n")).alias("form_n")), "forms")
    low, high = out.where("form IS NOT NULL").agg(F.min("n"), F.max("form_n")).first()
    steps = 0 if high is None else int(math.log(high / max(low, 1), ratio) + 1e-9)
    up = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:                             # after k joins a root is 2^k forms away, or the last
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = saved(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return (out.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
