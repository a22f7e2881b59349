"""Near-duplicates by Order MinHash: keys of occurrence-labelled shingles, verified by banded alignment of plain ones."""
from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import dropped, prepared, saved, sized, text_of
from bazaar.llm.graph import connected_components

SHINGLE = 5
_WORD = re.compile(r"\w+")


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        got = self[word] = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))
        return got


_HASHES = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """32-bit hashes of the text's lower-cased words."""
    return np.array(list(map(_HASHES.__getitem__, _WORD.findall(text.lower()))), dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def plain_shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """64-bit values of the k-word shingles in text order; a text of 1 to k - 1 words is one shingle."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    w = words.astype(np.uint64)
    n, size = max(len(w) - k + 1, 1), min(k, len(w))
    s = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + w[i:i + n])
    return s


def labelled(s: np.ndarray) -> np.ndarray:
    """The shingles, each labelled with its occurrence number, so that none repeats."""
    n = len(s)
    if not n:
        return s
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    at = np.arange(n)
    times = np.empty(n, dtype=np.uint64)
    times[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _mix(s + times * np.uint64(0xD6E8FEB86659FD93))


def labelled_shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The k-word shingles in text order, each labelled with its occurrence number."""
    return labelled(plain_shingles(words, k))


def order_minhash(shingles: np.ndarray, samples: int, minima: int, seed: int) -> np.ndarray:
    """One key per sample: the ``minima`` shingles smallest under the sample's hash, kept in text order."""
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    salts = _mix(np.arange(1, samples + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003))
    out = np.arange(1, samples + 1, dtype=np.uint64)
    at_once = max(1, 1_000_000 // n)                     # bounds the hash table of a very long text
    for lo in range(0, samples, at_once):
        part = salts[lo:lo + at_once]
        if n > minima:
            h = _mix(shingles[None, :] ^ part[:, None])
            low = np.sort(np.argpartition(h, minima - 1, axis=1)[:, :minima], axis=1)
        else:
            low = np.broadcast_to(np.arange(n), (len(part), n))
        for x in shingles[low].T:
            out[lo:lo + at_once] = _mix(out[lo:lo + at_once] * np.uint64(0x9E3779B97F4A7C15) + x)
    return out


def _common_run(a: list, b: list, band: int) -> int:
    """Length of the longest common subsequence of places at most ``band`` apart.

    Bit-parallel: a zero bit marks a place of ``b`` where the length grows.
    Only the band's bits are held; those that it leaves are counted.
    """
    masks: dict[int, tuple[int, int]] = {}
    bits = lo = hi = length = 0
    for i, x in enumerate(a):
        end = min(len(b), i + band + 1)
        if end > hi:
            bits |= (1 << (end - lo)) - (1 << (hi - lo))
            for at in range(hi, end):
                base, mask = masks.get(b[at], (at, 0))
                masks[b[at]] = base, mask | 1 << (at - base)
            hi = end
        start = min(max(0, i - band), hi)
        if start > lo:
            gone = start - lo
            length += gone - (bits & ((1 << gone) - 1)).bit_count()
            bits, lo = bits >> gone, start
        if x in masks:
            base, mask = masks[x]
            if base < lo:
                mask >>= lo - base
                masks[x] = lo, mask
                base = lo
            found = bits & (mask << (base - lo))
            if found:
                bits = ((bits + found) | (bits - found)) & ((1 << (hi - lo)) - 1)
    return length + hi - lo - bits.bit_count()


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float, labels: tuple | None = None) -> float:
    """Shingles aligned in order over all shingles of both; 0 where ``least`` cannot be reached.

    An alignment that reaches it leaves at most ``band`` shingles out, so its
    pairs lie within that many diagonals.  ``labels`` are the labelled shingles
    of both: what they share bounds the alignment.  If their places rise, they
    are the longest alignment; repeated shingles may else align with another
    occurrence, so the sequences themselves are aligned.
    """
    na, nb = len(a), len(b)
    if not na or not nb or min(na, nb) < least * max(na, nb):
        return 0.0
    la, lb = labels or (labelled(a), labelled(b))
    _, i, j = np.intersect1d(la, lb, assume_unique=True, return_indices=True)
    if len(i) < least * (na + nb - len(i)):
        return 0.0
    band = na + nb - 2 * int(np.ceil(least / (1 + least) * (na + nb) - 1e-9))
    j = j[np.argsort(i)]
    length = len(j)
    if length > 1 and not (j[1:] > j[:-1]).all():
        length = _common_run(a.tolist(), b.tolist(), band)
    similarity = length / (na + nb - length)
    return similarity if similarity >= least else 0.0


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, text): null texts empty; the key tells different texts of one id apart."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("text_key"), text_of(text_col).alias("text"))


def sketches(docs: DataFrame, id_col: str, text_col: str, samples: int, minima: int, seed: int) -> DataFrame:
    """(id, text_key, h1, h2, keys): a hash of the text, a 128-bit hash of its words (of the raw text without words), the sketch keys."""
    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def sketch(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                h1, h2, keys = [], [], []
                for t in part.column(2):
                    t = t.as_py()
                    words = word_hashes(t)
                    raw = words.tobytes() if len(words) else b"\0" + t.encode("utf-8", "surrogatepass")
                    h = np.frombuffer(xxhash.xxh3_128_digest(raw), dtype=np.int64)
                    h1.append(h[0]), h2.append(h[1])
                    keys.append(order_minhash(labelled_shingles(words), samples, minima, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    return _texts(docs, id_col, text_col).mapInArrow(sketch, "id long, text_key long, h1 long, h2 long, keys array<long>")


def word_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, words): the word hashes of each text as bytes."""
    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("words", pa.binary())])

    def hashed(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                words = [word_hashes(t.as_py()).tobytes() for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), pa.array(words, pa.binary())], schema=schema)

    return _texts(docs, id_col, text_col).mapInArrow(hashed, "id long, text_key long, words binary")


def verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose aligned similarity reaches ``least``, with it."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def align(batches):
        @functools.lru_cache(maxsize=64)
        def shingled(raw):
            plain = plain_shingles(np.frombuffer(raw, dtype=np.uint32))
            return plain, labelled(plain)

        def similar(x, y):
            (s, ls), (t, lt) = shingled(x), shingled(y)
            return aligned_similarity(s, t, least, (ls, lt))

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            got = [similar(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))]
            keep = [i for i, s in enumerate(got) if s]
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in keep], f.type) for c, f in zip((a, b, got), schema)],
                                             schema=schema)

    both = (pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")).hint("merge"), "a")
            .join(words.select(F.col("id").alias("b"), F.col("words").alias("wb")).hint("merge"), "b"))
    return both.select("a", "b", "wa", "wb").mapInArrow(align, "a long, b long, similarity double")


def rare_prefixes(texts: DataFrame, least: float, slots: int = 1 << 17) -> DataFrame:
    """(token, id, root, size, at): the rarest labelled shingles of each text (id, root, words).

    Two texts whose alignment reaches ``least`` share ``least`` of the labelled
    shingles of either, so under any one order of all shingles both have a
    shared one among their first n - ceil(least * n) + 1.  The order is by how
    often a shingle's slot (its value modulo ``slots``) occurs, then by value;
    the counts of the slots are all that comes to the driver.
    """
    def shingled(raw) -> np.ndarray:
        return labelled_shingles(np.frombuffer(raw.as_py(), dtype=np.uint32))

    def tally(batches):
        n = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                n += np.bincount((shingled(raw) % np.uint64(slots)).astype(np.int64), minlength=slots)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["slot", "n"])

    counts = (texts.select("words").mapInArrow(tally, "slot long, n long")
              .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    often = np.zeros(slots, dtype=np.int64)
    often[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    names = ["token", "id", "root", "size", "at"]

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                out = []
                for i, root, raw in zip(*[c for c in batch.slice(lo, 64).columns]):
                    x = shingled(raw)
                    n = len(x)
                    keep = n - int(np.ceil(least * n - 1e-9)) + 1
                    first = x[np.lexsort((x, often[(x % np.uint64(slots)).astype(np.int64)]))[:keep]].view(np.int64)
                    out.append((first, *[np.full(len(first), v, np.int64) for v in (i.as_py(), root.as_py(), n)],
                                np.arange(len(first))))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    return texts.select("id", "root", "words").mapInArrow(cut, ", ".join(f"{c} long" for c in names))


def prefix_pairs(rows: DataFrame, least: float, tile_rows: int = 1000, scratch: list[DataFrame] | None = None) -> DataFrame:
    """(a, b): texts of different roots with a common token that sizes and places of it let reach ``least``.

    The members of a token's commonest root meet only those of other roots;
    the members of a frequent token are dealt over tiles.
    """
    tally = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"))
    tally = tally.where("roots > 1").select(
        "token", F.col("top.root").alias("main"), F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles"))
    rows = saved(rows.join(tally.hint("merge"), "token"), "tokens")
    if scratch is not None:
        scratch.append(rows)
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    x = rows.where("root <> main").select("token", own.alias("i"), every.alias("j"), F.struct("id", "root", "size", "at").alias("x"))
    y = rows.select("token", every.alias("i"), own.alias("j"), F.struct("id", "root", "main", "size", "at").alias("y"))
    n, m = F.col("x.size"), F.col("y.size")
    needed = F.ceil(F.lit(least / (1 + least)) * (n + m) - 1e-9)
    ok = ((F.col("x.root") != F.col("y.root")) & ((F.col("y.root") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
          & (F.least(n - F.col("x.at"), m - F.col("y.at")) >= needed) & (F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-9))
    return (x.join(y.hint("merge"), ["token", "i", "j"]).where(ok)
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))


def open_pairs(members: DataFrame, words: DataFrame, least: float, whole: int, scratch: list[DataFrame]) -> DataFrame:
    """(a, b): every pair of a bucket with different roots that can reach ``least``, from rows (key, id, root).

    Buckets of up to ``whole`` texts give all their pairs; the texts of larger
    ones meet by their rarest shingles.  The tables written on the way are
    added to ``scratch``.
    """
    tally = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
    rows = saved(members.select("key", "id", "root").join(tally.where("lo <> hi").select("key", "n").hint("merge"), "key"), "open")
    scratch.append(rows)
    small = rows.where(F.col("n") <= whole)
    pairs = (small.select("key", F.col("id").alias("a"), F.col("root").alias("ra"))
             .join(small.select("key", F.col("id").alias("b"), F.col("root").alias("rb")).hint("merge"), "key")
             .where("a < b and ra <> rb").select("a", "b"))
    large = rows.where(F.col("n") > whole).select("id", "root").distinct()
    if large.take(1):
        texts = saved(large.join(words.hint("merge"), "id"), "open-texts")
        scratch.append(texts)
        pairs = pairs.union(prefix_pairs(rare_prefixes(texts, least), least, scratch=scratch))
    return pairs.distinct()


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8,
                 samples: int = 16, minima: int = 3, seed: int = 3, centres: int = 2, whole: int = 16) -> DataFrame:
    """(id, text_key, class_id, first): the class of every row of ``docs`` with an id, and whether it is the class's first.

    See :func:`near_duplicates`.  Nodes of the graph are distinct word
    sequences, numbered by their smallest id; where one id is the smallest of
    several, each of those gets a 64-bit hash as its number, so different
    texts of one id stay apart.  ``class_id`` is the smallest id of the class,
    ``first`` marks its rows with the smallest (id, text).  Every scratch
    table is deleted once the last one that reads it is written; no side of a
    join is broadcast by hint or by its present size, as all grow with the data.
    """
    prepared(docs.sparkSession)
    docs = docs.where(F.col(id_col).isNotNull())
    sketch = saved(sketches(docs, id_col, text_col, samples, minima, seed), "sketches")
    first = saved(sketch.groupBy("h1", "h2").agg(F.min(F.struct("id", "text_key")).alias("first"), F.any_value("keys").alias("keys")), "first")
    clash = first.groupBy(F.col("first.id").alias("id")).agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    node = F.when(F.col("texts").isNull(), F.col("first.id")).otherwise(F.xxhash64("h1", "h2", "first.id"))
    same = saved(first.withColumn("id", F.col("first.id")).join(clash.hint("merge"), "id", "left")
                 .select("h1", "h2", node.alias("node"), "first", "keys"), "classes")
    dropped(first)
    buckets = same.select(F.explode("keys").alias("key"), F.col("node").alias("id"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("mass")).where("mass > 1")
    narrow = saved(buckets.join(shared.hint("merge"), "key"), "buckets")
    # the texts of a group lie closest to the one whose keys most others share
    central = narrow.groupBy("id").agg(F.sum("mass").alias("mass"))
    buckets = saved(narrow.drop("mass").join(central.hint("merge"), "id"), "buckets")
    dropped(narrow)
    needed = (buckets.select(F.col("id").alias("node")).distinct().join(same.select("node", "first").hint("merge"), "node")
              .select("node", "first.id", "first.text_key"))
    words = saved(word_table(docs, id_col, text_col).join(needed.hint("merge"), ["id", "text_key"])
                  .select(F.col("node").alias("id"), "words").dropDuplicates(["id"]), "words")

    n = buckets.count()
    links, component, turn = [], None, 0

    def rooted() -> DataFrame:
        members = buckets if component is None else buckets.join(component.withColumnRenamed("node", "id").hint("merge"), "id", "left")
        root = F.col("id") if component is None else F.coalesce("component", "id")
        return members.select("key", "id", "mass", root.alias("root"))

    def joined() -> DataFrame:
        """Components of all links so far; the ones before go."""
        out = connected_components(functools.reduce(DataFrame.union, links))
        dropped(component)
        return out

    while True:
        members = rooted() if component is None else sized(rooted(), n)
        # the first centre of a bucket is its most central text; the others are drawn by hash, and after the first
        # round differently in every bucket
        lot = ["id"] if not turn else ["key", "id"]
        orders = [-F.col("mass") if not t and not turn else F.xxhash64(F.lit(seed + 1000 * turn + t), *lot) for t in range(centres)]
        draws = [F.min(F.struct(o.alias("h"), F.col("id").alias("id"), F.col("root").alias("root"))).alias(f"c{t}")
                 for t, o in enumerate(orders)]
        drawn = (members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), *draws).where("lo <> hi")
                 .select("key", F.explode(F.array_distinct(F.array(*[
                     F.struct(F.col(f"c{t}.id").alias("id"), F.col(f"c{t}.root").alias("root")) for t in range(len(draws))]))).alias("c")))
        drawn = saved(sized(drawn, n), "centres")
        pairs = (members.join(drawn.hint("merge"), "key").where(F.col("root") != F.col("c.root"))
                 .select(F.least("id", F.col("c.id")).alias("a"), F.greatest("id", F.col("c.id")).alias("b")))
        pairs = sized(pairs, n).distinct()
        new = saved(verified(pairs, words, similarity).select("a", "b"), "links")
        dropped(drawn)
        links.append(new)
        found = new.count()
        if found:
            component = joined()
        if found * 500 * samples <= n:            # the rest is left to the exact comparison
            break
        turn += 1
    scratch: list[DataFrame] = []
    new = saved(verified(open_pairs(rooted(), words, similarity, whole, scratch), words, similarity).select("a", "b"), "links")
    dropped(*scratch, words, buckets)
    links.append(new)
    if new.take(1):
        component = joined()
    dropped(*links)
    groups = same.select("h1", "h2", "node", "first")
    if component is None:
        groups = groups.withColumn("component", F.col("node"))
    else:
        groups = groups.join(component.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    lead = groups.groupBy("component").agg(F.min("first").alias("lead"))
    groups = saved(groups.join(lead.hint("merge"), "component").select("h1", "h2", "lead"), "groups")
    dropped(same, component)
    return (sketch.select("id", "text_key", "h1", "h2").join(groups.hint("merge"), ["h1", "h2"])
            .select("id", "text_key", F.col("lead.id").alias("class_id"), (F.struct("id", "text_key") == F.col("lead")).alias("first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Classes of near-duplicate documents: id, class_id (smallest id of the class) and kept.

    Two texts are linked if the longest common alignment of their five-word
    shingles holds at least ``similarity`` of all their shingles; classes are the connected components.  Texts of equal
    words are one class from the start and go on as one row (its smallest id).

    Candidates share an Order-MinHash key: at similarity 0.8 a key of
    ``minima`` = 3 agrees with probability 0.8^3, so ``samples`` = 16 keys miss
    a pair once in 100,000.  Rounds first contract large groups: every bucket
    has ``centres`` of its texts as centres, in the first round the one whose
    keys most other texts share, else drawn by seeded hashes, and its members
    of other components are aligned with them, until a round links few texts.
    Then every pair of a bucket that is still in different components is
    aligned or excluded by an exact bound: buckets of up to ``whole`` texts
    are compared whole, the texts of larger ones meet by their rarest shingles
    (a prefix filter, exact at ``similarity``).  Members of one component are
    never paired, so a group of near copies of any size stays linear.

    Null texts are empty; texts without words are compared as they are (equal:
    one class); null ids take no part; repeated rows share one class and are
    kept or not together; different texts of one id are apart (classes with the
    same smallest id share its number, each keeps its own text); an empty table
    gives no rows; other columns are ignored.  Very long texts are sketched in
    slices and aligned within the band; one pair is held in memory at a time.
    """
    out = text_classes(docs, id_col, text_col, **options)
    return out.select(F.col("id").alias(id_col), "class_id", F.col("first").alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all their columns) that stay: of each class the one with the smallest id and text.

    Rows that repeat an id and its text are kept once; rows with a null id are
    not compared and stay.  Columns may have any names: a row travels as one
    struct.
    """
    chosen = text_classes(docs, id_col, text_col, **options).where("first").select("id", "text_key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(text_of(text_col)).alias("text_key"))
    once = rows.where("id IS NOT NULL").join(chosen.hint("merge"), ["id", "text_key"], "left_semi").dropDuplicates(["id", "text_key"])
    return once.select("row.*").union(rows.where("id IS NULL").select("row.*"))
