"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, saved, text_of
from bazaar.llm.quality import held_out

SIZES = (1, 2, 3, 4)             # code points of a subword
PIECE = 1 << 18                  # code points hashed at once
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def hashed_subwords(points: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of the subword of each size that starts at each code point; 2^bits where none does.

    Everything but letters is a gap (0).  A subword lies in one word; with a
    gap as its first or last point it marks a start or an end of a word.
    """
    letter = _letters()[points]
    p = np.where(letter, points, 0).astype(np.uint32)
    n = len(p)
    out = np.full((len(SIZES), n), 1 << bits, dtype=np.int32)
    for row, size in enumerate(SIZES):
        m = n - size + 1
        if m <= 0:
            continue
        h = np.full(m, size * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        whole = np.ones(m, dtype=bool)
        for k in range(size):
            h = (h ^ p[k:k + m]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            if 0 < k < size - 1 or size == 1:
                whole &= letter[k:k + m]
        if size == 2:
            whole &= letter[:m] | letter[1:]
        h = (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)
        out[row, :m] = np.where(whole, h, 1 << bits)
    return out


def _points(text: str) -> np.ndarray:
    """Code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _pieces(points: np.ndarray):
    """(points, starts): a gap, the text and gaps in pieces of bounded length, each start in one piece."""
    reach = max(SIZES) - 1
    padded = np.concatenate([np.zeros(1, np.uint32), points, np.zeros(reach + 1, np.uint32)])
    last = len(points) + 1
    for lo in range(0, last, PIECE):
        hi = min(lo + PIECE, last)
        yield padded[lo:hi + reach], hi - lo


def subword_counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the subwords of one whole text."""
    total = np.zeros((1 << bits) + 1, dtype=np.int64)
    for part, starts in _pieces(_points(text)):
        total += np.bincount(hashed_subwords(part, bits)[:, :starts].ravel(), minlength=len(total))
    seen = np.flatnonzero(total[:-1])
    return seen, total[seen]


def mean_scores(texts: list[str], table: np.ndarray) -> np.ndarray:
    """For each whole text the mean row of ``table`` over its subwords; the last row of ``table`` is 0.

    Texts are hashed together up to ``PIECE`` code points; a longer one goes
    in pieces, so memory does not grow with a text.
    """
    bits = (len(table) - 1).bit_length() - 1
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
    held, size = [], 0

    def flush():
        nonlocal held, size
        if not held:
            return
        marks, at = [], 0
        for _, part, starts in held:
            marks += [at, at + starts]
            at += len(part)
        b = hashed_subwords(np.concatenate([p for _, p, _ in held]), bits)
        who = np.array([i for i, _, _ in held])
        for row in b:
            # every second stretch is the look-ahead of a piece; its starts belong to the next piece
            s = np.add.reduceat(np.take(table, row, axis=0), marks, axis=0, dtype=np.float64)[::2]
            c = np.add.reduceat(row < len(table) - 1, marks, dtype=np.int64)[::2]
            np.add.at(sums, who, s)
            np.add.at(counts, who, c)
        held, size = [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        for part, starts in _pieces(_points(text)):
            held.append((i, part, starts))
            size += len(part)
            if size >= PIECE:
                flush()
    flush()
    return sums / np.maximum(counts, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class LanguageModel:
    """Embeddings folded into the softmax: one row of class scores per bucket, with bias, temperature and floor."""

    def __init__(self, classes: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, floor: float = 0.0):
        self.classes, self.table, self.bias, self.temperature, self.floor = classes, table, bias, temperature, floor

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return softmax((mean_scores(texts, self.table) + self.bias) / self.temperature)


def _descend(E: np.ndarray, W: np.ndarray, b: np.ndarray, docs: list, rate: float) -> None:
    """One pass of stochastic gradient descent over (buckets, shares, class), in place."""
    for k, (seen, share, y) in enumerate(docs):
        step = rate * (1 - k / len(docs) / 2)
        rows = E[seen]
        x = share @ rows
        g = softmax((x @ W + b)[None, :])[0]
        g[y] -= 1
        # the mean of many subwords moves little: its own step size is the inverse of the sum of squared shares
        E[seen] = rows - (step / max(float(share @ share), 1e-3) ** 0.5) * share[:, None] * (W @ g)[None, :]
        W -= step * np.outer(x, g)
        b -= step * g


def learn(samples: DataFrame, classes: list[str], bits: int, dim: int, epochs: int, parts: int, rate: float, seed: int):
    """Parameters learned by stochastic gradient descent on the rows (part, at, y, seen, share) of ``samples``.

    Each of ``parts`` tasks holds a bounded share of the sample and passes
    over it once per epoch, in the order of ``at``; the parameters (their size
    is fixed by ``bits``, ``dim`` and the classes) are averaged after every
    epoch in a fixed order, so a recomputed task changes nothing.
    """
    rng = np.random.default_rng(seed)
    E = rng.normal(scale=0.1, size=(1 << bits, dim))
    W = rng.normal(scale=0.1, size=(dim, len(classes)))
    b = np.zeros(len(classes))
    spark = samples.sparkSession
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        shared = spark.sparkContext.broadcast((E.astype(np.float32), W, b))

        def run(table: pa.Table) -> pa.Table:
            e0, w, c = shared.value
            e, w, c = e0.astype(np.float64), w.copy(), c.copy()
            at = np.argsort(table["at"].to_numpy(), kind="stable")
            at = at[np.random.default_rng(seed + epoch).permutation(len(at))]
            seen, share, y = table["seen"], table["share"], table["y"].to_numpy()
            docs = [(seen[int(i)].values.to_numpy(), share[int(i)].values.to_numpy().astype(np.float64), int(y[i])) for i in at]
            _descend(e, w, c, docs, step)
            return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "n": pa.array([len(at)], pa.int64()),
                             "e": pa.array([e.astype(np.float32).tobytes()], pa.binary()),
                             "w": pa.array([np.concatenate([w.ravel(), c]).tobytes()], pa.binary())})

        found = sorted(samples.groupBy("part").applyInArrow(run, "part int, n long, e binary, w binary").collect(), key=lambda r: r.part)
        shared.destroy()
        total = sum(r.n for r in found)
        E = sum(np.frombuffer(r.e, np.float32).reshape(E.shape).astype(np.float64) * (r.n / total) for r in found)
        flat = sum(np.frombuffer(r.w, np.float64) * (r.n / total) for r in found)
        W, b = flat[:W.size].reshape(W.shape).copy(), flat[W.size:].copy()
    return E, W, b


def calibrate(logits: np.ndarray, y: np.ndarray, precision: float) -> tuple[float, float]:
    """(temperature, floor): the temperature of least log loss, and the lowest score from which
    the answers kept are right in a share of ``precision``."""
    if not len(y):
        return 1.0, 0.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-300)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    score, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    last = np.flatnonzero((share >= precision) & (np.append(np.diff(score[order]) != 0, True)))
    return temperature, float(score[order][last[-1]]) if len(last) else 1.0


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_per_class: int = 1500, bits: int = 16, dim: int = 16, epochs: int = 6, parts: int = 4,
                 rate: float = 1.0, precision: float = 0.99, seed: int = 17) -> LanguageModel:
    """Learn from texts whose language is given and whose id is not held out.

    Of a language with more than ``max_per_class`` such texts about that many
    are taken, those with the smallest seeded hashes of id and text (a bounded
    sample; whole texts).  A fifth of them is kept from the descent and sets
    the temperature and the rejection floor.  Texts without a letter teach
    nothing.  Without any text to learn from there is no class, with one class
    every score is 1.
    """
    spark = prepared(docs.sparkSession)
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1_000_003))
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0) & ~held_out(id_col))
    counts = {r[0]: r[1] for r in known.groupBy(F.col(lang_col).cast("string")).count().collect()}
    classes = sorted(counts)
    if not classes:
        return LanguageModel([], np.zeros(((1 << bits) + 1, 0)), np.zeros(0))
    limit = F.lit(0)
    for c in classes:
        limit = F.when(F.col(lang_col).cast("string") == c, int(1_000_003 * min(1.0, max_per_class / counts[c])) + 1).otherwise(limit)
    number = {c: i for i, c in enumerate(classes)}

    def measure(batches):
        for batch in batches:
            spots, texts, langs = (batch.column(i).to_pylist() for i in range(3))
            rows = [(s, number[c], *subword_counts(t, bits)) for s, t, c in zip(spots, texts, langs) if has_letter(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([(r[3] / r[3].sum()).astype(np.float32) for r in rows], pa.list_(pa.float32()))], names=["at", "y", "seen", "share"])

    picked = known.where(spot < limit).select(F.xxhash64(F.lit(seed + 1), F.col(id_col), F.col(text_col)).alias("at"),
                                              F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    sample = saved(picked.mapInArrow(measure, "at long, y int, seen array<int>, share array<float>"), "language-sample")
    part = F.pmod("at", F.lit(5 * parts)).cast("int")
    train = sample.withColumn("part", part).where(F.col("part") < 4 * parts).withColumn("part", (F.col("part") % parts).cast("int"))
    if train.isEmpty():
        return LanguageModel(classes, np.zeros(((1 << bits) + 1, len(classes))), np.zeros(len(classes)))
    E, W, b = learn(train, classes, bits, dim, epochs, parts, rate, seed)
    table = np.concatenate([E @ W, np.zeros((1, len(classes)))]).astype(np.float32)
    shared = spark.sparkContext.broadcast(table)

    def judge(batches):
        for batch in batches:
            y, seen, share = (batch.column(i) for i in range(3))
            z = [share[i].values.to_numpy() @ shared.value[seen[i].values.to_numpy()] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([y, pa.array([v.tolist() for v in z], pa.list_(pa.float64()))], names=["y", "z"])

    aside = sample.where(part >= 4 * parts).select("y", "seen", "share").mapInArrow(judge, "y int, z array<double>").collect()
    z = np.array(sorted((*r.z, r.y) for r in aside)).reshape(len(aside), len(classes) + 1)
    temperature, floor = calibrate(z[:, :-1] + b, z[:, -1].astype(int), precision)
    return LanguageModel(classes, table, b, temperature, floor)


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      model: LanguageModel | None = None, **fit) -> DataFrame:
    """Language of every whole text by the mean of its hashed subword embeddings and a linear softmax.

    Subwords are runs of one to four letters (with word starts and ends) of
    the lower-cased text, hashed into 2^bits buckets.  The model is learned by
    :func:`fit_language` from rows that are not held out, unless one is given.
    As the classes are linear in the mean, embeddings and weights fold into one
    row of class scores per bucket, which every task looks up.

    ``lang_pred`` is the likeliest learned language (ties: the first by name),
    ``score`` its calibrated probability and ``accepted`` whether that reaches
    the calibrated floor (a rejected guess is right less often than the
    precision asked for).  A null text, one without a letter (also an empty
    one) and every text when nothing could be learned is ``und`` with score 0,
    not accepted.  Texts of any length are read whole, in pieces of bounded
    size.  Only the text enters a prediction; repeated rows are predicted each;
    null ids stay (never held out); other columns are ignored; an empty table
    gives no rows.
    Returns the id, held_out boolean, lang_pred string, score double, accepted boolean.
    """
    spark = prepared(docs.sparkSession)
    model = model or fit_language(docs, id_col, text_col, lang_col, **fit)
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def predict(batches):
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(2).to_pylist()
                able = [bool(m.classes) and has_letter(t) for t in texts]
                best, score = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
                if any(able):
                    p = m.probabilities([t for t, ok in zip(texts, able) if ok])
                    best[able], score[able] = p.argmax(1), p.max(1)
                names = [m.classes[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), able)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score),
                     pa.array(np.array(able, dtype=bool) & (score >= m.floor))],
                    names=[id_col, "held_out", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), text_of(text_col).alias("__text"))
    return rows.mapInArrow(predict, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double, accepted boolean")
