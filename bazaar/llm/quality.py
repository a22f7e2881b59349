"""Quality classifier: tree paths as rules over text statistics, lasso logistic weights, compiled to columns."""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bazaar.llm.common import prepared, saved, text_of

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (32, 9), "line": (10, 13),
    "stop": (46, 33, 63), "comma": (44, 59, 58), "symbol": (35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 124, 126),
    "bracket": (40, 41, 91, 93, 123, 125), "quote": (34, 39), "high": range(128, 256),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _codes in enumerate(_CLASSES.values()):
    _TABLE[list(_codes), _i] = 1

FEATURES = tuple(f"{c}_share" for c in _CLASSES) + (
    "log_chars", "log_words", "mean_word", "long_word_share", "short_word_share", "distinct_word_share",
    "top_word_share", "wordless_share", "repeated_pair_share", "log_lines", "distinct_line_share", "mean_line",
    "ended_line_share", "words_per_stop", "byte_entropy")


def statistics(text: str) -> list[float]:
    """FEATURES of one text; an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    size = raw.sum()
    p = raw[raw > 0] / size
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, seen = max(len(words), 1), Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    pairs = len(set(zip(words, words[1:])))
    return [*(raw @ _TABLE / size), math.log1p(len(text)), math.log1p(len(words)), float(lengths.mean()),
            float((lengths > 15).mean()), float((lengths <= 3).mean()), len(seen) / n,
            (max(seen.values()) if seen else 0) / n, sum(not any(map(str.isalpha, w)) for w in words) / n,
            1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0, math.log1p(len(lines)),
            len(set(lines)) / max(len(lines), 1), len(text) / max(len(lines), 1),
            sum(x.rstrip()[-1:] in ".!?" for x in lines) / max(len(lines), 1),
            n / (1 + raw[46] + raw[33] + raw[63]), float(-(p * np.log2(p)).sum())]


def text_statistics(docs: DataFrame, keep: list[str], text_col: str | None = "text", prefix: str = "__q_",
                    text_at: int | None = None) -> DataFrame:
    """The ``keep`` columns and the statistics (named ``prefix`` + feature) of every whole text.

    With ``text_at`` the text is that field of the first of ``keep``, a struct, and does not travel twice.
    """
    out = StructType([docs.schema[c] for c in keep] + [StructField(prefix + f, DoubleType()) for f in FEATURES])

    def measure(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(len(keep)) if text_at is None else pc.struct_field(part.column(0), text_at)
                m = np.array([statistics(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))
                cols = [part.column(i) for i in range(len(keep))] + [pa.array(m[:, j]) for j in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *[prefix + f for f in FEATURES]])

    text = [] if text_col is None else [text_of(text_col).alias("__text")]
    return docs.select(*[F.col(f"`{c}`") for c in keep], *text).mapInArrow(measure, out)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is never learned from: crc32 of the id as text, modulo 3, is 1 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class RuleModel:
    """Intercept and weighted conjunctive rules; a rule is ((feature index, "<=" or ">", threshold), ...)."""

    def __init__(self, intercept: float, rules: list[tuple[tuple, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self, prefix: str = "__q_") -> Column:
        """Probability of label 1 as one column expression over the statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, prefix), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: tuple, prefix: str = "__q_") -> Column:
    out = None
    for f, op, x in rule:
        c = F.col(prefix + FEATURES[f])
        term = c <= F.lit(x) if op == "<=" else c > F.lit(x)
        out = term if out is None else out & term
    return out


def tree_rules(debug: str) -> set[tuple]:
    """All root-to-node paths of the trees of a printed ensemble, each simplified to its tightest bounds."""
    rules, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)", line)
        if re.match(r" *Tree \d+", line):
            path = []
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, int(m[2]), m[3], float(m[4]))]
        tight: dict[tuple, float] = {}
        for _, f, op, x in path:
            best = min if op == "<=" else max
            tight[f, op] = best(tight.get((f, op), x), x)
        rules.add(tuple(sorted((f, op, x) for (f, op), x in tight.items())))
    return rules


def fit_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              max_rows: int = 50_000, trees: int = 16, depth: int = 4, penalty: float = 0.0005,
              seed: int = 11, prefix: str = "__q_") -> RuleModel:
    """Learn the rule ensemble from labelled rows that are not held out.

    The labels of an id are averaged (0.5 and more: 1; null ids and labels
    out).  If there are more than ``max_rows`` labelled rows, those with the
    smallest seeded hashes are kept, about ``max_rows`` of them.  A random
    forest proposes rules, a lasso logistic regression weighs them; rules of
    weight zero go.  Without labels the score is 0.5, with one class the
    smoothed share of label 1.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.storagelevel import StorageLevel

    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("__id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("label")))
    n = marks.count()
    if n > max_rows:
        marks = marks.where(F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1_000_003)) < int(1_000_003 * max_rows / n))
    columns = [prefix + f for f in FEATURES]
    rows = (stats.join(marks, F.col(id_col) == F.col("__id"))
            .select("label", F.array(*columns).alias("x"), *columns).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        count, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        if not count or ones in (0, count):
            p = (ones + 1) / (count + 2)
            return RuleModel(math.log(p / (1 - p)), [])
        forest = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64,
                                        featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=seed)
        rules = sorted(tree_rules(forest.fit(rows.select("label", array_to_vector("x").alias("v"))).toDebugString))
        hits = F.array(*[condition(r, prefix).cast("double") for r in rules])
        lasso = LogisticRegression(featuresCol="v", labelCol="label", elasticNetParam=1.0, regParam=penalty,
                                   standardization=False, maxIter=60)
        model = lasso.fit(rows.select("label", array_to_vector(hits).alias("v")))
        weights = model.coefficients.toArray()
        return RuleModel(float(model.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w])
    finally:
        rows.unpersist()


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """Quality score of every whole text: the id, held_out, score (0 to 1) and predicted (score >= 0.5).

    Texts are read once: their statistics are saved, the rules are learned
    from the labelled rows that are not held out, and every row is scored by
    the compiled expression.  Only the text enters a score.  Null texts are
    empty; repeated rows are scored each; an empty table gives no rows; other
    columns are ignored.
    """
    prepared(docs.sparkSession)
    stats = saved(text_statistics(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col)), [id_col], text_col), "stats")
    model = fit_rules(stats, labels, id_col, **fit)
    out = stats.select(id_col, held_out(id_col).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose text is predicted to be good.

    Every text is measured once: its row is saved with the statistics, from
    which the rules are learned and the decision is made.  A row travels as
    one struct, so columns may have any names.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias(id_col))
    stats = saved(text_statistics(rows, ["row", id_col], None, text_at=docs.columns.index(text_col)), "stats")
    model = fit_rules(stats, labels, id_col, **fit)
    return stats.where(model.score() >= 0.5).select("row.*")
