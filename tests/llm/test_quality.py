import math
import zlib

from tests.llm.helpers import documents

from bazaar.llm.quality import (FEATURES, RuleModel, condition, keep_quality, score_quality, statistics, text_statistics,
                                tree_rules)

SF = "/root/testdata/sf0.01"


def is_held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(got[i]["predicted"], q) for i, q in marks.items() if is_held(i)]
    assert len(held) > 80 and sum(p == q for p, q in held) / len(held) > 0.95
    for i, r in got.items():
        assert r["held_out"] == is_held(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    # held-out labels are never read
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1 "
                                "THEN 1 - quality ELSE quality END AS quality")
    again = {r["doc_id"]: r["score"] for r in score_quality(docs, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in got.items())
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_rules_compile_to_columns(spark):
    texts = ["Plain words here. And more.", "### $$$ %%% 12345", "", None, "a" * 50_000, "x y " * 3000]
    model = RuleModel(0.3, [(((11, "<=", 2.0),), 1.5), (((0, ">", 0.01), (11, ">", 0.5)), -2.0)])
    docs = documents(spark, texts, {"label": 3, "score": 1})
    rows = text_statistics(docs, ["doc_id"]).withColumn("score", model.score()).collect()
    for r in rows:
        x = statistics(texts[r["doc_id"]] or "")
        assert [r["__q_" + f] for f in FEATURES] == x and all(map(math.isfinite, x))
        z = 0.3 + 1.5 * (x[11] <= 2.0) - 2.0 * (x[0] > 0.01 and x[11] > 0.5)
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-12
    assert condition(((0, "<=", 1.0),)) is not None


def test_tree_paths():
    text = """RandomForestClassificationModel
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 3 <= 0.25)
      Predict: 0.0
     Else (feature 3 > 0.25)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    assert tree_rules(text) == {((3, "<=", 0.5),), ((3, "<=", 0.25),), ((3, "<=", 0.5), (3, ">", 0.25)), ((3, ">", 0.5),)}


def test_degenerate_labels(spark):
    docs = documents(spark, ["a", None, "", (None, "x"), (5, "dup"), (5, "dup")])
    schema = "doc_id long, quality int"
    none = spark.createDataFrame([(0, None), (None, 1)], schema)
    assert {r["score"] for r in score_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(5) if not is_held(i)], schema)
    rows = score_quality(docs, ones).collect()
    assert len(rows) == 6 and len({r["score"] for r in rows}) == 1 and rows[0]["score"] > 0.5
    assert score_quality(docs.limit(0), none).count() == 0
