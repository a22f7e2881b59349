import numpy as np

from bazaar.llm import language as L
from tests.llm.helpers import documents

WORDS = {"aa": "der die und nicht eine über schön straße", "bb": "the and with which there thing would should",
         "cc": "los una para ción pero señor muy donde"}


def corpus(n=240, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        out.append((i, " ".join(rng.choice(WORDS[lang].split(), rng.integers(3, 60))), lang))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, c, "s", 0) for i, t, c in rows], "doc_id long, text string, lang string, source string, n_chars long")


def plain_subwords(text, bits):
    """The buckets of a text, one subword at a time."""
    p = [ord(c) if c.isalpha() else 0 for c in "\0" + text.lower() + "\0\0\0\0"]
    out = []
    for size in L.SIZES:
        for at in range(len(p) - 3):
            g = p[at:at + size]
            inner = g if size == 1 else g[1:-1]
            if 0 in inner or (size == 2 and not any(g)):
                continue
            h = size * 0x9E3779B1 & 0xFFFFFFFF
            for x in g:
                h = (h ^ x) * 0x01000193 & 0xFFFFFFFF
                h ^= h >> 15
            out.append((h * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - bits))
    return out


def test_subwords_and_means_against_plain_loops(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["", "a", "ab", "a b", "Ünïcode straße 12 x", "  ", "ab" * 40 + " 日本語 " + "xyz " * 30, "𝔘𝔫𝔦 q", "end"]
    t = np.concatenate([rng.normal(size=(1 << 8, 3)), np.zeros((1, 3))]).astype(np.float32)
    for piece in (7, 50, 1 << 18):                     # pieces and joint batches give the same sums
        monkeypatch.setattr(L, "PIECE", piece)
        got = L.mean_scores(texts, t)
        for text, row in zip(texts, got):
            b = plain_subwords(text, 8)
            want = t[b].astype(float).mean(0) if b else np.zeros(3)
            assert np.allclose(row, want, atol=1e-9), (text, piece)
            seen, n = L.subword_counts(text, 8)
            assert sorted(np.repeat(seen, n)) == sorted(b)


def test_held_out_accuracy_and_rejection(spark):
    rows = corpus() + [(1000, None, "aa"), (1001, "12 + 34 = !", "bb"), (1002, "", None), (1003, "the thing", None)]
    out = {r.doc_id: r for r in L.identify_language(table(spark, rows), bits=10, dim=8, epochs=4).collect()}
    assert len(out) == len(rows)
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(out[i].score == 0 and not out[i].accepted for i in (1000, 1001, 1002))
    assert out[1003].lang_pred == "bb"
    held = [(out[i].lang_pred, c) for i, _, c in corpus() if out[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.97
    kept = [(out[i].lang_pred, c) for i, _, c in corpus() if out[i].held_out and out[i].accepted]
    assert kept and np.mean([a == b for a, b in kept]) >= 0.97


def test_predictions_depend_on_the_text_alone(spark):
    rows = corpus(90)
    model = L.fit_language(table(spark, rows), bits=9, dim=4, epochs=2)
    again = L.fit_language(table(spark, rows).repartition(7), bits=9, dim=4, epochs=2)
    assert np.array_equal(model.table, again.table) and model.floor == again.floor
    moved = [(i + 5, t, "zz") for i, t, _ in rows] + [(5, rows[0][1], "aa")]       # repeated row, other ids and languages
    df = table(spark, moved)
    for name in ("held_out", "score", "__text", "accepted"):
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(1))
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 12)) for r in L.identify_language(df, model=model).collect())
    p = model.probabilities([t for _, t, _ in moved])
    assert got == sorted((i, model.classes[k], round(s, 12)) for (i, _, _), k, s in zip(moved, p.argmax(1).tolist(), p.max(1).tolist()))


def test_held_out_labels_teach_nothing(spark):
    import zlib
    rows = [(i, t, c if zlib.crc32(str(i).encode()) % 3 != 1 else "wrong") for i, t, c in corpus(90)]
    assert L.fit_language(table(spark, rows), bits=8, dim=4, epochs=1).classes == ["aa", "bb", "cc"]


def test_edges(spark):
    assert L.identify_language(table(spark, [])).collect() == []
    out = L.identify_language(documents(spark, ["abc"]).withColumn("lang", __import__("pyspark").sql.functions.lit(None).cast("string"))).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    one = L.identify_language(documents(spark, [(0, "abc"), (None, "x"), (2, "one two " * 40_000)]), bits=8, dim=4, epochs=1).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in one} == {(0, "en", 1.0), (None, "en", 1.0), (2, "en", 1.0)}


def test_calibration():
    z = np.array([[9.0, 0], [7, 0], [5, 0], [1, 0], [0.5, 0]])
    t, floor = L.calibrate(z, np.array([0, 0, 0, 0, 1]), 0.99)
    p = L.softmax(z / t).max(1)
    assert (p >= floor).tolist() == [True, True, True, True, False]
    assert L.calibrate(np.zeros((0, 2)), np.zeros(0, int), 0.9) == (1.0, 0.0)
