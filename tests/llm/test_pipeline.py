"""Every stage of the corpus pipeline against a plain version of itself, each on its own input."""
import corpus_pipeline
from tests.llm.helpers import documents
from tests.llm.test_packing import check
from tests.llm.test_secrets import plain

from bazaar.llm.common import read, saved
from bazaar.llm.neardup import aligned_similarity, labelled_shingles, word_hashes
from bazaar.llm.quality import score_quality
from bazaar.llm.secrets import base_spans, redact

SF = "/root/testdata/sf0.001"


def classes(texts):
    """Smallest index of each group linked at 0.8, by comparing all pairs."""
    x = [labelled_shingles(word_hashes(t or "")) for t in texts]
    par = list(range(len(texts)))
    def find(i):
        while par[i] != i:
            i = par[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or aligned_similarity(x[i], x[j], 0.8):
                a, b = sorted((find(i), find(j)))
                par[b] = a
    return {i: find(i) for i in range(len(texts))}


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "secret_scan", "packing"]
    docs = read(spark, SF, "documents")
    docs = docs.union(documents(spark, [(10 ** 6, f"{'some clean words in a line. ' * 20} token = {'ab12' * 10}"), (10 ** 6 + 1, None)]))
    quality, near, secret, packing = [f for _, f in corpus_pipeline.STAGES]
    good = saved(quality(spark, docs, SF), "t")
    scores = {r["doc_id"]: r["predicted"] for r in score_quality(docs, read(spark, SF, "labels")).collect()}
    rows = {r["doc_id"]: r for r in good.collect()}
    assert good.columns == docs.columns and set(rows) == {i for i, p in scores.items() if p}
    clean = {r["doc_id"] for r in read(spark, SF, "labels").where("quality = 1").collect()}
    assert len(clean & set(rows)) / len(clean & set(scores)) > 0.95

    once = saved(near(spark, good, SF), "t")
    ids = sorted(rows)
    want = classes([rows[i]["text"] for i in ids])
    kept = {r["doc_id"]: r for r in once.collect()}
    assert once.columns == docs.columns and set(kept) == {ids[c] for c in want.values()}

    masked = saved(secret(spark, once, SF), "t")
    out = {r["doc_id"]: r for r in masked.collect()}
    assert masked.columns == docs.columns and set(out) == set(kept)
    for i, r in out.items():
        text = kept[i]["text"]
        if text:
            assert r["text"] == redact(text, base_spans(text)) and not plain(r["text"])
            assert r["n_chars"] == (len(r["text"]) if r["text"] != text else kept[i]["n_chars"])
    check(packing(spark, masked, SF).collect(), {i: r["text"] for i, r in out.items()}, 4096)


def test_run_and_empty(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in read(spark, SF, "documents").collect()}
    empty = documents(spark, ["a"]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns named like the stages' own working columns pass through every filtering stage."""
    import corpus_pipeline as P
    extra = {c: "x" for c in ("row", "id", "__text", "__whole", "__changed", "__same", "__q_log_chars", "label", "v", "first", "h1")}
    docs = documents(spark, ["one two three four five six seven eight nine ten"] * 2 + ["api_key = abcdef123456 and more words here", "", None], extra)
    for name, stage in P.STAGES[:3]:
        if name == "quality_classifier":
            from bazaar.llm.quality import keep_quality
            labels = spark.createDataFrame([(0, 1), (2, 1), (3, 1)], "doc_id long, quality int")
            out = keep_quality(docs, labels)
        else:
            out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows = {r["doc_id"]: r for r in out.collect()}
        assert rows and all(r[c] == "x" for r in rows.values() for c in extra)
        if name == "secret_scan":
            assert "abcdef123456" not in rows[2]["text"] and rows[2]["n_chars"] == len(rows[2]["text"])
