import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tests.llm.helpers import crc, documents

from bazaar.llm.pieces import PieceModel, decode_pieces, default_model, encode_pieces


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def model():
    return PieceModel(default_model())


ODD = ["Hello  world", " lead", "trail ", "a\nb\tc", "Ünïcode ﬁ ①", "日本語テスト", "", "   ", "x\x00y", "▁a", " ",
       "<s> </s> <0x41> <unk>", "😀 " + "ab" * 3000, " " * 50 + "x", "=" * 333, "\x00\x00", "a\x00\x00b", "the" * 200, "ﬀ" * 300]


def test_equals_sentencepiece(model, reference):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("the inandar  s▁\n.é日") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    for t, ids in zip(texts, model.encode_batch(texts)):
        want = reference.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want, t[:50]
        assert model.decode(want) == reference.decode(want) == t.replace("▁", " ")


def test_occurrences_by_suffix_array(model):
    text = "the other\0theft\0"
    got = set(zip(*[x.tolist() for x in model.occurrences(text)]))
    want = {(i, k) for k, p in enumerate(model.known) for i in range(len(text)) if text.startswith(model.pieces[p], i)}
    assert got == want


def test_small_memory_gives_the_same(model, reference):
    tiny = PieceModel(default_model(), limit=20)
    texts = [f"word{i} again and word{i % 7}" for i in range(60)]
    for lo in range(0, 60, 10):
        for t, ids in zip(texts[lo:lo + 10], tiny.encode_batch(texts[lo:lo + 10])):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode(t)


def test_round_trip_table(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(documents(spark, [(10 ** 6 + i, t) for i, t in enumerate(ODD + [None, "dup", "dup"])]).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = decode_pieces(encode_pieces(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        ids = reference.encode(t)
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["text"] == t.replace("▁", " ")


def test_query_and_empty(spark):
    from bazaar.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    want = {r["doc_id"]: crc(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: r["text_crc32"] for r in QUERIES["op7_sentencepiece"](spark, sf).collect()} == want
    docs = documents(spark, ["a"], {"ids": 1})
    assert encode_pieces(docs.limit(0)).count() == 0 and decode_pieces(encode_pieces(docs)).collect()[0]["text"] == "a"
