import random
import zlib
from collections import defaultdict

import numpy as np
from tests.llm.helpers import documents
from tokenizers import Tokenizer

from bazaar.llm.packing import CapacityTree, best_fit_decreasing, default_tokenizer, pack_documents, sequences


def simple_bfd(items, window):
    room = []
    for x in sorted(items, reverse=True):
        fit = [r for r in room if r >= x]
        if fit:
            room.remove(min(fit))
        room.append((min(fit) if fit else window) - x)
    return sorted(room)


def test_plan_equals_piece_by_piece_packing():
    rng = random.Random(0)
    for _ in range(200):
        window = rng.choice([16, 50, 64])
        items = [rng.randint(1, window) for _ in range(rng.randint(0, 250))]
        hist = {x: items.count(x) for x in set(items)}
        used = defaultdict(list)
        for length, a, b, first, per, offset in best_fit_decreasing(hist, window).tolist():
            for j in range(b - a):
                used[first + j // per].append((offset + j % per * length, length))
        assert sorted(window - sum(n for _, n in v) for v in used.values()) == simple_bfd(items, window)
        for v in used.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length


def test_tree():
    rng = random.Random(1)
    tree, marked = CapacityTree(100), set()
    for _ in range(2000):
        x = rng.randint(0, 100)
        tree.set(x, x not in marked)
        marked ^= {x}
        least = rng.randint(0, 100)
        assert tree.tightest(least) == min((m for m in marked if m >= least), default=None)


ODD = ["a\x1cb c", "<|endoftext|>x <|startoftext|> y", "É́ é naïve İstanbul ΣΑΣ ß ŒUVRE", "it's I'LL don't 'sup 12³½ ª²",
       " x y​z", "日本語 テスト", "", "  ", "é é ́x", "a\xadb \x85 c", None, "dup", "dup", "word " * 30_000]


def check(rows, texts, window):
    tok = Tokenizer.from_file(default_tokenizer())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = np.array(tok.encode(texts[i] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and 0 < r["length"] <= window and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for v in by_seq.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= window
    return by_seq


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(documents(spark, [(10 ** 6 + i, t) for i, t in enumerate(ODD)]).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pack_documents(docs).collect()
    by_seq = check(rows, texts, 4096)
    assert sum(n for v in by_seq.values() for _, n in v) / (4096 * len(by_seq)) > 0.95
    small = check(pack_documents(docs, window=100).collect(), texts, 100)
    assert sorted(100 - sum(n for _, n in v) for v in small.values()) == simple_bfd([n for v in small.values() for _, n in v], 100)


def test_sequences_hold_the_ids(spark):
    texts = ["one two three", "four", "five six seven eight nine ten " * 9, ""]
    docs = documents(spark, texts, {"offset": 1, "rank": 2})
    packed = pack_documents(docs, window=32, with_ids=True)
    tok = Tokenizer.from_file(default_tokenizer())
    want = {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    back = defaultdict(dict)
    for s in sequences(packed).collect():
        assert s["n_tokens"] == len(s["input_ids"]) <= 32
        at = 0
        for d, start, n in zip(s["doc_ids"], s["starts"], s["lengths"]):
            back[d][start] = s["input_ids"][at:at + n]
            at += n
    assert {d: sum((v[k] for k in sorted(v)), []) for d, v in back.items()} == want
    assert pack_documents(docs.limit(0)).count() == 0
