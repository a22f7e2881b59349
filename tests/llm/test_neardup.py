import random
from collections import defaultdict

import numpy as np
import pytest
from tests.llm.helpers import documents

from bazaar.llm.graph import connected_components
from bazaar.llm.neardup import (aligned_similarity, keep_one, labelled_shingles, near_duplicates, order_minhash,
                                plain_shingles, word_hashes)


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 400)) for _ in range(n))


def plain_similarity(a, b):
    """Longest common subsequence of labelled shingles over all of them, by the full table."""
    def shingles(t):
        w = t.lower().split()
        s = [tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
        seen = defaultdict(int)
        out = []
        for x in s:
            out.append((x, seen[x]))
            seen[x] += 1
        return out
    x, y = shingles(a), shingles(b)
    if not x or not y:
        return float(a == b)
    row = [0] * (len(y) + 1)
    for u in x:
        new = [0]
        for j, v in enumerate(y):
            new.append(row[j] + 1 if u == v else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1])


def classes(texts):
    par = list(range(len(texts)))
    def find(i):
        while par[i] != i:
            i = par[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and plain_similarity(texts[i] or "", texts[j] or "") >= 0.8:
                a, b = sorted((find(i), find(j)))
                par[b] = a
    return {i: find(i) for i in range(len(texts))}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k:k + 1] = rng.choice([[], ["new" + str(rng.randint(0, 99))], [w[k], "more"]])
    return " ".join(w)


def test_against_full_alignment(spark):
    rng = random.Random(2)
    base = [sentence(rng, rng.choice([8, 30, 80, 150])) for _ in range(14)]
    texts = list(base)
    for t in base[:9]:
        for edits in (0, 1, 2, 3, 6):
            texts.append(edited(rng, t, min(edits, len(t.split()) // 8)))
    shared = sentence(rng, 40)
    texts += [f"{sentence(rng, 60)} {shared} {sentence(rng, 20)}" for _ in range(8)]       # a common passage, no copies
    texts += ["repeat this line now please " * 30, "repeat this line now please " * 29 + "end", "one two", "one two", "", "", None]
    got = {r["doc_id"]: r for r in near_duplicates(documents(spark, texts, {"class_id": 1, "id": 2})).collect()}
    want = classes(texts)
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    assert len(set(want.values())) < len(texts) - 20


def test_alignment_matches_full_table():
    rng = random.Random(3)
    for _ in range(60):
        a = sentence(rng, rng.randint(6, 40))
        b = edited(rng, a, rng.randint(0, 4))
        want = plain_similarity(a, b)
        got = aligned_similarity(*[labelled_shingles(word_hashes(t)) for t in (a, b)], 0.8)
        assert abs(got - (want if want >= 0.8 else 0.0)) < 1e-12


def test_sketch_is_sensitive_to_order():
    rng = random.Random(5)
    w = [f"w{i}" for i in range(200)]
    x = labelled_shingles(word_hashes(" ".join(w)))
    blocks = [w[i:i + 20] for i in range(0, 200, 20)]
    rng.shuffle(blocks)
    y = labelled_shingles(word_hashes(" ".join(sum(blocks, []))))
    def agree(a, b):
        return np.mean(order_minhash(a, 400, 3, 1) == order_minhash(b, 400, 3, 1))
    common = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert agree(x, x) == 1 and agree(x, y) < 0.5 * common ** 3
    near = labelled_shingles(word_hashes(" ".join(w[:100] + ["new"] + w[100:])))
    share = len(np.intersect1d(x, near)) / len(np.union1d(x, near))
    assert abs(agree(x, near) - share ** 3) < 0.1


def test_large_group_and_keep_one(spark):
    rng = random.Random(7)
    core = sentence(rng, 120)
    texts = [core] * 150 + [edited(rng, core, 1) for _ in range(150)] + [sentence(rng, 100) for _ in range(20)]
    docs = documents(spark, texts + [texts[0]], {"kept": "old"})
    docs = docs.union(docs.where("doc_id = 310")).union(documents(spark, [(None, "x"), (None, "x")], {"kept": "old"}))
    rows = near_duplicates(docs).collect()
    assert {r["class_id"] for r in rows if r["doc_id"] < 300 or r["doc_id"] == 320} == {0}
    assert sum(r["kept"] for r in rows if r["doc_id"] >= 300) == 21           # the repeated row counts twice here
    once = keep_one(docs)
    assert once.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in once.collect()) == [-1, -1, 0, *range(300, 320)]


def test_wordless_and_empty(spark):
    docs = documents(spark, ["!!!", "???", "!!!", "日本語", "a" * 200_000])
    assert {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 200), (202, 202)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    par = {n: n for e in edges if e[0] != e[1] for n in e}
    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in edges:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            par[hi] = lo
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: find(n) for n in par} and len(got) == len(par)


def repeated(words, lines, changed):
    w = [f"w{i}" for i in range(words)] * lines
    return " ".join(w), " ".join("x" if i in changed else x for i, x in enumerate(w))


def unlabelled_similarity(a, b):
    """Longest common subsequence of plain shingles over all of them, by the full table."""
    x, y = ([tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))] for w in (a.split(), b.split()))
    row = [0] * (len(y) + 1)
    for u in x:
        new = [0]
        for j, v in enumerate(y):
            new.append(row[j] + 1 if u == v else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1])


@pytest.mark.parametrize("words,changed", [(20, {9}), (30, {3}), (40, {30}), (60, {10, 40})])
def test_repetitive_texts_are_aligned_without_labels(words, changed):
    a, b = repeated(words, 40, changed)
    want = unlabelled_similarity(a, b)
    assert want >= 0.97
    assert abs(aligned_similarity(*[plain_shingles(word_hashes(t)) for t in (a, b)], 0.8) - want) < 1e-12


def test_repetitive_alignment_matches_full_table():
    rng, above = random.Random(11), 0
    for _ in range(300):
        line = rng.choices("a b c d e f g h".split(), k=rng.randint(1, 12))
        a = line * rng.randint(2, 12) + rng.choices("a b c".split(), k=rng.randint(0, 9))
        b = edited(rng, " ".join(a), rng.randint(0, 3)).split() if rng.random() < 0.7 else a[rng.randint(0, 5):] + a[:rng.randint(0, 5)]
        a, b = " ".join(a), " ".join(b)
        if not b:
            continue
        want = unlabelled_similarity(a, b)
        above += 0.8 <= want < 1
        assert abs(aligned_similarity(*[plain_shingles(word_hashes(t)) for t in (a, b)], 0.8) - (want if want >= 0.8 else 0.0)) < 1e-12
    assert above > 30


def test_repetitive_near_copies_share_a_class(spark):
    a, b = repeated(20, 40, {9})
    assert {r["class_id"] for r in near_duplicates(documents(spark, [a, b])).collect()} == {0}


@pytest.mark.parametrize("others", [6, 60])
def test_pair_that_shares_only_crowded_buckets(spark, others):
    """One pair of 0.84 among texts of below 0.8; every key that it shares, most of the others have too."""
    rng = random.Random(others)
    def text(private, shared=()):
        return " ".join([f"c{i}" for i in range(100)] + [f"p{rng.randint(0, 10 ** 9)}" for _ in range(private)] + list(shared))
    def keys(t):
        return set(order_minhash(labelled_shingles(word_hashes(t)), 16, 3, 3).tolist())
    crowd = [text(14) for _ in range(others)]
    crowded = [keys(t) for t in crowd]
    while True:
        end = [f"s{rng.randint(0, 10 ** 9)}" for _ in range(14)]
        pair = text(6, end), text(6, end)
        common = keys(pair[0]) & keys(pair[1])
        if common and all(sum(k in c for c in crowded) > 2 for k in common):
            break
    texts = crowd + list(pair)
    assert plain_similarity(*pair) >= 0.8 and max(plain_similarity(x, y) for x in texts for y in crowd if x is not y) < 0.8
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: min(i, others) for i in range(len(texts))}


def test_prefix_pairs_lose_no_similar_pair(spark):
    from bazaar.llm.neardup import prefix_pairs, rare_prefixes, word_table
    rng = random.Random(17)
    texts = [sentence(rng, rng.choice([3, 8, 40, 90])) for _ in range(12)]
    texts += [edited(rng, t, rng.randint(0, 4)) for t in texts for _ in range(4)] + ["a b c d e " * k for k in range(4, 16)]
    texts = [t for t in texts if t]
    docs = documents(spark, texts)
    words = word_table(docs, "doc_id", "text").selectExpr("id", "id % 3 as root", "words")
    got = {(r["a"], r["b"]) for r in prefix_pairs(rare_prefixes(words, 0.8), 0.8, tile_rows=3).collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if i % 3 != j % 3 and plain_similarity(texts[i], texts[j]) >= 0.8}
    assert len(want) > 20 and want <= got and all(a % 3 != b % 3 for a, b in got)


def test_one_id_with_two_texts(spark):
    from bazaar.llm.neardup import keep_one
    rng = random.Random(21)
    a, b = sentence(rng, 60), sentence(rng, 60)
    docs = documents(spark, [(1, a), (1, b), (2, a), (3, b), (0, edited(rng, b, 1)), (7, a.upper()), (7, a)])
    got = sorted((r["doc_id"], r["class_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (2, 1, False), (3, 0, False), (7, 1, False), (7, 1, False)]
    assert sorted((r["doc_id"], r["text"]) for r in keep_one(docs).collect()) == sorted(
        [(1, a)] + [(r["doc_id"], r["text"]) for r in docs.where("doc_id = 0").collect()])
    # the smallest id of two classes keeps both its texts
    docs = documents(spark, [(1, a), (1, b), (2, a), (3, b), (1, a)])
    assert sorted((r["doc_id"], r["text"]) for r in keep_one(docs).collect()) == sorted([(1, a), (1, b)])


def test_columns_of_any_name(spark):
    from bazaar.llm.neardup import keep_one
    extra = {c: "x" for c in ("id", "row", "text_key", "key", "__same", "class_id", "first", "h1", "node")}
    docs = documents(spark, ["one two three four five six seven eight", "one two three four five six seven eight", "other"], extra)
    out = keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2]
