import re
import zlib
from collections import Counter

import numpy as np

from bazaar.llm import spelling as S
from tests.llm.helpers import documents


def edit(a, b):
    """Whether one code point inserted, deleted or replaced makes a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def brute(words, ratio=5):
    out = []
    form = {}
    for w, n in words.items():
        near = [(-words[v], v) for v in words if edit(w, v)]
        best = min(near) if near else None
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        out.append((w, n, len(near)))
    rows = []
    for w, n, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return sorted(rows)


def run(spark, words, **kw):
    df = spark.createDataFrame(list(words.items()) if isinstance(words, dict) else words, "word string, n long")
    return sorted(tuple(r) for r in S.group_variants(df, **kw).collect())


def some_words(n, letters, lengths, seed):
    rng = np.random.default_rng(seed)
    out = {}
    while len(out) < n:
        w = "".join(rng.choice(list(letters), rng.choice(lengths)))
        out[w] = int(5 * 6 ** rng.integers(0, 6) + rng.integers(0, 3))
    return out


def test_variants_against_brute_force(spark):
    for words in (some_words(400, "ab", [6, 7, 8, 9], 1), some_words(300, "aé\U0001F600", [6, 7], 2)):
        want = brute(words)
        assert sum(r[4] for r in want) > 300 and any(r[2] not in (r[0], r[1]) for r in want)
        assert run(spark, words) == want
        assert run(spark, words, block=7, bucket_points=500) == want               # crowded keys in tiles of blocks


def test_ties_lengths_and_empties(spark):
    words = {"abcdef": 5, "abcdeg": 50, "abcdea": 50, "abcdefg": 50, "xxxxxx": 5, "xxxxxxx": 25, "xxxxxxxx": 125,
             "x" * 5000: 7, "x" * 5001: 70, "z" * 30: 9}
    got = run(spark, words)
    assert got == brute(words)
    assert [r[1:3] for r in got if r[0] in ("abcdef", "xxxxxx")] == [("abcdea", "abcdea"), ("xxxxxxx", "xxxxxxxx")]
    assert run(spark, []) == []
    df = spark.createDataFrame([("abcdef", 5, 1, "k"), (None, 7, 1, "k"), ("abcdeh", None, 1, "k")],
                               "word string, n long, length int, key string")
    assert [tuple(r) for r in S.group_variants(df).collect()] == [("abcdef", None, "abcdef", 5, 0, None)]


def test_words_against_plain_counting(spark):
    rng = np.random.default_rng(4)
    stock = ["Planet", "PLANET", "planeta", "École", "école-école", "naïveté", "ab×cde÷f", "a1bcdefgh", "short", "ßtraße", "longword" * 20, "日本語planet"]
    texts = [" ".join(rng.choice(stock, 60)) for _ in range(80)] + [None, "", "planet " * 30_000, "!?"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "planeta planeta")]
    total = Counter()
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            total[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    want = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    df = documents(spark, rows, {"word": "x", "n": 1})
    assert {r.word: r.n for r in S.count_words(df).collect()} == want
    assert {r.word: r.n for r in S.count_words(df, held=3).collect()} == want
    assert S.count_words(documents(spark, [])).collect() == []


def test_oracle(spark):
    import duckdb

    from bazaar.llm.queries import QUERIES
    from bazaar.llm.sql import SQL
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES["op13_spelling_variants"](spark, sf)
    want = con.execute(SQL["op13_spelling_variants"]).fetchall()
    names = [d[0] for d in con.description]
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=key) == sorted(want, key=key)
    assert len(want) > 100
