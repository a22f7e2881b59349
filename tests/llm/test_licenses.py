import re

from tests.llm.helpers import documents

from bazaar.llm.licenses import BASE_PHRASES, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = WORD.findall((text or "").translate(LOWER))
    at = [(i, label) for p, label in BASE_PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
       "associated documentation files")
TEXTS = ["CC BY cc-by Cc By MIT License the MIT\nlicense, cc by", None, "", "by cc by by cc", "GNU General\tPublic  License",
         "GNU General Public", "ÉCC BY cc byÉ İmit license", MIT, MIT.replace("this", "that").upper(),
         MIT.replace("hereby", "gladly"), "x " * 30_000 + "Apache License", "apache license " * 500,
         "Boost Software License - Version 1.0", "!!! ---"]


def test_base_matches_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    both = docs.union(documents(spark, [(10 ** 6 + i, t) for i, t in enumerate(TEXTS)]).select("doc_id", "text"))
    got = {r["doc_id"]: r for r in scan_licenses(both).collect()}
    for r in both.collect():
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == plain(r["text"])
        assert set(filter(None, g["base_labels"].split(","))) <= set(g["labels"].split(",")) | {""}
        assert 0 <= g["score"] <= 1
    assert sum(g["n_base"] > 0 for g in got.values()) > 15


def test_templates(spark):
    got = {r["doc_id"]: r for r in scan_licenses(documents(spark, TEXTS, {"words": 1, "score": 2})).collect()}
    assert got[7]["labels"] == "mit" and got[7]["n_base"] == 0 and got[7]["score"] == 1.0
    assert got[8]["labels"] == "mit" and 0.9 < got[8]["score"] < 1.0
    assert got[9]["labels"] == ""                              # its key phrase is broken
    assert got[12]["labels"] == "bsl"


def test_hot_and_empty(spark):
    got = scan_licenses(documents(spark, [f"{MIT} and {i}" for i in range(50)])).collect()
    assert all(r["labels"] == "mit" for r in got)              # words in every file still index the template
    out = scan_licenses(documents(spark, ["a"]).limit(0))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
