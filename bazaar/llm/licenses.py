"""License scan: a positional index of each template's rarest words, intersected and verified per file."""
from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import text_of

# Base phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences of well-known licences (words only), their label and a key phrase that must occur in place.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", "permission is hereby granted free of charge"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", "for any purpose with or without fee"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd", "source and binary forms"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache", "apache license"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", "gnu general public license"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", "gnu lesser general public license"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl", "mozilla public license"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered software"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by", "creative commons attribution"),
    ("licensed under cc by 4 0", "cc-by", "cc by"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl", "eclipse public license"),
    ("boost software license version 1 0", "bsl", "boost software license"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lowered, runs of digits, a-z and non-ASCII characters."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _BREAK), "")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Rows, and for each licence word the rows that hold it, over the whole table.

    At most one row per word of the fixed vocabulary comes back.
    """
    held = words.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect("words", _strings(vocabulary)))).alias("w"))
    got = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return got.get("", 0), {w: got.get(w, 0) for w in vocabulary}


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _place_of(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_words: int = 4,
                  lookups: int = 64, least_share: float = 0.8) -> DataFrame:
    """Licence phrases and texts of every document, by a positional rare-token index.

    The index posts, per template, its ``rare_words`` words of highest IDF
    (over this table) with their offsets; a base phrase posts its one rarest
    word.  A file looks up its ``lookups`` licence words of highest IDF (words
    of base phrases always); a word at position p posted at offset o votes for
    the template starting at p - o.  A start with at least half of the posted
    words is verified: the key phrase must stand in its place, and the share
    of the template's words in place must reach ``least_share`` (1 for base
    phrases, so every base place is found: it holds its rarest word).

    Returns the id, n_words, n_base (all base places), first_word and
    last_word (smallest and largest base start, else null), base_labels,
    labels (also the method's; both distinct, sorted, comma-joined) and score
    (best verified share, else 0).  Null texts are empty; repeated rows stay;
    an empty table gives no rows; other columns are ignored.  Everything is a
    column expression of its row: only the word counts are shuffled.
    """
    base = [(p.split(), label, p.split()) for p, label in BASE_PHRASES]
    own = [(t.split(), label, key.split()) for t, label, key in TEMPLATES]
    vocabulary = sorted({w for t, _, _ in base + own for w in t})
    words = docs.select(F.col(id_col), words_of(text_of(text_col)).alias("words"))
    rows, df = document_frequencies(words, vocabulary)
    idf = {w: math.log((rows + 1) / (df[w] + 1)) for w in vocabulary}
    by_rarity = sorted(vocabulary, key=lambda w: (-idf[w], w))
    anchors = {min(t, key=lambda w: (-idf[w], w)) for t, _, _ in base}

    # (template number, words, label, key phrase, its offset, posted words, votes needed, share needed)
    index = []
    for t, label, key in base:
        index.append((t, label, key, 0, [min(t, key=lambda w: (-idf[w], w))], 1, 1.0))
    for t, label, key in own:
        rare = sorted(set(t), key=lambda w: (-idf[w], w))[:rare_words]
        index.append((t, label, key, _place_of(t, key), rare, -(-sum(Counter(t)[w] for w in rare) // 2), least_share))
    posted = sorted({w for _, _, _, _, ws, _, _ in index for w in ws}, key=by_rarity.index)

    n = F.size("words")
    # the file's licence words of highest IDF: posted is in that order, and so is the intersection
    present = F.array_intersect(_strings(posted), F.col("words"))
    looked = F.array_union(F.slice(present, 1, lookups), F.array_intersect(_strings(sorted(anchors)), F.col("words")))
    base_rows = words.withColumn("n_words", n.cast("long")).withColumn("looked", looked)

    def hits(found: Column) -> Column:
        at = F.transform(F.col("words"), lambda w, i: F.when(F.array_contains(found, w), F.struct(i.alias("p"), w.alias("w"))))
        return F.filter(at, lambda h: h.isNotNull())

    none = F.array().cast("array<struct<p:int,w:string>>")
    hit = base_rows.withColumn("hits", F.when(F.size("looked") > 0, hits(F.col("looked"))).otherwise(none))

    def places(t, key, key_at, ws, votes, share) -> Column:
        """Verified (start, share) of one template."""
        def starts_by(w, o):
            return F.transform(F.filter("hits", lambda h: h["w"] == w), lambda h: h["p"] - F.lit(o))

        starts = F.flatten(F.array(*[starts_by(w, o) for w in ws for o, x in enumerate(t) if x == w]))
        distinct = F.array_distinct(starts)
        enough = distinct if votes <= 1 else F.filter(
            distinct, lambda s: F.size(F.filter(starts, lambda x: x == s)) >= votes)
        here = lambda s, o: F.get("words", s + F.lit(o))
        keyed = F.filter(enough, lambda s: reduce(and_, [F.coalesce(here(s, key_at + j) == w, F.lit(False))
                                                       for j, w in enumerate(key)]))
        def matched(s):
            total = F.lit(0)
            for o, w in enumerate(t):
                total = total + F.when(here(s, o) == w, 1).otherwise(0)
            return total / F.lit(float(len(t)))
        scored = F.transform(keyed, lambda s: F.struct(s.alias("s"), matched(s).alias("m")))
        return F.filter(scored, lambda x: x["m"] >= share)

    cols = [places(t, key, at, ws, votes, share) for t, _, key, at, ws, votes, share in index]
    empty = F.array().cast("array<struct<s:int,m:double>>")
    some = F.size("hits") > 0
    found = hit.select(id_col, "n_words", *[F.when(some, c).otherwise(empty).alias(f"t{i}") for i, c in enumerate(cols)])

    def labels(numbers) -> Column:
        each = [F.when(F.size(f"t{i}") > 0, F.lit(index[i][1])) for i in numbers]
        return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*each), lambda x: x.isNotNull()))), ",")

    n_base = len(base)
    starts = F.flatten(F.array(*[F.col(f"t{i}.s") for i in range(n_base)]))
    shares = F.flatten(F.array(*[F.col(f"t{i}.m") for i in range(len(index))]))
    return found.select(
        F.col(id_col), "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(range(n_base)).alias("base_labels"), labels(range(len(index))).alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"))
