from bazaar.llm.chat import format_chats

COLS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t is not None, t if t is not None else 0, r or "", x or ""))
    seqs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    out, groups = {}, {}
    for c, s in seqs.items():
        groups.setdefault(tuple(s), []).append(c)
    for s, ids in groups.items():
        if not any(len(o) > len(s) and tuple(o[:len(s)]) == s for o in seqs.values()):
            keep = min(ids, key=lambda c: (c is not None, c if c is not None else 0)) if None in ids and len(ids) == 1 else \
                min(c for c in ids if c is not None)
            out[keep] = ("".join(f"<|{r}|>\n{x}\n" for r, x in s), len(s), len(ids))
    return out


def run(spark, rows, chunk=1024):
    got = {}
    for r in sorted(format_chats(spark.createDataFrame(rows, COLS), chunk).collect(), key=lambda r: r["chunk"]):
        old = got.get(r["conv_id"], ("", 0, 0))
        got[r["conv_id"]] = (old[0] + r["rendered"], r["n_turns"], r["copies"])
    return got


def test_collapse(spark):
    talk = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    rows = []
    for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)):
        rows += [(conv, i, *talk[i]) for i in range(n)]
    rows += [(6, 0, "user", "a"), (6, 1, "assistant", "other"), (7, 0, "user", "b"), (7, 1, "user", "a")]
    rows += [(8, 0, "user", None), (8, 0, "user", None), (9, 3, None, "x"), (9, None, "user", "y"), (10, 5, "user", "a")]
    assert run(spark, rows) == brute(rows)
    assert set(run(spark, rows)) == {2, 6, 7, 8, 9}


def test_many_turns_split(spark, monkeypatch):
    import bazaar.llm.chat as chat
    rows = [(1, i, "user", f"t{i % 3}") for i in range(200)] + [(2, i, "user", f"t{i % 3}") for i in range(150)]
    rows += [(3, i, "user", f"t{i % 3}") for i in range(149)] + [(3, 149, "user", "end")]
    whole = chat.turn_prefixes
    monkeypatch.setattr(chat, "turn_prefixes", lambda c: whole(c, 7))
    assert run(spark, rows, 16) == brute(rows)


def test_edges(spark):
    assert run(spark, [(None, 0, "user", "a"), (None, 1, "user", "b")]) == {None: ("<|user|>\na\n<|user|>\nb\n", 2, 1)}
    empty = spark.createDataFrame([], COLS)
    assert format_chats(empty).count() == 0


def test_extra_columns_and_plan(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 0, "user", "x" * 100_000)], COLS).withColumn("chunk", F.lit(7)).withColumn("pos", F.lit(1))
    out = format_chats(df)
    assert out.collect()[0]["chunk"] == 0
    assert "Python" not in out._jdf.queryExecution().toString()
