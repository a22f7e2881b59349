import hashlib
import random
import re
import string

from tests.llm.helpers import documents

from bazaar.llm.secrets import Automaton, base_spans, find_secrets, infer_automaton, redact_secrets

ANY = "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
WORDS = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
PLAIN = {"assign": (rf"({WORDS}|{ANY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
         "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}


def plain(text):
    text = text or ""
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, ok)) in enumerate(PLAIN.items())
             for m in re.finditer(p, text) if ok(m)]
    return [s for _, _, s in sorted(found)]


TEXTS = ["password=abcdef token:token:abcdefgh api_key = 'A.b/c+d=e_f-' APIKEY=\"123456\" secret= 12345",
         "é😀 Token = \"" + "a1" * 20 + "\" x", "AKIA" + "B" * 16 + "c AKIA" + "1" * 15 + "AKIA" + "2" * 30,
         "f" * 24 + "g" + "e" * 23 + " " + "0" * 5000, "passwd:\"xyzxyz", "toKen=abcdef Kpassword=ſecret1 ſecret=abcdefg",
         None, "", "token=token=abcdefgh", "key " * 40_000 + "secret=zzzzzzz"]


def test_base_matches_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    small = documents(spark, [(10 ** 6 + i, t) for i, t in enumerate(TEXTS)]).select("doc_id", "text")
    both = docs.union(small)
    got = {r["doc_id"]: r for r in find_secrets(both).collect()}
    n = 0
    for r in both.collect():
        want, row = plain(r["text"]), got[r["doc_id"]]
        n += len(want)
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(w.startswith(k) for w in want) for k in PLAIN]
        assert [s for s in row["spans"].split(",") if s and not s.startswith("format")] == want
    assert n > 30 and len(got) == both.count()


def key(rng):
    return "sk_live_" + "".join(rng.choices(string.ascii_letters + string.digits, k=24))


def test_format_is_inferred_and_found(spark):
    rng = random.Random(4)
    texts = [f"my api_key = \"{key(rng)}\" there" for _ in range(120)]
    bare = [key(rng) for _ in range(5)]
    texts += [f"see {b} here" for b in bare] + ["thand_therble_ing_12345678", "4785380592391139 a1b2c3d4e5f6 x" * 3, None, ""]
    docs = documents(spark, texts, {"spans": "old"})
    got = {r["doc_id"]: r for r in find_secrets(docs).collect()}
    for i, b in enumerate(bare):
        assert got[120 + i]["spans"] == f"format:4:{4 + len(b)}" and got[120 + i]["n_format"] == 1
    assert all(got[i]["spans"] == "" for i in range(125, 129))
    assert got[127]["best_score"] is None
    masked = {r["doc_id"]: r for r in redact_secrets(docs).collect()}
    assert masked[0]["text"] == "my api_key = \"<secret>\" there" and masked[0]["n_chars"] == len(masked[0]["text"])
    assert masked[120]["text"] == "see <secret> here" and masked[127]["text"] is None
    assert masked[125]["text"] == texts[125] and masked[125]["spans"] == "old"
    assert redact_secrets(docs).columns == docs.columns


def test_automaton_learns_length_and_alphabet():
    rng = random.Random(1)
    m = infer_automaton(["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(500)])
    assert len(m.states) == 41
    good = "".join(rng.choices("0123456789abcdef", k=40))
    assert m.bits(good) > m.bits(good[:39]) + 0.1 and m.bits(good) > m.bits("z" * 40) + 2
    chain = infer_automaton([w for w in ("ab", "abab", "ababab", "abababab", "ababababab") for _ in range(300)])
    assert any(e["to"] <= i for i, s in enumerate(chain.states) for e in s["next"].values()) or len(chain.states) <= 11
    # probabilities of every state add up to one
    for s in m.states + chain.states:
        assert s["n"] == s["end"] + sum(e["n"] for e in s["next"].values())


def test_empty(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert find_secrets(docs).count() == 0 and redact_secrets(docs).count() == 0
    assert base_spans("") == [] and Automaton([{"n": 1, "end": 1, "next": {}}]).bits("") < 0
