"""Secret scan: base patterns, plus formats inferred as probabilistic automata from the labelled credentials."""
from __future__ import annotations

import hashlib
import json
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, text_of

KINDS = ("assign", "access", "hex")
FORMAT = "format"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
SMOOTH = 20.0
NOISE_BITS = math.log2(66)          # bits per character of an unpredictable credential character


def base_spans(text: str, runs: list | None = None) -> list[tuple]:
    """(start, kind index, end, value start) of the base patterns, in order; offsets are code points."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    # the other two kinds lie inside runs of credential characters
    for s, e in [m.span() for m in _RUN.finditer(text)] if runs is None else runs:
        if e - s >= 20:
            found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text, s, e) if m.end() - m.start() >= 20]
        if e - s >= 24:
            found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text, s, e) if m.end() - m.start() >= 24]
    return sorted(found)


def symbol(ch: str) -> str:
    """Symbol class of a character: "a" for letters and digits, else itself."""
    return "a" if ch.isalnum() else ch


class Automaton:
    """Probabilistic automaton over symbol classes with a character distribution per transition."""

    def __init__(self, states: list[dict], floor: float = 0.0):
        self.states, self.floor = states, floor
        self.all: dict[str, float] = defaultdict(lambda: 0.5)       # characters over all transitions
        for st in states:
            for edge in st["next"].values():
                for ch, c in edge["chars"].items():
                    self.all[ch] += c
        self.total = sum(self.all.values()) + 0.5 * 66

    def bits(self, value: str) -> float:
        """Mean log2 likelihood per character and the end.

        A transition's characters are smoothed by ``SMOOTH`` draws from those
        of the whole automaton, so rarely used states do not overfit.
        """
        at, total = 0, 0.0
        for ch in value:
            st = self.states[at]
            edge = st["next"].get(symbol(ch))
            if edge is None:                      # unseen: stay, at the price of a rare event
                total -= math.log2(st["n"] + 66)
                continue
            total += math.log2(edge["n"] / (st["n"] + 1)) + math.log2(
                (edge["chars"].get(ch, 0) + SMOOTH * self.all.get(ch, 0.5) / self.total) / (edge["n"] + SMOOTH))
            at = edge["to"]
        st = self.states[at]
        return (total + math.log2((st["end"] + 0.01) / (st["n"] + 1))) / (len(value) + 1)


def fit_format(values: list[str], quantile: float = 0.01) -> Automaton:
    """The automaton of all values; its floor is the ``quantile`` of scores of one half under the other's."""
    values = sorted(values, key=lambda v: (hashlib.sha256(v.encode()).digest(), v))
    halves = values[::2], values[1::2]
    held = sorted(m.bits(v) for m, other in zip(map(infer_automaton, halves), halves[::-1]) for v in other)
    machine = infer_automaton(values)
    machine.floor = held[int(quantile * (len(held) - 1))] - 1e-9
    return machine


def infer_automaton(values: list[str], alpha: float = 0.01) -> Automaton:
    """State merging (ALERGIA) over the prefix tree of ``values``.

    Red states are final; each blue child is compared with the red states in
    order of creation: two states are compatible if their end, symbol and
    character frequencies, and those of all their common successors, differ by
    less than the Hoeffding bound at ``alpha``.  Compatible states are merged
    and folded, others turn red.
    """
    n, end, kids, chars = [0], [0], [{}], [defaultdict(lambda: defaultdict(int))]
    for v in sorted(values):
        at = 0
        n[0] += 1
        for ch in v:
            s = symbol(ch)
            chars[at][s][ch] += 1
            if s not in kids[at]:
                kids[at][s] = len(n)
                n.append(0), end.append(0), kids.append({}), chars.append(defaultdict(lambda: defaultdict(int)))
            at = kids[at][s]
            n[at] += 1
        end[at] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    through: list[dict] = [{s: sum(c.values()) for s, c in chars[i].items()} for i in range(len(n))]

    def differ(f1, n1, f2, n2) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(a: int, b: int) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if (a, b) in seen or not n[a] or not n[b]:
                continue
            seen.add((a, b))
            if differ(end[a], n[a], end[b], n[b]):
                return False
            for s in through[a].keys() | through[b].keys():
                if differ(through[a].get(s, 0), n[a], through[b].get(s, 0), n[b]):
                    return False
                one, two = chars[a].get(s, {}), chars[b].get(s, {})
                if any(differ(one.get(ch, 0), n[a], two.get(ch, 0), n[b]) for ch in one.keys() | two.keys()):
                    return False
                if s in kids[a] and s in kids[b]:
                    todo.append((kids[a][s], kids[b][s]))
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            n[a] += n[b]
            end[a] += end[b]
            for s, k in kids[b].items():
                for ch, c in chars[b][s].items():
                    chars[a][s][ch] += c
                through[a][s] = through[a].get(s, 0) + through[b][s]
                if s in kids[a]:
                    todo.append((kids[a][s], k))
                else:
                    kids[a][s] = k

    red, done = [0], {0}
    while True:
        blue = next(((r, s, k) for r in red for s, k in sorted(kids[r].items()) if k not in done), None)
        if blue is None:
            break
        r, s, k = blue
        for other in red:
            if compatible(other, k):
                kids[r][s] = other
                fold(other, k)
                break
        else:
            red.append(k)
            done.add(k)
    place = {q: i for i, q in enumerate(red)}
    return Automaton([{"n": n[q], "end": end[q], "next": {
        s: {"to": place[k], "n": through[q][s], "chars": dict(chars[q][s])} for s, k in sorted(kids[q].items())}}
        for q in red])


def labelled_credentials(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, value) of every base match in every document."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string())])

    def find(batches):
        for batch in batches:
            kinds, values = [], []
            for t in batch.column(0):
                t = t.as_py()
                for s, k, e, v in base_spans(t):
                    kinds.append(KINDS[k])
                    values.append(t[v:e])
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], schema=schema)

    return docs.select(text_of(text_col).alias("text")).mapInArrow(find, "kind string, value string")


def learn_formats(docs: DataFrame, text_col: str = "text", sample: int = 1000, least: int = 30,
                  longest: int = 512, seed: int = 5) -> dict[str, dict]:
    """One automaton per kind, fit on at most ``sample`` distinct labelled credentials.

    The sample is the values of up to ``longest`` characters with the smallest
    seeded hash, so it does not depend on the partitioning.  Kinds with fewer
    than ``least`` values get none.  Each kind is trained in a task of its
    own; at most three automata come back.
    """
    known = labelled_credentials(docs, text_col).where(F.length("value") <= longest).distinct()
    first = Window.partitionBy("kind").orderBy(F.xxhash64(F.lit(seed), "value"), "value")
    chosen = known.withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample)

    def train(pdf):
        import pandas as pd
        values = pdf["value"].tolist()
        if len(values) < least:
            return pd.DataFrame({"kind": [], "model": []}, dtype=str)
        m = fit_format(values)
        return pd.DataFrame({"kind": [pdf["kind"].iloc[0]], "model": [json.dumps({"states": m.states, "floor": m.floor})]})

    rows = chosen.groupBy("kind").applyInPandas(train, "kind string, model string").collect()
    return {r["kind"]: json.loads(r["model"]) for r in sorted(rows, key=lambda r: r["kind"])}


def scan_text(text: str, machines: list[Automaton], margin: float = 1.0) -> tuple[list[tuple], list[tuple], float | None]:
    """Base spans, added spans and the best candidate score of one text.

    A candidate is a run of 12 or more credential characters with a letter and
    a digit; its score is the log2 likelihood per character under the best
    automaton.  It is added if it touches no base span, reaches that
    automaton's floor and beats random characters by ``margin`` bits each.
    """
    runs = [m.span() for m in _RUN.finditer(text)]
    base = base_spans(text, runs)
    added, best = [], None
    if machines:
        for s, e in runs:
            value = text[s:e]
            if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
                continue
            scores = [(m.bits(value), m.floor) for m in machines]
            top = max(b for b, _ in scores)
            best = top if best is None else max(best, top)
            if any(b >= f and b >= margin - NOISE_BITS for b, f in scores) and not any(x[0] < e and s < x[2] for x in base):
                added.append((s, len(KINDS), e, s))
    return base, added, best


def redact(text: str, spans: list[tuple], mark: str = "<secret>") -> str:
    """Replace the values of the spans (overlapping ones together) by ``mark``."""
    out, at = [], 0
    for s, e in sorted((v, e) for _, _, e, v in spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1000) -> DataFrame:
    """Secrets of every document: base spans, spans of inferred formats, scores.

    Returns the id, n_assign, n_access, n_hex, n_format, base_sha256 (lower-case
    hex SHA-256 of the base spans ``kind:start:end``), spans (all, comma-joined,
    by start then kind) and best_score (null without a candidate).  A base span
    is its whole match; offsets are code points.  Null texts are empty;
    repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    prepared(docs.sparkSession)
    models = learn_formats(docs, text_col, sample)
    names = (*KINDS, FORMAT)
    fields = [(id_col, pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
              ("n_format", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("best_score", pa.float64())]
    schema = pa.schema(fields)

    def scan(batches):
        machines = [Automaton(m["states"], m["floor"]) for m in models.values()]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = []
                for i, t in zip(part.column(0).to_pylist(), part.column(1)):
                    t = t.as_py()
                    base, added, best = scan_text(t, machines)
                    shown = [f"{names[k]}:{s}:{e}" for s, k, e, _ in sorted(base + added)]
                    of_base = ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in base)
                    n = [sum(x[1] == k for x in base) for k in range(3)]
                    rows.append([i, *n, len(added), hashlib.sha256(of_base.encode()).hexdigest(), ",".join(shown), best])
                cols = list(zip(*rows)) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    kind = f"`{id_col}` long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string, best_score double"
    return (docs.select(F.col(id_col).cast("long"), text_of(text_col).alias("text"))
            .mapInArrow(scan, kind))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", sample: int = 1000,
                   mark: str = "<secret>") -> DataFrame:
    """All rows and columns of ``docs`` with the values of found secrets replaced by ``mark``.

    Where a text changes, ``length_col`` (if there is one) is set to its new
    length.  Texts without secrets, and null texts, stay as they are.
    """
    prepared(docs.sparkSession)
    models = learn_formats(docs, text_col, sample)
    names, at = docs.columns, docs.columns.index(text_col)
    length_at = names.index(length_col) if length_col in names else None

    def mask(batches):
        machines = [Automaton(m["states"], m["floor"]) for m in models.values()]
        for batch in batches:
            texts, changed = [], []
            for t in batch.column(at).to_pylist():
                base, added, _ = scan_text(t, machines) if t else ([], [], None)
                changed.append(bool(base or added))
                texts.append(redact(t, base + added, mark) if changed[-1] else t)
            cols = list(batch.columns)
            cols[at] = pa.array(texts, pa.string())
            if length_at is not None:
                old = cols[length_at]
                cols[length_at] = pa.array([len(t) if c else n for t, c, n in zip(texts, changed, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(mask, docs.schema)
