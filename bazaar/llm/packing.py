"""Packing: best-fit decreasing over a segment tree of remaining capacities, planned on the length histogram."""
from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import numbered, prepared, saved, text_of

END_ID = 2
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[!-~¡-ÿ]+")          # no white space, nothing that NFC changes
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")              # white space to str.split, not to the tokenizer


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    at = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [at[b] for b in range(256)]


class WordTokenizer(dict):
    """White-space separated word -> its ids as little-endian 32-bit bytes.

    The tokenizer drops white space and never merges across it, so a text's
    ids are its words' ids in a row.  Words are encoded once and remembered
    (``limit`` words, then the memory starts anew).  Words of plain Latin-1
    characters are cut by the tokenizer's own pre-tokenizer pattern and go to
    its BPE model; all others through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        from tokenizers import Tokenizer
        self.whole, self.limit, self.parts = Tokenizer.from_file(path), limit, {}
        self.model, self.chars = self.whole.model, _byte_chars()

    def _encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            if len(self.parts) >= 2 * self.limit:
                self.parts.clear()
            coded = "".join(map(self.chars.__getitem__, part.encode()))
            got = self.parts[part] = np.array([t.id for t in self.model.tokenize(coded)], dtype="<u4").tobytes()
        return got

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        if _PLAIN.fullmatch(word) and "<|" not in word:
            low = word.lower()
            ids = self._part(low) if low.isalpha() else b"".join(map(self._part, _PIECES.findall(low)))
        else:
            ids = self._encode(word)
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self._encode(text)
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenized_pieces(docs: DataFrame, window: int = 4096, tokenizer_path: str | None = None,
                     with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens (and ids, if asked).

    A document is the tokenizer's ids of its text, then END_ID; overlong
    documents are cut into full windows and a rest.  Null and empty texts
    have the one id END_ID.
    """
    path = tokenizer_path or default_tokenizer()
    end = np.array([END_ID], dtype="<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def cut(batches):
        encode = word_tokenizer(path).ids
        step = 4 * window
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                cols: list[list] = [[] for _ in fields]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = encode(text.as_py()) + end
                    for at in range(0, len(ids), step):
                        own = ids[at:at + step]
                        row = (doc_id, at // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4)
                        for c, v in zip(cols, row):
                            c.append(v)
                        if with_ids:
                            cols[5].append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(cut, kind)


class CapacityTree:
    """Segment tree over remaining capacities 0..size: which of them have an open window."""

    def __init__(self, size: int):
        self.n = 1 << (size + 1).bit_length()
        self.any = bytearray(2 * self.n)

    def set(self, at: int, full: bool) -> None:
        i = at + self.n
        self.any[i] = full
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest marked capacity >= least."""
        i = least + self.n
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.n:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.n
            i //= 2
        return None


def best_fit_decreasing(histogram: dict[int, int], window: int) -> np.ndarray:
    """Runs (length, first rank, end rank, first sequence, pieces per sequence, offset) of the packing.

    The pieces of a length are alike, so best-fit decreasing places them in
    bulk: longest first, the next pieces fill the tightest open sequences;
    one filled with a piece stays the tightest while another fits, so each
    takes remaining // length of them.  Sequences that are alike form one
    range.  Work and runs depend on the window and the distinct lengths, not
    on how many pieces there are.
    """
    tree, open_, runs, opened = CapacityTree(window), {}, [], 0

    def give(capacity: int, first: int, end: int) -> None:
        if first < end and capacity:
            open_.setdefault(capacity, []).append((first, end))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                more = -(-left // (window // length))
                give(window, opened, opened + more)
                opened += more
                continue
            first, end = open_[capacity].pop()
            if not open_[capacity]:
                tree.set(capacity, False)
            per, offset = capacity // length, window - capacity
            whole = min(end - first, left // per)
            if whole:
                runs.append((length, rank, rank + whole * per, first, per, offset))
                give(capacity - per * length, first, first + whole)
                rank, left, first = rank + whole * per, left - whole * per, first + whole
            if left and first < end:
                runs.append((length, rank, rank + left, first, per, offset))
                give(capacity - left * length, first, first + 1)
                rank, left, first = rank + left, 0, first + 1
            give(capacity, first, end)
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, start, length, ...) by best-fit decreasing.

    Only the histogram of lengths (at most ``window`` rows) comes to the
    driver, and only the plan made from it goes out, bounded by the window.
    Pieces are numbered within their length in hashed blocks, so a length
    that a third of all pieces share is spread; each piece then finds its
    run by (length, rank).  ``pieces`` is read three times: pass a saved table.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = best_fit_decreasing(counts, window)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    blocks = max(8, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = numbered(pieces, ["length"], ["doc_id", "start", "ids_crc32"],
                      F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)), "rank")
    span = int(runs[:, 2].max(initial=0)) + 1
    keys = runs[:, 0] * span + runs[:, 1]

    def place(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rank = table["rank"].to_numpy()
            run = runs[np.searchsorted(keys, table["length"].to_numpy() * span + rank, side="right") - 1]
            at = rank - run[:, 1]
            out = table.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(run[:, 3] + at // run[:, 4]))
            out = out.append_column("offset", pa.array(run[:, 5] + at % run[:, 4] * run[:, 0]))
            yield from out.to_batches()

    from pyspark.sql.types import LongType, StructField, StructType
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = StructType(kept + [StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.select(*[f.name for f in kept], "rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, window: int = 4096, tokenizer_path: str | None = None,
                   with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32 (unsigned,
    over little-endian 32-bit ids), doc_tokens, sequence_id and offset (with
    ``with_ids`` also ids).  Each id lies in exactly one piece; offsets run
    without a gap.  Null ids are kept; repeated rows are packed each; an
    empty table gives no rows; columns beyond doc_id and text are ignored.
    """
    prepared(docs.sparkSession)
    return pack(saved(tokenized_pieces(docs, window, tokenizer_path, with_ids), "pieces"), window)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence from ``pack_documents(with_ids=True)``: its ids, and the pieces in order."""
    whole = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"))
    return whole.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
                        F.flatten("p.ids").alias("input_ids"), F.col("p.doc_id").alias("doc_ids"),
                        F.col("p.start").alias("starts"), F.col("p.length").alias("lengths"))
