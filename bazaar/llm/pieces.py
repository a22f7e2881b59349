"""SentencePiece encoding and decoding: piece occurrences by a suffix array, then merges relaxed over them."""
from __future__ import annotations

import functools
import re
import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import prepared, text_of

SPACE = "▁"                                   # the model's sign for a space
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _keys(codes: np.ndarray, width: int) -> np.ndarray:
    """Each suffix's first ``width`` code points (zero-padded) as one sortable byte string."""
    padded = np.concatenate([codes, np.zeros(width, dtype=">u4")]).astype(">u4")     # big-endian: bytes sort as numbers
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[:len(codes)]
    return np.ascontiguousarray(windows).view(f"S{4 * width}").ravel()


def chunks_of(text: str) -> list[str]:
    """The text's chunks, each without the space sign that starts it."""
    if not text:
        return []
    if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _CHUNK.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


class PieceModel(dict):
    """Chunk of text -> its ids as little-endian 32-bit bytes (``limit`` chunks are remembered).

    No piece holds the space sign after another character, so a text falls
    into independent chunks before each run of space signs; equal chunks are
    encoded once.
    """

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__()
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        special = [m.is_control(i) or m.is_byte(i) or m.is_unknown(i) for i in range(n)]
        self.limit, self.pieces = limit, [m.id_to_piece(i) for i in range(n)]
        self.score = [m.get_score(i) for i in range(n)]
        self.silent = {i for i in range(n) if m.is_control(i)}
        self.byte = {i: int(self.pieces[i][3:5], 16) for i in range(n) if m.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.known = [i for i in range(n) if not special[i]]
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in self.known):
            raise ValueError("a piece holds a space inside: chunks are not independent")
        # single ASCII bytes are characters of their own; other byte ids take the slow way
        self.plain = np.array([chr(self.byte[i]) if i in self.byte else "" if i in self.silent else p
                               for i, p in enumerate(self.pieces)], dtype=object)
        self.joined = np.array([self.byte.get(i, 0) >= 0x80 for i in range(n)])
        self.known_ids, self.known_score = np.array(self.known), np.array([self.score[i] for i in self.known])
        self.width = max(len(self.pieces[i]) for i in self.known)
        size = np.array([len(self.pieces[i]) for i in self.known])
        codes = np.zeros((len(self.known), self.width), dtype=">u4")
        for row, i in zip(codes, self.known):
            row[:len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        last = codes.copy()
        last[np.arange(self.width) >= size[:, None]] = 0xFFFFFFFF      # above any suffix that starts with the piece
        self.size, self.low, self.high = size, codes.view(f"S{4 * self.width}").ravel(), last.view(f"S{4 * self.width}").ravel()

    def occurrences(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece id) of every piece in ``text``, by position: suffix array and two binary searches a piece."""
        keys = _keys(np.frombuffer(text.encode("utf-32-be", "surrogatepass"), dtype=">u4"), self.width)
        suffixes = np.argsort(keys, kind="stable")
        ranked = keys[suffixes]
        first, end = np.searchsorted(ranked, self.low), np.searchsorted(ranked, self.high, side="right")
        n = end - first
        at = suffixes[np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        which = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((self.size[which], at))
        return at[order], which[order]

    def _ids(self, symbol: str) -> list[int]:
        """Byte ids of a character that no piece holds."""
        return [self.byte_id[b] for b in symbol.encode("utf-8", "surrogatepass")]

    def _relax_long(self, chunk: str, edges: dict[int, int]) -> bytes:
        """Merge neighbouring symbols of one chunk along its edges, best score first, then leftmost."""
        n, w = len(chunk), self.width + 1
        after, before = list(range(1, n + 1)), list(range(-1, n))
        score = self.score
        agenda = [(-score[p], i, i + 2) for i in range(n - 1) if (p := edges.get(i * w + 2)) is not None]
        heapify(agenda)
        while agenda:
            _, s, e = heappop(agenda)
            mid = after[s]
            if mid < 0 or mid >= n or after[mid] != e:
                continue                                   # one of its symbols has gone into another
            after[s], after[mid] = e, -1
            if e < n:
                before[e] = s
                far = after[e]
                if far - s < w and (p := edges.get(s * w + far - s)) is not None:
                    heappush(agenda, (-score[p], s, far))
            b = before[s]
            if b >= 0 and e - b < w and (p := edges.get(b * w + e - b)) is not None:
                heappush(agenda, (-score[p], b, e))
        ids, at = [], 0
        while at < n:
            p = edges.get(at * w + after[at] - at)
            ids += self._ids(chunk[at:after[at]]) if p is None else [p]
            at = after[at]
        return np.array(ids, dtype="<u4").tobytes()

    def _relax(self, text: str, starts: np.ndarray, at: np.ndarray, which: np.ndarray, owner: np.ndarray) -> list[bytes]:
        """The same merges for all chunks of ``text`` at once: in a round each chunk takes its best open edge.

        An edge is open if it spans exactly two current symbols; it is gone
        when a symbol no longer starts at one of its ends.
        """
        n, w = len(text), self.width + 1
        size, score = self.size[which], self.known_score[which]
        alive = np.ones(n + 1, dtype=bool)
        order = np.lexsort((at, -score, owner))
        order = order[size[order] > 1]
        s, e, who = at[order], (at + size)[order], owner[order]
        while len(s):
            count = np.cumsum(alive)
            ready = np.flatnonzero(count[e] - count[s] == 2)
            if not len(ready):
                break
            own = who[ready]
            take = ready[np.r_[True, own[1:] != own[:-1]]]
            alive[np.flatnonzero(alive)[count[s[take]]]] = False         # where the second symbol starts
            # chunks without a taken edge are done; edges with a lost end are gone
            live = np.zeros(len(starts), dtype=bool)
            live[own] = True
            keep = live[who] & alive[s] & alive[e]
            s, e, who = s[keep], e[keep], who[keep]
        alive[starts[1:] - 1] = False                                       # the separators are no symbols
        first = np.flatnonzero(alive[:n])
        end = np.minimum(np.r_[first[1:], n], starts[np.searchsorted(starts, first, side="right")] - 1)
        keys = at * w + size
        by = np.argsort(keys, kind="stable")
        found = np.minimum(np.searchsorted(keys[by], first * w + end - first), max(len(keys) - 1, 0))
        hit = keys[by][found] == first * w + end - first if len(keys) else np.zeros(len(first), dtype=bool)
        ids = np.zeros(len(first), dtype=np.int64)
        if len(keys):
            ids[hit] = self.known_ids[which[by][found[hit]]]
        wide = np.ones(len(first), dtype=np.int64)
        spelled = {int(i): self._ids(text[first[i]:end[i]]) for i in np.flatnonzero(~hit)}
        for i, x in spelled.items():
            wide[i] = len(x)
        place = np.r_[0, np.cumsum(wide)]
        flat = np.repeat(ids, wide)
        for i, x in spelled.items():
            flat[place[i]:place[i] + len(x)] = x
        cut = (4 * place[np.searchsorted(first, starts)]).tolist()
        raw = flat.astype("<u4").tobytes()
        return [raw[cut[i]:cut[i + 1]] for i in range(len(starts) - 1)]

    def learn(self, keys: list[str], batch_chars: int = 200_000, long: int = 256) -> None:
        """Encode new chunks (given without their first space sign), a concatenation of about ``batch_chars`` characters at a time.

        Chunks of over ``long`` characters stand alone and merge by a heap: the same merges, in n log n steps.
        """
        chunks = [SPACE + k for k in keys]
        lo = 0
        while lo < len(chunks):
            hi, total = lo, 0
            while hi < len(chunks) and (hi == lo or len(chunks[hi]) <= long >= len(chunks[lo]) and total < batch_chars):
                total += len(chunks[hi]) + 1
                hi += 1
            part = chunks[lo:hi]
            starts = np.cumsum([0] + [len(c) + 1 for c in part])
            text = "\0".join(part) + "\0"
            at, which = self.occurrences(text)
            owner = np.searchsorted(starts, at, side="right") - 1
            whole = at + self.size[which] < starts[owner + 1]
            at, which, owner = at[whole], which[whole], owner[whole]
            if len(part[0]) > long:
                spots = (at * (self.width + 1) + self.size[which]).tolist()
                self[keys[lo]] = self._relax_long(part[0], dict(zip(spots, self.known_ids[which].tolist())))
            else:
                self.update(zip(keys[lo:hi], self._relax(text, starts, at, which, owner)))
            lo = hi

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        cut = list(map(chunks_of, texts))
        wanted = set().union(*cut)
        new = sorted(wanted.difference(self))
        if len(self) + len(new) > self.limit:                  # start anew, with what this batch uses
            kept = {c: self[c] for c in wanted.difference(new)}
            self.clear()
            self.update(kept)
        self.learn(new)
        return [b"".join(map(self.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids) -> str:
        """Text of the ids; ids outside the vocabulary raise, byte ids that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        if not self.joined[ids].any():
            text = "".join(self.plain[ids].tolist())
            return (text[1:] if text.startswith(SPACE) else text).replace(SPACE, " ")
        out, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte:
                raw.append(self.byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.silent:
                out.append(self.pieces[i])
        out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return (text[1:] if text.startswith(SPACE) else text).replace(SPACE, " ")


@functools.lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_pieces(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the SentencePiece ids of every whole text.

    Null and empty texts have no ids; repeated rows are encoded each; an empty
    table gives no rows; other columns are ignored.
    """
    prepared(docs.sparkSession)
    path = model_path or default_model()
    schema = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches):
        model = piece_model(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                coded = model.encode_batch(part.column(1).to_pylist())
                offsets = np.cumsum([0] + [len(b) // 4 for b in coded])
                flat = np.frombuffer(b"".join(coded), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), ids], schema=schema)

    return (docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("text"))
            .mapInArrow(encode, f"`{id_col}` long, ids array<int>"))


def decode_pieces(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_crc32, text): the text of every row's ids, their number and CRC-32 (null ids: none)."""
    prepared(encoded.sparkSession)
    path = model_path or default_model()
    schema = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("text", pa.string())])

    def decode(batches):
        model = piece_model(path)
        for batch in batches:
            rows = []
            for i, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = ids.values.to_numpy(zero_copy_only=False).astype("<u4") if ids.is_valid else np.zeros(0, "<u4")
                rows.append((i, len(own), zlib.crc32(own.tobytes()), model.decode(own)))
            cols = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return encoded.select(F.col(id_col).cast("long").alias(id_col), "ids").mapInArrow(
        decode, f"`{id_col}` long, n_tokens long, ids_crc32 long, text string")
