"""Byte-level BPE by prefix dynamic programming.

For each byte prefix of a piece the table holds the one token that can end the prefix's encoding.  A token t ending at i is
that token if the token stored at i - len(t) may stand before t, that is, if the merges of the two together never cross
their border.  Reading back from the end gives the encoding.  As no entry looks to the right, text can be appended without
touching what is there, and after an edit only the entries from the edit to the next point where old and new tables agree
again are computed anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import CachedEncoder, slices

PIECE_ENTRIES = 300_000
PAIR_ENTRIES = 1_000_000


class Vocabulary:
    """Ranks of byte strings, and for each token the two tokens that its last merge joins."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.parts: dict[int, tuple[int, int]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def merged(self, data: bytes, below: float = float("inf")) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals, with tokens of a rank under below."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                if (r := self.ranks.get(parts[i] + parts[i + 1], below)) < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, t: int) -> tuple[int, int]:
        """The two tokens that the merge making t joins; (t, t) for a single byte or a token that merging never makes."""
        if (found := self.parts.get(t)) is None:
            x = self.merged(self.token[t], t) if len(self.token[t]) > 1 else []
            found = self.parts[t] = (x[0], x[1]) if len(x) == 2 else (t, t)
        return found

    def adjacent(self, a: int, b: int) -> bool:
        """True if bytes of a before bytes of b merge to just these two tokens.

        The newest merge on either side of the border is undone step by step.  At each step the tokens that touch the
        border would have merged across it if their join had a rank lower than the merge undone last.
        """
        if (known := self._pairs.get((a, b))) is not None:
            return known
        left, right, limit, result = a, b, float("inf"), None
        while result is None:
            joined = self.ranks.get(self.token[left] + self.token[right])
            if joined is not None and joined < limit:
                result = False
                break
            for side in ((0, 1) if left > right else (1, 0)):
                if side == 0 and (inner := self.halves(left)[1]) != left:
                    limit, left = left, inner
                    break
                if side == 1 and (inner := self.halves(right)[0]) != right:
                    # equal ranks merge from the left, so a join of the same rank would have come first
                    limit, right = right + 1, inner
                    break
            else:
                result = True
        if len(self._pairs) >= PAIR_ENTRIES:
            self._pairs.clear()
        self._pairs[a, b] = result
        return result


class PrefixTable:
    """The encoding of one growing piece: last[i] is the token that ends the encoding of the first i bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _step(self, i: int) -> int:
        """The token that ends prefix i, from the entries before it."""
        v, data, last = self.vocabulary, self.data, self.last
        for j in range(max(0, i - v.longest), i):
            t = v.ranks.get(data[j:i])
            if t is not None and (v.adjacent(last[j], t) if j else v.halves(t)[0] != t or i == 1):
                return t
        raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> PrefixTable:
        begin = len(self.data)
        self.data += more
        for i in range(begin + 1, len(self.data) + 1):
            self.last.append(self._step(i))
        return self

    def edit(self, begin: int, end: int, new: bytes) -> int:
        """Replace data[begin:end]; returns how many entries were computed anew.

        Entries after the edit depend on at most the `longest` entries before them, so once that many in a row equal the
        old ones (moved along), all later ones do too.
        """
        old, shift = self.last, len(new) - (end - begin)
        self.data = self.data[:begin] + new + self.data[end:]
        self.last, same = old[: begin + 1], 0
        for i in range(begin + 1, len(self.data) + 1):
            self.last.append(t := self._step(i))
            after = i - begin - len(new)
            same = same + 1 if after >= 1 and old[i - shift] == t else 0
            if same > self.vocabulary.longest:
                done = i - begin
                self.last += old[i - shift + 1 :]
                return done
        return len(self.data) - begin

    def ids(self) -> list[int]:
        out, i, v = [], len(self.data), self.vocabulary
        while i > 0:
            out.append(self.last[i])
            i -= len(v.token[self.last[i]])
        return out[::-1]


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.cached = CachedEncoder(self._segments, spaced=True, width=4)
        n = 1 + max(vocabulary.token, default=0)
        self.number = [str(i) for i in range(n)]
        self.bytes = [vocabulary.token.get(i, b"") for i in range(n)]

    def piece(self, text: str) -> list[int]:
        data = text.encode()
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).ids()

    def _segments(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known, found, size = self.pieces, [], []
        if len(known) > PIECE_ENTRIES:
            known.clear()
        for s in segments.to_pylist():
            out = b""
            for p in self.find(s):
                if (ids := known.get(p)) is None:
                    ids = known[p] = np.array(self.piece(p), "<u4").tobytes()
                out += ids
            found.append(out)
            size.append(len(out) // 4)
        return np.frombuffer(b"".join(found), "<u4"), np.array(size, np.int64)

    def encode(self, texts: list[str | None] | pa.Array) -> list[list[int]]:
        return [np.frombuffer(b, "<u4").tolist() for b in self.cached.batch(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(Vocabulary.read(path), pattern)
    return _codecs[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text; null text: no ids; null ids stay null; repeated rows give repeated results; further
    columns are not read.  A map over the scan, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for lo, hi in slices(texts):
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(c.encode(texts.slice(lo, hi - lo)), pa.list_(pa.int32()))], ["id", "ids"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, f"id {dict(d.dtypes)['id']}, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text; null text: empty.  Repeated rows give repeated
    results; null doc_ids stay null; an empty table gives an empty one; further columns are not read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for lo, hi in slices(texts):
                n, a, d = [], [], []
                for ids in c.encode(texts.slice(lo, hi - lo)):
                    n.append(len(ids))
                    a.append(hashlib.sha256(" ".join(map(c.number.__getitem__, ids)).encode()).hexdigest())
                    d.append(hashlib.sha256(c.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
