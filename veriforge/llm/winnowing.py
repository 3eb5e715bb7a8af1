"""Document fingerprints by winnowing.

Of the rolling hashes of a text's k-grams (bytes of its UTF-8), the minimum of each window of w consecutive ones is kept, the
rightmost among equals, with its position.  Any stretch of k + w - 1 bytes that two texts share gives both the same hash at
matching positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grams import gram_hashes, window_minima
from .shared import ranges

GRAM = 20
WINDOW = 45
#: Windows looked at together; bounds the memory that a long text takes.
_PART = 1 << 20
_LOW = np.uint64((1 << 24) - 1)


def winnow(data: bytes, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 40-bit hashes kept.  A text shorter than a window is one window; shorter than a gram, one gram; empty: none."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    k = min(k, n)
    grams = n - k + 1
    w = min(w, grams)
    buffer = np.frombuffer(data, np.uint8)
    positions, hashes = [], []
    for begin in range(0, grams - w + 1, _PART):
        end = min(grams, begin + _PART + w - 1)
        h = gram_hashes(buffer[begin : end + k - 1], k) >> np.uint64(24)
        # the later of equal hashes is the smaller key
        key = (h << np.uint64(24)) | (_LOW - np.arange(len(h), dtype=np.uint64))
        least = window_minima(key, w)
        kept = least[np.concatenate([[True], least[1:] != least[:-1]])]
        at = (_LOW - (kept & _LOW)).astype(np.int64) + begin
        new = at > positions[-1][-1] if positions else np.ones(len(at), bool)
        positions.append(at[new])
        hashes.append((kept >> np.uint64(24))[new])
        if not len(positions[-1]):
            positions.pop(), hashes.pop()
    return np.concatenate(positions), np.concatenate(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of hashes in common among all of both (Jaccard); 1 for two empty fingerprints."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def shared_stretches(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of positions (in a, in b) at which two fingerprints hold the same hash.

    The guarantee: of any stretch of k + w - 1 bytes that both texts have, at places i and j, there is a pair (p, q) with
    p - i = q - j from 0 to w - 1.
    """
    places: dict[int, list[int]] = {}
    for p, h in zip(b[0].tolist(), b[1].tolist(), strict=True):
        places.setdefault(h, []).append(p)
    return [(p, q) for p, h in zip(a[0].tolist(), a[1].tolist(), strict=True) for q in places.get(h, ())]


def fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """doc_id, positions array<long>, hashes array<long> of every text.  A map over the scan.

    Null text: empty, with no hash; equal texts have equal fingerprints; null doc_ids stay null; an empty table gives no row;
    further columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [winnow((t.as_py() or "").encode(), k, w) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p for p, _ in found], pa.list_(pa.int64())), pa.array([h.astype(np.int64) for _, h in found], pa.list_(pa.int64()))], ["doc_id", "positions", "hashes"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, positions array<long>, hashes array<long>")


def written(hashes: np.ndarray) -> str:
    """Ten hexadecimal digits for each hash, in order of position."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many code points of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Every whole text against its edited form and the next document, in descending order of doc_id; positions holds the byte
    places of the fingerprint's hashes.

    Null text: empty; null doc_id: last; rows with one doc_id are ordered by text; the last document's next is the first; an
    empty table gives no row.  The order is cut into ranges, and the range before also gets a copy of the rows with a range's
    largest doc_id; the driver holds one number for each range.  Each task streams through its sorted ranges.
    """
    ranged, _ = ranges(docs.select("doc_id", "text"), "doc_id")
    tops = sorted((r["range_no"], r["top"]) for r in ranged.groupBy("range_no").agg(F.max("order_key").alias("top")).collect())
    guests = docs.sparkSession.createDataFrame([(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)], "order_key long, host int")  # bounded: one row a range
    placed = ranged.join(F.broadcast(guests), "order_key", "left").select("doc_id", "text", "order_key", F.explode(F.expr("filter(array(struct(range_no AS r, false AS guest), struct(host AS r, true AS guest)), x -> x.r IS NOT NULL)")).alias("p"))
    ordered = placed.select("p.r", "p.guest", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "order_key").repartition("r").sortWithinPartitions("r", "guest", F.desc("order_key"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_range, out = None, None, []

        def row(own: tuple, text: str, hashes: np.ndarray) -> tuple:
            new = edited(own[1], text).encode()
            edit = winnow(new, k, w)[1]
            return own[0], len(own[1]), hashlib.sha256(new).hexdigest(), written(own[2]), written(edit), likeness(own[2], edit), likeness(own[2], hashes), own[3]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], NAMES)

        for b in batches:
            for r, guest, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if r != held_range:
                    held = None
                elif guest and held is None:
                    continue  # the first guest has served
                text = text.as_py()
                positions, hashes = winnow(text.encode(), k, w)
                if held is not None:
                    out.append(row(held, text, hashes))
                held, held_range = None if guest else (key, text, hashes, positions), r
                if len(out) >= 256:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return ordered.select("r", "guest", "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]
