"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first DEPTH bytes, most significant digits first; groups that are equal in all of them
are exactly the repeated windows, and a group with suffixes of one document only is dropped as soon as it arises.

The first digit is chosen so that few suffixes have to travel.  A window's anchor is the least GRAM-byte gram in it; equal
windows have equal anchors at equal places.  Some 13 successive windows share an anchor, so suffixes are moved as *runs*: one
record for an anchor and the stretch of text that its windows cover.

1. `find`: runs of a group of texts.  Those whose stretch a smaller document of the group has, byte for byte, are repeated.
2. `digits`: the others are sorted by anchor and by the 64-bit digit of their stretch.  An anchor met in one document is
   dropped.  Of runs with equal stretches the least document's stands for all; every window of the others is repeated.
3. `fetch`: at the documents, equal runs that follow each other become segments, and the SHA-256 of each segment's bytes is sent
   to the document that it is equal to.  Runs of anchors with several different stretches fetch their bytes.
4. `radix`: all windows of these are sorted by anchor, place and then eight bytes at a time, dropping groups after each pass,
   until DEPTH bytes are equal.
5. The documents collect their repeated windows and check every SHA-256 that was sent to them.  So nothing is removed because
   two short hashes happen to agree: a difference ends the job with an error that asks for another seed.

Records travel in blocks of byte planes.  The numbers of buckets follow the bytes of text alone, neither tasks nor partitions;
beyond FAN buckets blocks take two hops, the first to groups of buckets, so that a block always holds many records.  An anchor
that very many documents hold in different surroundings (found in a bounded sample) is not moved as runs: each of its windows
becomes a run of its own, keyed by all of its bytes, so that they spread.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grams import _mixed, gram_hashes, window_minima
from .shared import NULL_KEY, discard, giving_back, materialize, partitions, release, trimmed

DEPTH = 50
GRAM = 25
_SPAN = DEPTH - GRAM + 1
_LONGEST = DEPTH + _SPAN - 1
#: Bytes of text that are hashed together, and whose runs are merged together.
PIECE, GROUP = 1 << 20, 1 << 23
#: Bytes of text for each bucket of anchors and of documents, and the most buckets that a block is dealt to at once.
BUCKET, FAN = 1 << 23, 8192
#: Bytes of the sample for hot anchors, and how many different stretches make one there.
SAMPLE, HOT = 1 << 25, 32
_LOW = np.uint64((1 << 24) - 1)
_SENT = np.uint64((1 << 32) - 1)
_U = np.uint64

#: A run: windows start .. start + n - 1 of document (doc, tag), anchor at start + off.
RUN = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("n", "u1")])
OPEN = np.dtype([*RUN.descr, ("off", "u1"), ("anchor", "<u8"), ("stretch", "<u8")])
#: A run that is equal to the one of a smaller document (of, of_tag) at of_start.
EQUAL = np.dtype([*RUN.descr, ("of", "<i8"), ("of_tag", "<u4"), ("of_start", "<u4")])
ASKED = np.dtype([*RUN.descr, ("off", "u1"), ("anchor", "<u8")])
FETCHED = np.dtype([*ASKED.descr, ("bytes", "u1", (_LONGEST,))])
#: Bytes to remove, and what a document's bytes must hash to.
MARK = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("length", "<u4")])
CLAIM = np.dtype([*MARK.descr, ("sha", "u1", (16,))])
KINDS = [OPEN, RUN, EQUAL, ASKED, FETCHED, MARK, CLAIM]
BLOCKS = "p int, kind int, block binary"


class Differs(RuntimeError):
    """Two different stretches have one hash."""


class Plan(NamedTuple):
    anchors: int
    docs: int
    hot: np.ndarray
    seed: int
    fan: int

    @property
    def anchor_step(self) -> int:
        return -(-self.anchors // self.fan)

    @property
    def doc_step(self) -> int:
        return -(-self.docs // self.fan)


def tag_of(data: bytes) -> int:
    """Tells rows with one doc_id apart."""
    return zlib.crc32(data)


def pieces(data: bytes, size: int | None = None) -> Iterator[tuple[int, bytes]]:
    """A text in parts that share DEPTH - 1 bytes, so that each window lies in just one."""
    size = size or PIECE
    for begin in range(0, max(1, len(data) - DEPTH + 1), size):
        yield begin, data[begin : begin + size + DEPTH - 1]


def runs(parts: list[bytes], hot: np.ndarray | None = None, seed: int = 0) -> tuple[np.ndarray, ...]:
    """(part, start, n, off, anchor hash, stretch hash) of every run in the parts, each of which has DEPTH bytes or more."""
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.cumsum(size) - size
    g = gram_hashes(np.frombuffer(b"".join(parts), np.uint8), GRAM)
    key = (g & ~_LOW) | (_LOW - np.arange(len(g), dtype=_U))
    least = window_minima(key, _SPAN)
    inside = np.ones(len(least), bool)
    for b in begin[1:].tolist():
        inside[b - DEPTH + 1 : b] = False
    at = np.flatnonzero(inside)
    anchor = (_LOW - (least[at] & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1)]))
    n = np.diff(np.concatenate([first, [len(at)]]))
    start, anchor = at[first], anchor[first]
    off, name = anchor - start, g[anchor]
    if hot is not None and len(hot) and (spread := hot[np.searchsorted(hot, name).clip(max=len(hot) - 1)] == name).any():
        own = np.flatnonzero(spread)
        w = np.repeat(start[own], n[own]) + np.arange(n[own].sum()) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        whole = _mixed(g[w] * _U(0xD1B54A32D192ED03) + g[w + GRAM] * _U(0xABC98388FB8FAC03))
        rest = ~spread
        start, n, off, name = (np.concatenate([x[rest], y]) for x, y in ((start, w), (n, np.ones(len(w), n.dtype)), (off, np.zeros(len(w), off.dtype)), (name, whole)))
    end = start + n - 1 + DEPTH
    stretch = _mixed(g[start] * _U(0x9E3779B97F4A7C15) + g[start + GRAM] * _U(0xC2B2AE3D27D4EB4F) + g[end - GRAM] * _U(0x165667B19E3779F9) + ((n * 64 + off).astype(_U) + _U(seed << 16)) * _U(0x27D4EB2F165667C5))
    part = np.searchsorted(begin, start, "right") - 1
    return part, start - begin[part], n, off, name, stretch


def _first_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Index of the first row of each group of equal keys."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _group_of(first: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[first[1:]] = 1
    return np.cumsum(out)


def _met_again(key: np.ndarray) -> np.ndarray:
    """Rows whose key another row has, too, in order of key."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    keep = np.zeros(len(key), bool)
    keep[1:] |= same
    keep[:-1] |= same
    return order[keep]


# Blocks: the documents in a row with the number of their records, then the other columns as planes of bytes, which compress.


def _planes(column: np.ndarray) -> bytes:
    column = np.ascontiguousarray(column)
    return column.view("u1").reshape(len(column), -1).T.tobytes()


def pack(rows: np.ndarray) -> bytes:
    first = _first_of(rows["doc"], rows["tag"])
    size = np.diff(np.concatenate([first, [len(rows)]])).astype("<u4")
    head = np.array([len(rows), len(first)], "<u4").tobytes() + _planes(rows["doc"][first]) + _planes(rows["tag"][first]) + _planes(size)
    return head + b"".join(_planes(rows[c]) for c in rows.dtype.names[2:])


def unpack(block: bytes, of: np.dtype) -> np.ndarray:
    m, k = np.frombuffer(block, "<u4", 2).tolist()
    at = 8

    def planes(n: int, kind: np.dtype) -> np.ndarray:
        nonlocal at
        own = np.frombuffer(block, "u1", n * kind.itemsize, at).reshape(kind.itemsize, n)
        at += own.size
        return np.ascontiguousarray(own.T).view(kind.base).reshape(n, *kind.shape)

    doc, tag, size = planes(k, of["doc"]), planes(k, of["tag"]), planes(k, np.dtype("<u4"))
    out = np.zeros(m, of)
    out["doc"], out["tag"] = np.repeat(doc, size), np.repeat(tag, size)
    for c in of.names[2:]:
        out[c] = planes(m, of[c])
    return out


def records(of: np.dtype, size: int, /, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(size, of)
    for name, x in columns.items():
        out[name] = x
    return out


def _dealt(p: np.ndarray, rows: np.ndarray, step: int = 1) -> Iterator[tuple[int, int, bytes]]:
    """Rows as one block for each of the buckets p (or group of step buckets)."""
    p = p // step
    order = np.argsort(p, kind="stable")
    p, rows = p[order], rows[order]
    first = _first_of(p)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(p)], strict=False):
        yield int(p[a]), KINDS.index(rows.dtype), pack(rows[a:b])


def _rows_of(blocks: Iterable[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*blocks, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["p", "kind", "block"])


def _of_kind(blocks: list[tuple[int, bytes]], of: np.dtype) -> np.ndarray:
    kind = KINDS.index(of)
    found = [unpack(b, of) for k, b in blocks if k == kind]
    return np.concatenate(found) if found else np.zeros(0, of)


def _blocks(table: pa.Table) -> list[tuple[int, bytes]]:
    return list(zip(table.column("kind").to_pylist(), (b.as_py() for b in table.column("block")), strict=True))


def anchor_bucket(anchor: np.ndarray, n: int) -> np.ndarray:
    """Anchors are least hashes, so their high bits are small; mixed again, they spread."""
    return ((_mixed(anchor) >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)


def doc_bucket(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    """As in `_dealt_texts`.  The tag spreads the rows of one doc_id (or of none)."""
    return (doc ^ (doc >> 16) ^ (doc >> 32) ^ tag.astype(np.int64)) % n


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """Blocks of one bucket at a time, from rows sorted by it."""
    now, held = None, []
    for b in batches:
        for p, kind, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if p != now and held:
                yield held
                held = []
            now = p
            held.append((kind, block.as_py()))
    if held:
        yield held


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a : a + length] == data[b : b + length], of pairs of places in padded data."""
    view = np.lib.stride_tricks.sliding_window_view(data, _LONGEST)
    out = np.zeros(len(a), bool)
    beyond = np.arange(_LONGEST)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        out[s] = ((view[a[s]] == view[b[s]]) | (beyond >= length[s, None])).all(1)
    return out


def _find(batches: Iterable[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Texts to blocks: OPEN runs by anchor, and RUNs that are already known to be repeated (with any bucket)."""
    held: list[tuple[int, int, int, bytes]] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    texts: list[bytes] = []
    total = in_piece = turn = 0

    def hash_piece() -> None:
        nonlocal held, in_piece
        parts = [x[3] for x in held]
        part, start, n, off, anchor, stretch = runs(parts, plan.hot, plan.seed)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        place = sum(map(len, texts)) + (np.cumsum(size) - size)[part] + start
        doc, tag, base = (np.array([x[i] for x in held], t) for i, t in ((0, np.int64), (1, np.uint32), (2, np.int64)))
        found.append((records(OPEN, len(part), doc=doc[part], tag=tag[part], start=start + base[part], n=n, off=off, anchor=anchor, stretch=stretch), place))
        texts.extend(parts)
        held, in_piece = [], 0

    def flush() -> pa.RecordBatch:
        nonlocal found, texts, total, turn
        if held:
            hash_piece()
        rows, place = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        data = np.frombuffer(b"".join([*texts, bytes(_LONGEST)]), np.uint8)
        found, texts, total = [], [], 0  # each part of the memory goes as soon as it can
        again = _met_again(rows["stretch"])
        again = again[np.lexsort((rows["doc"][again], rows["stretch"][again]))]
        group = _group_of(_first_of(rows["stretch"][again]), len(again))
        least = again[_first_of(group)][group] if len(again) else again
        later = rows["doc"][again] > rows["doc"][least]
        again, least = again[later], least[later]
        sure = _same_bytes(data, place[again], place[least], rows["n"][again].astype(np.int64) + DEPTH - 1)
        known = np.zeros(len(rows), bool)
        known[again[sure]] = True
        sent = rows if not known.any() else rows[~known]
        bucket = anchor_bucket(sent["anchor"], plan.anchors)
        if plan.anchor_step == 1:
            sent["anchor"] &= _SENT  # the bucket stands for the rest
        more = records(RUN, int(known.sum()), **{c: rows[c][known] for c in RUN.names})
        del rows, place, data
        out = list(_dealt(bucket, sent, plan.anchor_step))
        if len(more):
            turn += 1
            out += _dealt(np.full(len(more), (int(more["doc"][0]) + turn) % plan.anchors), more, plan.anchor_step)
        return _rows_of(out)

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            data = (text.as_py() or "").encode()
            if len(data) < DEPTH:
                continue
            tag = tag_of(data)
            for base, piece in pieces(data):
                held.append((NULL_KEY if doc is None else doc, tag, base, piece))
                total += len(piece)
                in_piece += len(piece)
                if total >= GROUP:
                    yield flush()
                elif in_piece >= PIECE:
                    hash_piece()
    if held or found:
        yield flush()


def _digits(batches: Iterable[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Blocks of one bucket of anchors to blocks by document: repeated runs, equal runs, and runs whose bytes are to be sorted."""

    def dealt(rows: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        rows = rows[np.lexsort((rows["start"], rows["tag"], rows["doc"]))]
        return _dealt(doc_bucket(rows["doc"], rows["tag"], plan.docs), rows, plan.doc_step)

    for blocks in _by_bucket(batches):
        out = list(dealt(known)) if len(known := _of_kind(blocks, RUN)) else []
        rows = _of_kind(blocks, OPEN)
        rows = rows[_met_again(rows["anchor"])]
        if len(rows):
            rows = rows[np.lexsort((rows["doc"], rows["stretch"], rows["anchor"]))]
            first = _first_of(rows["stretch"], rows["anchor"])
            least = first[_group_of(first, len(rows))]
            repeated = rows["doc"] > rows["doc"][least]
            if repeated.any():
                of = rows[least[repeated]]
                out += dealt(records(EQUAL, len(of), of=of["doc"], of_tag=of["tag"], of_start=of["start"], **{c: rows[c][repeated] for c in RUN.names}))
            by_anchor = _first_of(rows["anchor"])
            several = np.maximum.reduceat(rows["doc"], by_anchor) > np.minimum.reduceat(rows["doc"], by_anchor)
            stretches = np.zeros(len(rows), np.int64)
            stretches[first] = 1
            ask = (several & (np.add.reduceat(stretches, by_anchor) > 1))[_group_of(by_anchor, len(rows))] & ~repeated
            if ask.any():
                out += dealt(records(ASKED, int(ask.sum()), **{c: rows[c][ask] for c in ASKED.names}))
        if out:
            yield _rows_of(out)


def _regrouped(batches: Iterable[pa.RecordBatch], bucket: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The second hop: blocks of a group of buckets to blocks of the buckets."""
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        out = []
        for kind in sorted({k for k, _ in held}):
            rows = _of_kind(held, KINDS[kind])
            out += _dealt(bucket(rows), rows)
        return _rows_of(out)

    for b in batches:
        for kind, block in zip(b.column(1).to_pylist(), b.column(2), strict=True):
            held.append((kind, block.as_py()))
            size += len(held[-1][1])
            if size >= GROUP:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _delivered(blocks: DataFrame, step: int, bucket: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Blocks of buckets; those of groups of buckets take another hop."""
    if step > 1:
        blocks = blocks.repartition(partitions(blocks.sparkSession), "p").mapInArrow(giving_back(lambda it: _regrouped(it, bucket)), BLOCKS)
    return blocks


def _in_order(rows: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Records of each document, by start."""
    rows = rows[np.lexsort((rows["start"], rows["tag"], rows["doc"]))]
    first = _first_of(rows["doc"], rows["tag"])
    return {(int(rows["doc"][a]), int(rows["tag"][a])): rows[a:b] for a, b in zip(first.tolist(), [*first[1:].tolist(), len(rows)], strict=False)}


def _segments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one document's equal runs: first row, start and length of each stretch that they cover together with one document at
    one distance."""
    apart = rows["start"].astype(np.int64) - rows["of_start"]
    rows = rows[order := np.lexsort((rows["start"], apart, rows["of_tag"], rows["of"]))]
    apart, start, n = apart[order], rows["start"].astype(np.int64), rows["n"].astype(np.int64)
    new = np.ones(len(rows), bool)
    new[1:] = (apart[1:] != apart[:-1]) | (rows["of"][1:] != rows["of"][:-1]) | (rows["of_tag"][1:] != rows["of_tag"][:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    return rows[first], start[first], start[last] + n[last] - 1 + DEPTH - start[first]


def _covered(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches as a sorted union that leaves no two that meet."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + length)[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return start[first], end[np.concatenate([first[1:], [len(start)]]) - 1] - start[first]


def _texts_of(texts: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text"), strict=True):
        data = (text.as_py() or "").encode()
        yield NULL_KEY if doc is None else doc, tag_of(data), data


def _fetch(given: pa.Table, texts: pa.Table, plan: Plan) -> pa.Table:
    """At a bucket of documents: marks of repeated and equal runs, claims on the documents that they are equal to, and the
    bytes that were asked for."""
    blocks = _blocks(given)
    known, equal, asked = (_of_kind(blocks, k) for k in (RUN, EQUAL, ASKED))
    known, equal, asked = _in_order(known), _in_order(equal), _in_order(asked)
    marks, claims, fetched = [], [], []
    for doc, tag, data in _texts_of(texts) if known or equal or asked else ():
        key = (doc, tag)
        own, same, wanted = known.pop(key, None), equal.pop(key, None), asked.pop(key, None)
        start, length = [], []
        if own is not None:
            start.append(own["start"].astype(np.int64))
            length.append(own["n"].astype(np.int64) + DEPTH - 1)
        if same is not None:
            rows, begin, size = _segments(same)
            start.append(begin)
            length.append(size)
            sha = b"".join(hashlib.sha256(data[a : a + m]).digest()[:16] for a, m in zip(begin.tolist(), size.tolist(), strict=True))
            claims.append(records(CLAIM, len(rows), doc=rows["of"], tag=rows["of_tag"], start=rows["of_start"], length=size, sha=np.frombuffer(sha, "u1").reshape(-1, 16)))
        if start:
            a, m = _covered(np.concatenate(start), np.concatenate(length))
            marks.append(records(MARK, len(a), doc=doc, tag=tag, start=a, length=m))
        if wanted is not None:
            padded = np.frombuffer(data + bytes(_LONGEST), "u1")
            got = padded[wanted["start"].astype(np.int64)[:, None] + np.arange(_LONGEST)]
            fetched.append(records(FETCHED, len(wanted), bytes=got, **{c: wanted[c] for c in ASKED.names}))
    out = []
    for rows in (np.concatenate(x) for x in (marks, claims) if x):
        rows = np.unique(rows.view(f"V{rows.dtype.itemsize}")).view(rows.dtype)  # of equal claims one is enough
        out += _dealt(doc_bucket(rows["doc"], rows["tag"], plan.docs), rows, plan.doc_step)
    if fetched:
        rows = np.concatenate(fetched)
        out += _dealt(anchor_bucket(rows["anchor"], plan.anchors), rows, plan.anchor_step)
    out = pa.Table.from_batches([_rows_of(out)])
    trimmed()
    return out


def _radix(rows: np.ndarray) -> np.ndarray:
    """Repeated windows, as runs, among the fetched runs: most significant digits first."""
    which = np.repeat(np.arange(len(rows)), rows["n"])
    shift = np.arange(len(which)) - np.repeat(np.cumsum(rows["n"], dtype=np.int64) - rows["n"], rows["n"])
    doc = rows["doc"]
    # the digit before all others: anchor and its place in the window
    order = np.lexsort((rows["off"][which].astype(np.int64) - shift, rows["anchor"][which]))
    which, shift = which[order], shift[order]
    first = _first_of(rows["anchor"][which], rows["off"][which].astype(np.int64) - shift)
    group = _group_of(first, len(which))

    def shared(group: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows of groups with two documents or more."""
        d = doc[which]
        return (np.maximum.reduceat(d, first) > np.minimum.reduceat(d, first))[group] if len(first) else np.zeros(0, bool)

    for at in range(0, DEPTH, 8):
        keep = shared(group, first)
        which, shift, group = which[keep], shift[keep], group[keep]
        width = min(8, DEPTH - at)
        digit = np.zeros((len(which), 8), "u1")
        for i in range(width):
            digit[:, i] = rows["bytes"][which, shift + at + i]
        digit = digit.view("<u8").ravel()
        order = np.lexsort((digit, group))
        which, shift, group, digit = which[order], shift[order], group[order], digit[order]
        first = _first_of(group, digit)
        group = _group_of(first, len(which))
    if not len(which):
        return np.zeros(0, MARK)
    d = doc[which]
    later = d > np.minimum.reduceat(d, first)[group]
    which, shift = which[later], shift[later]
    order = np.lexsort((shift, which))
    which, shift = which[order], shift[order]
    begin = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (np.diff(shift) != 1)])) if len(which) else np.zeros(0, np.int64)
    r = rows[which[begin]]
    return records(MARK, len(r), doc=r["doc"], tag=r["tag"], start=r["start"] + shift[begin].astype("<u4"), length=np.diff(np.concatenate([begin, [len(which)]])) + DEPTH - 1)


def hot_anchors(docs: DataFrame, total: int) -> np.ndarray:
    """Anchors with HOT different stretches or more in a sample of about SAMPLE bytes, sorted.  They decide how runs travel, not
    what is found.  The driver gets SAMPLE / HOT of them at most."""
    share = -(-total // SAMPLE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            _, _, _, _, anchor, stretch = runs(held)
            anchor = anchor[np.unique(stretch, return_index=True)[1]]
            anchor, n = np.unique(anchor, return_counts=True)
            anchor, n = anchor[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n, pa.int64())], ["anchor", "n"])

        for b in batches:
            for t in b.column(0):
                if len(data := t.as_py().encode()) >= DEPTH:
                    for _, piece in pieces(data):
                        held.append(piece)
                        size += len(piece)
                        if size >= PIECE:
                            yield flush()
                            held, size = [], 0
        if held:
            yield flush()

    sample = docs.select("text").where(f"octet_length(text) >= {DEPTH}").where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    counted = sample.repartition(4).mapInArrow(giving_back(run), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r.anchor for r in counted.where(f"n >= {HOT}").select("anchor").collect()], np.int64).view(_U))


def planned(docs: DataFrame, seed: int) -> Plan:
    """Buckets from the bytes of all texts, and hot anchors."""
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(1, -(-total // BUCKET))
    return Plan(buckets, buckets | 1, hot_anchors(docs, total) if total else np.zeros(0, _U), seed, FAN)


def _marks(docs: DataFrame, plan: Plan) -> DataFrame:
    """Blocks of MARKs and CLAIMs by bucket of documents."""
    spark, to_docs, to_anchors = docs.sparkSession, lambda rows: doc_bucket(rows["doc"], rows["tag"], plan.docs), lambda rows: anchor_bucket(rows["anchor"], plan.anchors)
    once = lambda rows: np.full(len(rows), int(rows["doc"][0]) % plan.anchors) if rows.dtype == RUN else to_anchors(rows)
    sort, n = (lambda df: df.repartition(n, "p").sortWithinPartitions("p")), partitions(spark)
    found = _delivered(docs.select("doc_id", "text").mapInArrow(giving_back(lambda it: _find(it, plan)), BLOCKS), plan.anchor_step, once)
    digits = materialize(_delivered(sort(found).mapInArrow(giving_back(lambda it: _digits(it, plan)), BLOCKS), plan.doc_step, to_docs), "suffix-digits")
    release(spark)
    fetched = digits.groupBy("p").cogroup(_dealt_texts(docs, plan.docs).groupBy("p")).applyInArrow(lambda a, b: _fetch(a, b, plan), BLOCKS)
    fetched = materialize(fetched, "suffix-fetched")
    discard(digits)
    release(spark)

    def radix(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _by_bucket(batches):
            rows = _radix(_of_kind(blocks, FETCHED))
            yield _rows_of(_dealt(doc_bucket(rows["doc"], rows["tag"], plan.docs), rows, plan.doc_step))

    bytes_ = f"kind = {KINDS.index(FETCHED)}"
    sorted_ = sort(_delivered(fetched.where(bytes_), plan.anchor_step, to_anchors)).mapInArrow(giving_back(radix), BLOCKS)
    return _delivered(fetched.where(f"NOT {bytes_}").union(materialize(sorted_, "suffix-radix")), plan.doc_step, to_docs)


def _dealt_texts(docs: DataFrame, n: int) -> DataFrame:
    """docs with p, the bucket of `doc_bucket`, and all their own columns in one struct, whatever their names."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))
    mixed = key.bitwiseXOR(F.shiftright(key, 16)).bitwiseXOR(F.shiftright(key, 32)).bitwiseXOR(F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(F.pmod(mixed, F.lit(n)).cast("int").alias("p"), "doc_id", "text", F.struct(*own).alias("others") if own else F.lit(None).cast("int").alias("others"))


def removed_mask(size: int, marks: np.ndarray | None) -> np.ndarray:
    """True for each byte that a mark covers."""
    step = np.zeros(size + 1, np.int32)
    if marks is not None:
        start = marks["start"].astype(np.int64)
        np.add.at(step, start, 1)
        np.add.at(step, start + marks["length"], -1)
    return np.cumsum(step[:-1]) > 0


def _masks(given: pa.Table, texts: pa.Table) -> Iterator[tuple[bytes, np.ndarray]]:
    """Text and mask of each row; all claims on these texts hold, or else `Differs`."""
    blocks = _blocks(given) if given.num_rows else []
    marks, claims = _in_order(_of_kind(blocks, MARK)), _in_order(_of_kind(blocks, CLAIM))
    for doc, tag, data in _texts_of(texts):
        for c in claims.pop((doc, tag), ()):
            if hashlib.sha256(data[c["start"] : int(c["start"]) + int(c["length"])]).digest()[:16] != c["sha"].tobytes():
                raise Differs("two different stretches have one hash: run it again with another seed")
        yield data, removed_mask(len(data), marks.get((doc, tag)))
    if claims:
        raise Differs("the text that a stretch is equal to is not there")


def summary(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every text.

    Null text: empty.  A null doc_id counts as smaller than any other; rows with one doc_id are different documents of equal
    rank, so neither removes from the other; an empty table gives no row; further columns are not read.  Rows that are equal in
    doc_id and text share a bucket.
    """
    docs = docs.select("doc_id", "text")

    def run(given: pa.Table, texts: pa.Table) -> pa.Table:
        size, gone, spans, sha = [], [], [], []
        for data, mask in _masks(given, texts):
            size.append(len(data))
            gone.append(int(mask.sum()))
            spans.append(int(np.count_nonzero(mask[1:] & ~mask[:-1]) + mask[:1].sum()))
            sha.append(hashlib.sha256(np.frombuffer(data, "u1")[~mask].tobytes() if gone[-1] else data).hexdigest())
        trimmed()
        return pa.table([texts.column("doc_id").cast(pa.int64()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    plan = planned(docs, seed)
    marks = _marks(docs, plan)
    release(docs.sparkSession)
    return marks.groupBy("p").cogroup(_dealt_texts(docs, plan.docs).groupBy("p")).applyInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame, seed: int = 0) -> DataFrame:
    """docs with every repeated byte taken out of text (and n_chars, if there is such a column, of what is left).

    A cut inside a character's bytes drops the rest of that character.  Rows whose text the cut empties go; null and empty texts
    stay as they are.  All other columns keep their values, whatever their names; nulls, ties and repeated rows as in `summary`.
    """
    names, kinds = docs.columns, dict(docs.dtypes)

    def run(given: pa.Table, texts: pa.Table) -> pa.Table:
        new, stays = [], []
        for text, (data, mask) in zip(texts.column("text"), _masks(given, texts), strict=True):
            new.append(np.frombuffer(data, "u1")[~mask].tobytes().decode(errors="ignore") if mask.any() else text.as_py())
            stays.append(bool(new[-1]) or not data)
        trimmed()
        return pa.table([texts.column("doc_id"), pa.array(new, pa.string()), texts.column("others").combine_chunks()], ["doc_id", "text", "others"]).filter(pa.array(stays, pa.bool_()))

    plan = planned(docs, seed)
    marks, texts = _marks(docs, plan), _dealt_texts(docs, plan.docs)
    release(docs.sparkSession)
    out = marks.groupBy("p").cogroup(texts.groupBy("p")).applyInArrow(run, f"doc_id {kinds['doc_id']}, text string, others {texts.schema['others'].dataType.simpleString()}")
    out = out.select(*(F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in names))
    return out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kinds["n_chars"])) if "n_chars" in names else out
