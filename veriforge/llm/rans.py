"""Token ids in files coded by a static range asymmetric numeral system.

A file holds up to FILE_TOKENS ids of consecutive documents, in ascending doc_id order:

* one frequency table, scaled to 2**SCALE and shared by all blocks of the file;
* independent blocks of BLOCK_TOKENS ids.  A block's ids are dealt in turn to LANES interleaved coders; its checkpoint
  holds each lane's final state and word count, so a block is decoded alone, and all of its lanes at once;
* a directory with each block's ids, payload size and CRC-32 of its ids, and the documents' ids and lengths.

All lanes of all blocks of a file advance together in NumPy arrays, encoding and decoding alike.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import NULL_KEY, materialize, ranges
from .tokenizing import worker_encoder, slices

SCALE = 20
LANES = 32
BLOCK_TOKENS = 1 << 14
FILE_TOKENS = 1 << 21
MAGIC = b"RANS0001"
#: A state stays in [2**31, 2**63) between symbols; 32 bits move at a time.
_LOW = np.uint64(1 << 31)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to the sum 2**SCALE, none that occurs below 1.  The largest ones take the rounding."""
    total, top = int(counts.sum()), 1 << SCALE
    if len(counts) > top // 2:
        raise ValueError("too many symbols for the table's scale")
    f = np.maximum(1, counts.astype(np.float64) * (top / total)).astype(np.int64)
    over = int(f.sum()) - top
    if over <= 0:
        f[np.argmax(f)] -= over
        return f
    for i in np.argsort(-f, kind="stable"):
        take = min(over, int(f[i]) // 2)
        f[i] -= take
        over -= take
        if not over:
            return f
    raise AssertionError("unreachable: half of the mass is above 1")


def _shape(n: int) -> tuple[int, int]:
    return -(-n // BLOCK_TOKENS), BLOCK_TOKENS // LANES


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, list[bytes]]:
    """Frequency table, directory of blocks, and one payload for each block."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols), dtype=np.int32)
    index = place[ids]
    freq = scaled(counts[symbols])
    start = np.cumsum(freq) - freq
    blocks, steps = _shape(len(ids))
    padded = np.zeros(blocks * BLOCK_TOKENS, np.int32)
    padded[: len(ids)] = index
    grid = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, blocks * LANES)
    live = np.zeros(blocks * BLOCK_TOKENS, bool)
    live[: len(ids)] = True
    live = np.ascontiguousarray(live.reshape(blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, blocks * LANES)
    f64, s64, shift = freq.astype(np.uint64), start.astype(np.uint64), np.uint64(SCALE)
    x = np.full(blocks * LANES, _LOW, np.uint64)
    words = np.empty((steps, blocks * LANES), np.uint32)
    moved = np.zeros((steps, blocks * LANES), bool)
    for i in range(steps - 1, -1, -1):
        sym, on = grid[i], live[i]
        f = f64[sym]
        full = on & (x >= (f << np.uint64(63 - SCALE)))
        words[i] = x.astype(np.uint32)
        moved[i] = full
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = np.where(on, (q << shift) + (x - q * f) + s64[sym], x)
    by_block = np.ascontiguousarray(moved.reshape(steps, blocks, LANES).transpose(1, 2, 0))  # a lane's words lie together, in reading order
    word_block = words.reshape(steps, blocks, LANES).transpose(1, 2, 0)
    n_words = by_block.sum(2).astype("<u2")
    states = x.astype("<u8").reshape(blocks, LANES)
    payloads = [states[b].tobytes() + n_words[b].tobytes() + word_block[b][by_block[b]].astype("<u4").tobytes() for b in range(blocks)]
    whole = ids.astype("<u4")
    directory = b"".join(struct.pack("<III", min(BLOCK_TOKENS, len(ids) - b * BLOCK_TOKENS), len(p), zlib.crc32(whole[b * BLOCK_TOKENS : (b + 1) * BLOCK_TOKENS].tobytes())) for b, p in enumerate(payloads))
    return np.stack([symbols.astype("<u4"), freq.astype("<u4")]).tobytes(), directory, payloads


def decode_blocks(symbols: np.ndarray, freq: np.ndarray, payloads: list[bytes], sizes: list[int]) -> np.ndarray:
    """Ids of the given blocks of one file, any of them, in any order, all lanes at once."""
    blocks, steps = len(payloads), BLOCK_TOKENS // LANES
    start = np.cumsum(freq) - freq
    slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    head = LANES * 8
    x = np.concatenate([np.frombuffer(p, "<u8", LANES) for p in payloads])
    n_words = np.concatenate([np.frombuffer(p, "<u2", LANES, head) for p in payloads]).astype(np.int64)
    words = np.concatenate([np.frombuffer(p, "<u4", offset=head + 2 * LANES) for p in payloads] + [np.zeros(1, "<u4")])
    at = np.cumsum(n_words) - n_words
    sizes_of = np.repeat(np.asarray(sizes, np.int64), LANES)
    lane = np.tile(np.arange(LANES), blocks)
    turns = (sizes_of - lane + LANES - 1) // LANES
    f64, s64, mask, shift = freq.astype(np.uint64), start.astype(np.uint64), np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    out = np.zeros((steps, blocks * LANES), np.uint32)
    for i in range(min(steps, int(turns.max(initial=0)))):
        on = turns > i
        low = x & mask
        k = slot[low]
        out[i] = k
        y = f64[k] * (x >> shift) + low - s64[k]
        refill = on & (y < _LOW)
        y = np.where(refill, (y << np.uint64(32)) | words[np.where(refill, at, len(words) - 1)], y)
        at += refill
        x = np.where(on, y, x)
    grid = out.reshape(steps, blocks, LANES).transpose(1, 0, 2).reshape(blocks, BLOCK_TOKENS)
    return symbols[np.concatenate([grid[b, :n] for b, n in enumerate(sizes)])] if blocks else np.zeros(0, np.uint32)


def write_file(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One file: magic, sizes of the parts, documents, table and directory (deflated), payloads, CRC-32 of all before it."""
    table, directory, payloads = encode_ids(ids) if len(ids) else (b"", b"", [])
    docs = zlib.compress(doc_ids.astype("<i8").tobytes() + lengths.astype("<i8").tobytes(), 1)
    table = zlib.compress(np.frombuffer(table, "u1").reshape(-1, 4).T.tobytes(), 1) if table else b""
    body = MAGIC + struct.pack("<IIIII", len(doc_ids), len(docs), len(table), len(payloads), len(ids)) + docs + table + directory + b"".join(payloads)
    return body + struct.pack("<I", zlib.crc32(body))


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, doc_ids, lengths) of a file; ValueError if a checksum differs."""
    if data[:8] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("not a token file, or damaged")
    n_docs, d, t, n_blocks, n = struct.unpack_from("<IIIII", data, 8)
    at = 28
    docs = zlib.decompress(data[at : at + d])
    at += d
    doc_ids, lengths = np.frombuffer(docs, "<i8", n_docs), np.frombuffer(docs, "<i8", n_docs, 8 * n_docs)
    if not n:
        return np.zeros(0, np.uint32), doc_ids, lengths
    both = np.frombuffer(np.frombuffer(zlib.decompress(data[at : at + t]), "u1").reshape(4, -1).T.tobytes(), "<u4").reshape(2, -1)
    at += t
    entries = [struct.unpack_from("<III", data, at + 12 * b) for b in range(n_blocks)]
    at += 12 * n_blocks
    payloads = []
    for _, size, _ in entries:
        payloads.append(data[at : at + size])
        at += size
    ids = decode_blocks(both[0], both[1].astype(np.int64), payloads, [e[0] for e in entries])
    for b, (size, _, crc) in enumerate(entries):
        if zlib.crc32(ids[b * BLOCK_TOKENS : b * BLOCK_TOKENS + size].astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {b} is damaged")
    return ids, doc_ids, lengths


def write_files(docs: DataFrame, vocabulary: str, end_id: int, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Files of docs(doc_id, text): range_no, file_no, first (ids of earlier documents in the range), n_tokens, data.

    Documents are dealt to ranges of doc_id of like size; each range is sorted, encoded and cut into files by one task as a
    stream, so memory is bounded by file_tokens and the longest text.  A document is never split between files.
    """
    ranged, _ = ranges(docs.select("doc_id", "text"), "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = worker_encoder(vocabulary, spaced=True), np.array([end_id], "<u2").tobytes()
        now, file_no, first, parts, keys, lengths, held = None, 0, 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = write_file(np.frombuffer(b"".join(parts), "<u2").astype(np.uint32), np.array(keys, np.int64), np.array(lengths, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([file_no], pa.int32()), pa.array([first], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())], ["range_no", "file_no", "first", "n_tokens", "data"])

        for b in batches:
            rows, ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            for lo, hi in slices(texts):
                for r, k, enc in zip(rows[lo:hi], ids[lo:hi], tok.batch(texts.slice(lo, hi - lo)), strict=True):
                    if keys and (r != now or held >= file_tokens):
                        yield flush()
                        file_no, first = (file_no + 1, first + held) if r == now else (0, 0)
                        parts, keys, lengths, held = [], [], [], 0
                    now = r
                    parts.append(enc + end)
                    keys.append(k)
                    lengths.append(n := len(enc) // 2 + 1)
                    held += n
        if keys:
            yield flush()

    ordered = ranged.repartition("range_no").sortWithinPartitions("range_no", "order_key", "text").select("range_no", "order_key", "text")
    return ordered.mapInArrow(run, "range_no int, file_no int, first long, n_tokens long, data binary")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone.

    The driver adds up one total for each range (a fixed multiple of the shuffle partitions); all else is a map over files.
    """
    totals = sorted((r["range_no"], r["n"]) for r in files.groupBy("range_no").agg(F.sum("n_tokens").alias("n")).collect())
    before, base = 0, {}
    for r, n in totals:
        base[r] = before
        before += n

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, first, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                ids, keys, lengths = read_file(data.as_py())
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=keys == NULL_KEY), pa.array(base[r] + first + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("range_no", "first", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write every document's ids with end_id after each, in ascending doc_id order, and read the files back.

    Null and empty texts hold just the end id; a null doc_id comes first; rows with one doc_id are ordered by text; an
    empty table gives no file and no row; further columns are not read.
    """
    return read_files(materialize(write_files(docs, vocabulary, end_id), "token-files"))
