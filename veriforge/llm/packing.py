"""Packing by concatenating and cutting.

Pass 1 tokenises each input partition as a stream and writes, for each document, its ids and the number of ids before it in
its partition.  The partitions' totals (one number each) are added up to global offsets.  Pass 2 cuts the endless stream of
ids into fixed windows: a document that crosses a window's border gives one boundary record on either side.  Nothing is
shuffled and no document needs to know any other: its offset alone fixes its pieces.  Only the last sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize
from .tokenizing import CACHE_ENTRIES, slices, worker_encoder

WINDOW = 2048


class Room(NamedTuple):
    """What a worker holds at once: segments in either generation of its cache, bytes of text, rows of a batch.  Less room costs
    CPU time and changes no result."""

    entries: int = CACHE_ENTRIES
    text: int = 1 << 23
    rows: int | None = None


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, room: Room) -> DataFrame:
    """doc_id, part, before (ids before the document in its partition), n_tokens, ids (little-endian 16 bits), written once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end, part, before = worker_encoder(vocabulary, spaced=False, entries=room.entries), np.array([end_id], "<u2").tobytes(), TaskContext.get().partitionId(), 0
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for lo, hi in slices(texts, room.text):
                ids = [x + end for x in tok.batch(texts.slice(lo, hi - lo))]
                n = np.array([len(x) // 2 for x in ids], np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array([part] * len(n), pa.int32()), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "part", "before", "n_tokens", "ids"])

    return materialize(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, part int, before long, n_tokens long, ids binary"), "packing-ids", room.rows)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = WINDOW, room: Room = Room()) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; equal rows are packed one by one; null doc_ids stay null; an empty table gives no
    row; further columns are not read.  The driver adds up one total for each partition of the input.
    """
    ids = tokenised(docs, vocabulary, end_id, room)
    base, total = {}, 0
    for r in sorted(ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r["part"]] = total
        total += r["n"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, before, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            at = before + np.array([base[p] for p in part.tolist()], np.int64)
            first, last = at // window, (at + n - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(at[row], sequence * window)
            end = np.minimum((at + n)[row], (sequence + 1) * window)
            start, length = begin - at[row], end - begin
            crc, now, raw = [], -1, b""
            for r, s, m in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
                if r != now:
                    now, raw = r, np.frombuffer(b.column(4)[r].as_buffer(), "<u2").astype("<u4").tobytes()
                crc.append(zlib.crc32(raw[4 * s : 4 * (s + m)]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(sequence), pa.array(begin - sequence * window)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ids.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
