"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance 3 or less meet at a point half way.  As 3 is odd, half of it is one flip on either side and one
bit over; that bit is taken by leaving out one of four 16-bit quarters at a time.  So every distinct fingerprint emits, for
each quarter left out, the ball of radius 1 around its other 48 bits: 4 * 49 = 196 variants.

    distance 3: leave out a quarter that holds a differing bit; two or fewer differ in the rest; both balls hold the middle
    distance 2 or less: any quarter

Variants are shuffled, and fingerprints that meet are verified by their full distance.  In a bucket only a spanning forest of
its verified links is emitted, never all pairs.  A bucket of more than BUCKET fingerprints is not compared at all: its members
go through the plain ball hashing of radius (1, 2), whose buckets need no comparison (see `hot_links`).  No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components
from .shared import discard, giving_back, materialize, partitions

SHINGLE = 3
RADIUS = 3
BUCKET = 2048
_PART = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits of the XXH64 hashes (seed 42) of the text's word shingles, as an unsigned integer."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests, n = [xxh64_digest(joined, 42)], 1
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        n = len(words) - shingle + 1
        digests = [xxh64_digest(joined[a:b], 42) for a, b in zip((ends - size)[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _PART):
        part = np.frombuffer(b"".join(digests[i : i + _PART]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every text; fp holds the 64 bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants() -> list[tuple[int, int]]:
    """(mask, flip) of the 196 variants: variant = (fp & mask) ^ flip.  The flip also sets a mark in the quarter left out."""
    out = []
    for q in range(4):
        gone = 0xFFFF << (16 * q)
        mark = (q + 1) << (16 * q)
        flips = [0] + [1 << b for b in range(64) if not gone >> b & 1]
        out += [(_signed(~gone & (1 << 64) - 1), _signed(f | mark)) for f in flips]
    return out


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints: breadth first from each component's first member."""
    left, edges = fps, []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for f in front:
                new = (popcount(left ^ f) <= RADIUS) & ~reached
                edges += [(int(f), int(x)) for x in left[new]]
                reached |= new
            front, left = left[reached], left[~reached]
    return edges


def _meet(batches: Iterable[pa.RecordBatch], bucket: int = BUCKET) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, fp) to links (a, b), and (a, null) for each member of a bucket that is too large to compare."""

    def out(a: np.ndarray | list, b: np.ndarray | list, hot: np.ndarray | list) -> pa.RecordBatch:
        a, b, hot = (np.asarray(x, np.int64) for x in (a, b, hot))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, hot])), pa.array(np.concatenate([b, hot]), mask=np.arange(len(a) + len(hot)) >= len(a))], ["a", "b"])

    def groups(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        begin, size = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(key)]]))
        two = begin[size == 2]
        x, y = fp[two], fp[two + 1]
        near = popcount(x ^ y) <= RADIUS
        pairs: list[tuple[int, int]] = []
        hot = [np.zeros(0, np.int64)]
        for b, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            if n > bucket:
                hot.append(fp[b : b + n])
            else:
                pairs += forest(fp[b : b + n])
        more = np.array(pairs, np.int64).reshape(-1, 2)  # a list would make floats of all
        yield out(np.concatenate([x[near], more[:, 0]]), np.concatenate([y[near], more[:, 1]]), np.concatenate(hot))

    held_k, held_f, large = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        key = np.concatenate([held_k, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([held_f, batch.column(1).to_numpy(zero_copy_only=False)])
        if large is not None and len(key):  # of a bucket known to be too large, nothing is held
            n = int(np.argmax(key != large)) if (key != large).any() else len(key)
            yield out([], [], fp[:n])
            key, fp = key[n:], fp[n:]
            large = large if not len(key) else None
        if not len(key):
            held_k, held_f = key, fp
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield from groups(key[:last], fp[:last])
        held_k, held_f = key[last:], fp[last:]
        if len(held_k) > bucket:
            large = int(held_k[0])
            yield out([], [], held_f)
            held_k, held_f = held_k[:0], held_f[:0]
    if len(held_k):
        yield from groups(held_k, held_f)


def hot_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever is connected at distance 3 or less among fps(fp), without comparing any two.

    Keys are points of even parity.  A fingerprint of odd parity emits the 64 points at distance 1, one of even parity itself
    and the 2016 points at distance 2.  Around a key, odd members are within 2 of each other and within 3 of every even one,
    and the key itself is within 2 of every even member.  So a bucket with an odd member, or with its own key as a member, is
    connected, and all of it is linked to that member; one with neither yields nothing, as its even members at distance 2 meet
    again in each other's own bucket.  Every pair at distance 3 or less does meet in one that is linked.
    """
    one = ",".join(f"{_signed(1 << i)}L" for i in range(64)).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    odd = F.expr("bit_count(fp) % 2 = 1")
    flips = F.expr(f"IF(bit_count(fp) % 2 = 1, array({one}), concat(array(0L), flatten(transform(array({one}), (x, i) -> transform(slice(array({one}), 1, i), y -> x ^ y)))))")
    members = fps.select("fp", odd.alias("odd"), F.explode(flips).alias("flip")).select("fp", "odd", F.expr("fp ^ flip").alias("key"))
    centre = members.groupBy("key").agg(F.coalesce(F.min(F.when(F.col("odd"), F.col("fp"))), F.max(F.when(F.col("fp") == F.col("key"), F.col("fp")))).alias("centre"), F.count("*").alias("n")).where("n > 1 AND centre IS NOT NULL")
    return members.join(centre, "key").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(hi, lo): edges that connect exactly what is connected by distances of RADIUS or less among the distinct fps(fp)."""
    table = ",".join(f"struct({m}L AS m, {f}L AS f)" for m, f in variants())
    emitted = fps.select("fp", F.explode(F.expr(f"array({table})")).alias("v")).select(F.expr("(fp & v.m) ^ v.f").alias("key"), "fp")
    met = emitted.repartition(2 * partitions(fps.sparkSession), "key").sortWithinPartitions("key", "fp").mapInArrow(giving_back(lambda it: _meet(it, bucket)), "a long, b long")
    met = materialize(met.distinct(), "simhash-met")
    found = met.where("b IS NOT NULL")
    hot = met.where("b IS NULL").select(F.col("a").alias("fp"))
    if not hot.isEmpty():
        found = found.union(hot_links(hot))
    return found.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _grouped(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, fp) of every row, (fp, least) of each fingerprint, and (node, root) of the connected ones."""
    rows = materialize(fingerprints(docs, shingle), "simhash")
    each = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    return rows, each, components.roots(links(each.select("fp")))


def clusters(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id of every row.

    Null and texts without words have fingerprint 0 and are linked like any other.  Equal texts have equal fingerprints and so
    meet before any variant is made: a group of copies, however large, is one fingerprint.  component_id is the smallest
    doc_id of the component, null if it has none; repeated rows give repeated results; an empty table gives none; further
    columns are not read.
    """
    rows, each, root = _grouped(docs, shingle)
    labelled = each.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    label = labelled.join(smallest, "root").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs, one row of each component, as `components.one_of_each` chooses it; every column keeps its values."""
    rows, each, root = _grouped(docs, shingle)
    discard(each)
    return components.one_of_each(docs, rows.withColumnRenamed("fp", "node"), root, lambda text: _signed(fingerprint(text, shingle)))
