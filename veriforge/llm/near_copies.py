"""Near copies that SimHash can't reach: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts at 0.8 differ in nine to ten of 64 SimHash bits, and no ball of that radius can be emitted.  So after `simhash.dedup` the
pipeline's second stage lets MinHash find candidates among what is left, and the sets themselves decide.  BANDS bands of ROWS
minima each: a pair at similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS, 0.9996 at 0.8 and over 0.999999
at 0.9.

Nodes are distinct sets, so a group of copies, however large, is one node.  In a band's bucket, sorted by size of set, each node
is paired with the WINDOW nodes before it, and every pair is verified by its exact similarity.  Of a larger bucket, all pairs
that these links left in different components follow, so that no candidate is lost.  There a bitmap of each set bounds what two
sets can have in common from above, and only pairs that can still reach the similarity have their sets compared.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components
from .grams import _mixed
from .shared import NULL_KEY, discard, giving_back, materialize, partitions, release

SHINGLE = 5
#: Similarity from which two texts are near copies, as a fraction.
LIKE = (4, 5)
BANDS, ROWS = 20, 5
WINDOW = 4
#: Bits of a set's bitmap.
BITMAP = 2048
_PART = 1 << 12
_U = np.uint64
#: Odd factors and summands of the minima's hashes, from a rule.
_FACTOR = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_PLUS = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the text's word shingles; a shorter text is one shingle, one without words none."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    n = len(words) - SHINGLE + 1
    parts = (b" ".join(words[i : i + SHINGLE]) for i in range(n)) if n > 0 else [b" ".join(words)] * bool(words)
    return np.unique(np.fromiter((xxh64_intdigest(p, 42) for p in parts), _U))


def bands(of: np.ndarray) -> np.ndarray:
    """One hash for each band of a set's minima."""
    least = np.full(BANDS * ROWS, ~_U(0))
    for i in range(0, len(of), _PART):
        # high bits of a product depend on all lower ones; the low ones alone do not
        x = of[i : i + _PART, None] * _FACTOR + _PLUS
        least = np.minimum(least, ((x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)).min(0))
    out = np.arange(1, BANDS + 1, dtype=_U)
    for row in least.reshape(BANDS, ROWS).T:
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + row)
    return out


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of LIKE or more, in whole numbers."""
    both = len(a) + len(b)
    common = both - len(np.union1d(a, b))
    return LIKE[1] * common >= LIKE[0] * (both - common)


def bitmap(of: np.ndarray) -> np.ndarray:
    """One bit for each place that a member hashes to, as 64-bit words."""
    on = np.zeros(BITMAP, np.uint8)
    on[(of % _U(BITMAP)).astype(np.int64)] = 1
    return np.packbits(on).view(np.uint64)


def may_be_alike(n: int, bits: np.ndarray, others: np.ndarray, their_bits: np.ndarray) -> np.ndarray:
    """Which of other sets (sizes, rows of bitmaps) can be alike: a bit that only one set has stands for a member or more that
    the other lacks."""
    ours = n - np.bitwise_count(bits & ~their_bits).sum(1, dtype=np.int64)
    theirs = others - np.bitwise_count(their_bits & ~bits).sum(1, dtype=np.int64)
    common = np.minimum(ours, theirs)
    return LIKE[1] * common >= LIKE[0] * (n + others - common)


def _node(of: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(of.tobytes(), 42)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            b = batch.slice(lo, 1024)
            node, size, keys, bits = np.zeros(b.num_rows, _U), np.zeros(b.num_rows, np.int32), np.zeros((b.num_rows, BANDS), _U), []
            for i, t in enumerate(b.column(1)):
                of = shingles(t.as_py())
                node[i], size[i], keys[i] = _node(of), len(of), bands(of)
                bits.append(bitmap(of).tobytes())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * BANDS, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node.view(np.int64)), pa.array(size), lists, pa.array(bits, pa.binary())], ["doc_id", "node", "n", "bands", "bits"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            of = [shingles(t.as_py()) for t in batch.slice(lo, 1024).column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([_node(x) for x in of], _U).view(np.int64)), pa.array([x.tobytes() for x in of], pa.binary())], ["node", "shingles"])


def _pairs(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, n, node) to pairs of nodes of one bucket whose sizes allow LIKE, `window` places apart at most."""
    now, held = None, deque(maxlen=window)
    for b in batches:
        out_a, out_b = [], []
        for key, n, node in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if key != now:
                now = key
                held.clear()
            for m, other in held:
                if LIKE[1] * m >= LIKE[0] * n:
                    out_a.append(max(node, other))
                    out_b.append(min(node, other))
            held.append((n, node))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["hi", "lo"])


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, n, node, root, bits) sorted by key to all pairs of one bucket with different roots that may be alike."""
    now: int | None = None
    m, size, nodes, roots, bits = 0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BITMAP // 64), _U)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            b = batch.slice(lo, 4096)
            out: list[np.ndarray] = []
            for key, n, node, root, own in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4), strict=True):
                if key != now:
                    now, m = key, 0
                own = np.frombuffer(own.as_buffer(), _U)
                other = np.flatnonzero(roots[:m] != root)
                if len(other) and len(other := other[may_be_alike(n, own, size[other], bits[other])]):
                    out.append(np.stack([np.full(len(other), node), nodes[other]]))
                if m == len(size):
                    size, nodes, roots, bits = (np.resize(x, (max(64, 2 * m), *x.shape[1:])) for x in (size, nodes, roots, bits))
                size[m], nodes[m], roots[m], bits[m] = n, node, root, own
                m += 1
            pairs = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.max(0)), pa.array(pairs.min(0))], ["hi", "lo"])


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        near = [alike(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)) for x, y in zip(b.column(2), b.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["hi", "lo"]).filter(pa.array(near, pa.bool_()))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are alike."""
    fetched = pairs.join(sets.select(F.col("node").alias("hi"), F.col("shingles").alias("x")), "hi").join(sets.select(F.col("node").alias("lo"), F.col("shingles").alias("y")), "lo").select("hi", "lo", "x", "y")
    links = materialize(fetched.mapInArrow(giving_back(_verified), "hi long, lo long"), "near-links")
    release(pairs.sparkSession)
    return links


def _sets_of(docs: DataFrame, rows: DataFrame, met: DataFrame) -> DataFrame:
    """Sets of the candidates, made again from the texts of one document each; a doc_id of several rows brings all of its nodes."""
    wanted = met.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    named = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(NULL_KEY))).alias("key")).select("key").distinct()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"), "text").join(named, "key", "left_semi").select("key", "text")
    sets = materialize(texts.mapInArrow(giving_back(_sets), "node long, shingles binary").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "near-sets")
    release(docs.sparkSession)
    return sets


def _grouped(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, root) of the connected nodes.

    Texts with equal sets are one node; null texts and texts without words are equal.  Of each node one pair is verified first;
    of the others only those whose nodes these did not connect, as the rest can't change a component."""
    spark = docs.sparkSession
    rows = materialize(docs.select("doc_id", "text").mapInArrow(giving_back(_signed), "doc_id long, node long, n int, bands array<long>, bits binary"), "near-nodes")
    each = rows.where("n > 0").groupBy("node", "n").agg(F.first("bands").alias("bands"))
    emitted = each.select(F.explode("bands").alias("key"), "n", "node")
    parts = 2 * partitions(spark)
    met = emitted.repartition(parts, "key").sortWithinPartitions("key", "n", "node").mapInArrow(giving_back(lambda it: _pairs(it, window)), "hi long, lo long")
    met = materialize(met.distinct(), "near-pairs")
    release(spark)
    sets = _sets_of(docs, rows, met)
    links = _linked(met.groupBy("hi").agg(F.max("lo").alias("lo")), sets)
    root = components.roots(links)

    def apart(pairs: DataFrame) -> DataFrame:
        side = lambda x: root.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
        return materialize(pairs.join(side("hi"), "hi", "left").join(side("lo"), "lo", "left").where("coalesce(hi_root, hi) <> coalesce(lo_root, lo)").select("hi", "lo"), "near-apart")

    links = links.union(_linked(rest := apart(met), sets))
    discard(rest, sets)
    root = components.roots(links)
    large = emitted.groupBy("key").agg(F.count("*").alias("in")).where(F.col("in") > window + 1).select("key")
    members = emitted.join(large, "key", "left_semi").join(root, "node", "left").select("key", "n", "node", F.coalesce("root", "node").alias("root"))
    split = members.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    members = members.join(split, "key", "left_semi")
    bits = rows.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("bits").alias("bits"))
    rest = materialize(members.join(bits, "node").select("key", "n", "node", "root", "bits").repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(giving_back(_across), "hi long, lo long").distinct().join(met, ["hi", "lo"], "left_anti"), "near-large")
    if not rest.isEmpty():
        sets = _sets_of(docs, rows, rest)
        links = links.union(_linked(rest, sets))
        discard(sets)
        root = components.roots(links)
    discard(rest, met)
    return rows.select("doc_id", "node"), root


def clusters(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and component_id, the smallest doc_id of its component (null if it has none), of every row."""
    rows, root = _grouped(docs, window)
    labelled = rows.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return labelled.join(labelled.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs, one row of each component, as `components.one_of_each` chooses it; every column keeps its values.  An empty table
    stays empty."""
    rows, root = _grouped(docs, window)
    return components.one_of_each(docs, rows, root, lambda text: int(np.uint64(_node(shingles(text))).view(np.int64)))
