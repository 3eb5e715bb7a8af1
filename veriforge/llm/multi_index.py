"""Approximate nearest neighbours by an inverted multi-index.

Either half of the vectors has a codebook of its own, fitted on a bounded sample; a cell is a pair of centroids.  For a query
the pairs are met in the order of their summed inner products, by a heap over the two sorted lists, until the cells met hold
enough vectors.  The vectors of these cells, and no others, are multiplied with the query; the best are scored again in a fixed
order of summation, so that equal vectors have equal scores wherever they lie.

How much is enough is measured: on a sample of queries among the sampled vectors, the share of vectors in best order that holds
RECALL of the true neighbours.  Vectors with structure need a small share; unstructured ones need a large one.

Cells are numbered so that those of like centroids in both halves lie together, and successive ones share a block of about
BLOCK vectors (a larger cell is split by a hash of its rows).  A query travels to the blocks of the cells it met, with one bit
for each of their cells, and each block gives its best there; no two vectors are ever joined as rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import giving_back, materialize

#: Vectors and queries of the sample on which codebooks and share are fitted.
SAMPLE, TRIALS = 20_000, 256
#: Vectors aimed at in a cell; the centroids of a half grow with the square root of the vectors, between these bounds.
CELL, LEAST_CENTROIDS, MOST_CENTROIDS = 12, 4, 1024
BLOCK = 4096
#: Recall that the share is measured for, and the least vectors that the cells met must hold.
RECALL, LEAST = 0.95, 2000
NEAREST, STEP = 20, 20
ROUNDS = 12
#: Centroids of the second list that the heap takes together.
TOGETHER = 4


def kmeans(x: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].astype(np.float64)
    for _ in range(ROUNDS):
        near = assign(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def assign(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest row of c for each row of x."""
    square = (c**2).sum(1)
    return np.concatenate([(square - 2 * (x[i : i + 4096] @ c.T)).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def traverse(first: np.ndarray, second: np.ndarray, held: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells (i, j) by descending first[i] + second[j], a few j at a time, until they hold enough vectors."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    key_a, key_b = first[a].tolist(), second[b].tolist()
    heap, out, total = [(-key_a[0] - key_b[0], 0, 0)], [], 0
    while heap and total < enough:
        _, i, j = heapq.heappop(heap)
        some = [c for c in b[j : j + TOGETHER] if held[a[i], c]]
        out += [(a[i], c) for c in some]
        total += int(held[a[i], some].sum())
        if j + TOGETHER < len(b):
            heapq.heappush(heap, (-key_a[i] - key_b[j + TOGETHER], i, j + TOGETHER))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-key_a[i + 1] - key_b[0], i + 1, 0))
    return out


def needed_share(x: np.ndarray, half: int, books: tuple[np.ndarray, np.ndarray], nearest: int) -> float:
    """Of the sample x, the share of vectors in the order of their cells that holds RECALL of the neighbours of TRIALS queries."""
    queries = np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int)
    cells = assign(x[:, :half], books[0]), assign(x[:, half:], books[1])
    places = []
    for q in queries.tolist():
        exact = x @ x[q]
        exact[q] = -np.inf
        order = (x[q, :half] @ books[0].T)[cells[0]] + (x[q, half:] @ books[1].T)[cells[1]]
        best = np.argpartition(-exact, min(nearest, len(x) - 1))[:nearest]
        places.append(len(x) - np.searchsorted(np.sort(order), order[best]))
    return float(np.quantile(np.concatenate(places), RECALL)) / len(x)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0")
    return e.where("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)")


class Layout:
    """Numbers of the cells, and the blocks that they lie in."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], held: np.ndarray):
        groups = max(1, round((held.sum() / BLOCK) ** 0.5))
        like = [assign(c, kmeans(c, groups)) if c.shape[1] else np.zeros(len(c), np.int64) for c in books]
        i, j = (x.ravel() for x in np.indices(held.shape))
        order = np.lexsort((j, i, like[1][j], like[0][i]))
        self.number = np.empty(held.shape, np.int64)
        self.number[i[order], j[order]] = np.arange(len(order))
        counts = held.ravel()[order]
        # cells in a row share a block while it has room; a cell beyond BLOCK has one of its own, in parts
        self.block_of, start, room = np.zeros(len(counts), np.int64), [0], BLOCK
        for c, m in enumerate(counts.tolist()):
            if m > room and room < BLOCK:
                start.append(c)
                room = BLOCK
            self.block_of[c] = len(start) - 1
            room -= m
        self.start = np.array(start)
        self.end = np.array([*start[1:], len(counts)])
        self.parts = np.maximum(1, -(-np.add.reduceat(counts, self.start) // BLOCK))


def best_in_block(y: np.ndarray, met: np.ndarray, own: np.ndarray, x: np.ndarray, cell: np.ndarray, vec: np.ndarray, row: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, entry, score) of the nearest entries of each query in the cells that it met, and the products it took.  Entries
    are sorted by cell; own is a query's own row."""
    begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    end = np.concatenate([begin[1:], [len(cell)]])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    products = 0
    for lo in range(0, len(y), 256):
        q, m = y[lo : lo + 256], met[lo : lo + 256]
        s = np.full((len(q), len(x)), -np.inf)
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            who = np.flatnonzero(m[:, cell[a]])
            if len(who):
                s[who, a:b] = q[who] @ x[a:b].T
                products += len(who) * (b - a)
        s[own[lo : lo + 256, None] == row] = -np.inf
        k = min(nearest, len(x))
        edge = np.partition(s, len(x) - k, axis=1)[:, len(x) - k]
        for i in range(len(q)):
            take = np.flatnonzero(s[i] >= edge[i] - 1e-9 * (1 + abs(edge[i])) if np.isfinite(edge[i]) else np.isfinite(s[i]))
            exact = (x[take] * q[i]).sum(1)
            order = np.lexsort((row[take], vec[take], -exact))[:nearest]
            out.append((np.full(len(order), lo + i), take[order], exact[order]))
    cat = lambda i, t: np.concatenate([o[i] for o in out]).astype(t) if out else np.zeros(0, t)
    return cat(0, np.int64), cat(1, np.int64), cat(2, np.float64), products


def search(embeddings: DataFrame, step: int = STEP, nearest: int = NEAREST, share: float | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest of the candidates found, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by step; candidates are all rows but the query's own, so rows that repeat a
    vec_id are queries and candidates of their own.  Fewer candidates than `nearest` give fewer rows; an empty table none.
    Vectors of another length than the most frequent one take no part, nor do those that `usable` leaves out; other columns
    are not read.  share: the part of all vectors that the cells met hold; measured on the sample if it is not given.
    """
    spark, good = embeddings.sparkSession, usable(embeddings)
    lengths = {r[0]: r[1] for r in good.groupBy(F.size("embedding").alias("d")).count().collect()}
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], out_schema)
    d = max(lengths, key=lambda k: (lengths[k], -k))
    good, n, half = good.where(F.size("embedding") == d), lengths[d], (d + 1) // 2
    sample = np.array([r.embedding for r in good.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE).collect()])
    k = int(np.clip(round((n / CELL) ** 0.5), LEAST_CENTROIDS, MOST_CENTROIDS))
    books = kmeans(sample[:, :half], k), kmeans(sample[:, half:], k) if half < d else np.zeros((1, 0))
    width = len(books[1])
    enough = max(LEAST, int((needed_share(sample, half, books, nearest) if share is None else share) * n), nearest + 1)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                cell = assign(x[:, :half], books[0]) * width + assign(x[:, half:], books[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32))], ["vec_id", "embedding", "cell"])

    placed = good.mapInArrow(giving_back(place), "vec_id long, embedding array<double>, cell int")
    index = materialize(placed.withColumn("own", F.monotonically_increasing_id()), "multi-index")
    held = np.zeros(len(books[0]) * width, np.int64)
    for r in index.groupBy("cell").count().collect():  # bounded: MOST_CENTROIDS ** 2
        held[r[0]] = r[1]
    held = held.reshape(-1, width)
    at = Layout(books, held)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                b = batch.slice(lo, 128)
                x = _matrix(b.column(1))
                one, two = x[:, :half] @ books[0].T, x[:, half:] @ books[1].T
                row, block, part, bits = [], [], [], []
                for i in range(len(x)):
                    met = np.zeros(at.number.size, bool)
                    met[at.number[tuple(np.array(traverse(one[i], two[i], held, enough)).T)]] = True
                    for k in np.unique(at.block_of[np.flatnonzero(met)]).tolist():
                        own = np.packbits(met[at.start[k] : at.end[k]]).tobytes()
                        for s in range(int(at.parts[k])):
                            row.append(i)
                            block.append(k)
                            part.append(s)
                            bits.append(own)
                place = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(part, pa.int32()), b.column(0).take(place), b.column(2).take(place), b.column(1).take(place), pa.array(bits, pa.binary())], ["block", "part", "query_id", "own", "query", "cells"])

    def best(queries: pa.Table, entries: pa.Table) -> pa.Table:
        if not (queries.num_rows and entries.num_rows):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())], NAMES)
        first = int(at.start[queries.column("block")[0].as_py()])
        cell = at.number.ravel()[entries.column("cell").to_numpy()] - first
        order = np.argsort(cell, kind="stable")
        vec, own = (entries.column(c).to_numpy()[order] for c in ("vec_id", "own"))
        x = _matrix(entries.column("embedding").combine_chunks())[order]
        met = np.unpackbits(np.array([np.frombuffer(c.as_py(), np.uint8) for c in queries.column("cells")]), axis=1).astype(bool)
        q_own = queries.column("own").to_numpy()
        q, e, score, _ = best_in_block(_matrix(queries.column("query").combine_chunks()), met, q_own, x, cell[order], vec, own, nearest)
        return pa.table([pa.array(q_own[q]), queries.column("query_id").combine_chunks().take(pa.array(q)), pa.array(own[e]), pa.array(vec[e]), pa.array(score)], NAMES)

    routed = index.where(F.col("vec_id") % step == 0).select("vec_id", "embedding", "own").mapInArrow(giving_back(route), "block int, part int, query_id long, own long, query array<double>, cells binary")
    numbers = spark.createDataFrame([(int(c), int(at.block_of[m]), int(at.parts[at.block_of[m]])) for c in np.flatnonzero(held.ravel()).tolist() for m in (at.number.ravel()[c],)], "cell int, block int, parts int")
    blocks = index.join(F.broadcast(numbers), "cell").withColumn("part", F.pmod(F.xxhash64("own"), "parts").cast("int"))  # bounded: a row for each cell
    found = routed.groupBy("block", "part").cogroup(blocks.groupBy("block", "part")).applyInArrow(best, "own long, query_id long, entry long, vec_id long, score double")
    by = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "entry")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


NAMES = ["own", "query_id", "entry", "vec_id", "score"]
