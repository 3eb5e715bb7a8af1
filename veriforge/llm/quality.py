"""Quality classifier from weak labels.

Nine overlapping heuristic labellers vote good (1), bad (-1) or nothing (0) on every text.  Their accuracies are not known, but their
agreements are: expectation-maximisation over the counts of all vote patterns in the corpus (3**9 at most, whatever its size)
estimates for each labeller how it votes on good and on bad texts, and the share of good ones.  The posteriors then train a
hashed linear scorer on a bounded sample; it reads character shapes, bytes and the labellers' measurements, so it also judges
texts on which no labeller votes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import apart, giving_back, together

#: Rows on which the scorer is fitted: those whose hashed doc_id is least.
TRAIN_ROWS = 3000
SHAPES, BYTES, MEASURES = 4096, 1024, 256
DIMENSIONS = SHAPES + BYTES + MEASURES
KEEP = 0.5
LABELLERS = ("symbols", "marked words", "capitals", "shouted words", "few words", "words twice", "repeated lines", "bars", "word length")
EM_ROUNDS = 100

#: Class of each byte: letters, capitals, digits, white space, line feed, and ten groups of marks by their code.
_SHAPE = bytes(1 if c >= 128 or 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 5 if c == 10 else 4 if c in (9, 11, 12, 13, 32) else 6 + c % 10 for c in range(256))

#: First bytes of characters of scripts that put no spaces between words (U+0E00 to U+0EFF and U+3000 to U+9FFF).
_FAR_EAST = tuple(bytes([b]) for b in (0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9)) + (b"\xe0\xb8", b"\xe0\xb9", b"\xe0\xba", b"\xe0\xbb")

#: A word that ends in two marks or more.
_MARKED = re.compile(r"[^\W_][!-/:-@\[-`{-~]{2,}(?!\S)")


def measured(text: str) -> list[float]:
    """Shares that the labellers look at, the number of words, and whether the script puts no spaces between them."""
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    data = text.encode()
    shape = np.bincount(np.frombuffer(data.translate(_SHAPE), np.uint8), minlength=16)
    letters = max(1, int(shape[1] + shape[2]))
    twice = sum(map(eq, words, words[1:])) + sum(map(eq, words, words[2:]))
    return [
        int(shape[6:].sum()) / max(1, len(data)),
        len(_MARKED.findall(text)) / m,
        int(shape[2]) / letters,
        sum(map(str.isupper, words)) / m,
        len(set(words)) / m,
        twice / m,
        len(set(lines)) / max(1, len(lines)),
        text.count("|") / m,
        max(0, len(text) - m) / m,
        len(words),
        data.count(b"\xe3") + sum(map(data.count, _FAR_EAST)) > len(data) // 6,
    ]


def votes(x: list[float]) -> list[int]:
    """Good unless its own defect shows; nothing where a text is too short to tell."""
    symbols, marked, capitals, shouted, distinct, twice, lines, bars, length, n, unspaced = x
    return [
        -1 if symbols > 0.12 else 1,
        0 if n < 3 else -1 if marked > 0.25 else 1,
        0 if n < 20 else -1 if capitals > 0.3 else 1,
        0 if n < 5 else -1 if shouted > 0.4 else 1,
        0 if n < 30 else -1 if distinct < 0.25 * min(1.0, (300 / n) ** 0.5) else 1,
        0 if n < 10 else -1 if twice > 0.2 else 1,
        0 if n < 30 else -1 if lines < 0.5 else 1,
        0 if n < 10 else -1 if bars > 0.25 else 1,
        0 if unspaced else -1 if length > 25 else 1,
    ]


def features(text: str, x: list[float]) -> np.ndarray:
    """Square roots of the shares of shape trigrams and hashed byte pairs, and one bit for each measurement's bin."""
    data = text.encode()
    out = np.zeros(DIMENSIONS, np.float32)
    if len(data) >= 3:
        s = np.frombuffer(data.translate(_SHAPE), np.uint8).astype(np.int32)
        out[:SHAPES] = np.bincount(s[:-2] * 256 + s[1:-1] * 16 + s[2:], minlength=SHAPES)
        b = np.frombuffer(data, np.uint8).astype(np.int64)
        pair = (b[:-1] * 256 + b[1:]) * 0x9E3779B1 >> 16 & (BYTES - 1)
        out[SHAPES : SHAPES + BYTES] = np.bincount(pair, minlength=BYTES)
        out /= len(data)
        np.sqrt(out, out)
    for i, v in enumerate(x[:10]):
        bin_ = int(min(15, 16 * v if i < 8 else 2 * np.log1p(v)))
        out[SHAPES + BYTES + 16 * i + bin_] = 1.0
    return out


def accuracies(counts: dict[tuple[int, ...], int]) -> tuple[np.ndarray, float, dict[tuple[int, ...], float]]:
    """(P(vote | class) by labeller, class and vote + 1; share of good texts; posterior of good for each pattern)."""
    patterns = np.array(sorted(counts), np.int64)
    n = np.array([counts[tuple(p)] for p in patterns.tolist()], np.float64)
    vote = patterns + 1
    cast = vote != 1  # where nothing is said, nothing is learnt
    post = np.where((patterns == -1).any(1), 0.1, 0.9)
    for _ in range(EM_ROUNDS):
        weight = np.stack([(1 - post) * n, post * n])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        table = np.stack([[[w[vote[:, j] == v].sum() + 0.5 * (v != 1) for v in range(3)] for w in weight] for j in range(vote.shape[1])])
        table[:, :, 1] = 0
        table /= table.sum(2, keepdims=True)
        log = sum(np.where(cast[:, j], np.log(table[j] + (table[j] == 0))[:, vote[:, j]], 0.0) for j in range(vote.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log((1 - prior) / prior), -50, 50)))
        settled = np.abs(new - post).max() < 1e-9
        post = new
        if settled:
            break
    return table, float(prior), {tuple(p): float(x) for p, x in zip(patterns.tolist(), post, strict=True)}


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 100, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels, with a bias as the last weight."""
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        e = ((p - y) / len(y)).astype(np.float32)
        g = decay * w
        g[-1] = e.sum()
        g[:-1] += e @ x
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


def patterns(docs: DataFrame) -> dict[tuple[int, ...], int]:
    """How many texts have each pattern of votes; all texts are counted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            seen.update(",".join(map(str, votes(measured(t.as_py() or "")))) for t in b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["votes", "n"])

    counted = docs.select("text").mapInArrow(giving_back(run), "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    return {tuple(map(int, r.votes.split(","))): r.n for r in counted.collect()}  # bounded: 3 ** labellers


def train(docs: DataFrame) -> tuple[np.ndarray, dict[tuple[int, ...], float]]:
    """(weights, posterior of each pattern).  The driver gets TRAIN_ROWS feature vectors at most."""
    counts = patterns(docs)
    if not counts:
        return np.zeros(DIMENSIONS + 1, np.float32), {}
    _, _, post = accuracies(counts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(0):
                text = t.as_py() or ""
                x = measured(text)
                rows.append((features(text, x).astype(np.float16).tobytes(), post[tuple(votes(x))]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.float64())], ["x", "y"])

    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS).select(F.col("doc_id").alias("id")).distinct()  # bounded by the limit
    sample = docs.select("text", "doc_id").join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text").mapInArrow(giving_back(run), "x binary, y double").limit(TRAIN_ROWS).collect()
    x = np.stack([np.frombuffer(r.x, np.float16) for r in sample]).astype(np.float32)
    return fit_linear(x, np.array([r.y for r in sample])), post


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, text, others (all further columns of docs), posterior, score and keep of every row."""
    weights, post = train(docs)
    w = weights.astype(np.float32)
    given = apart(docs, "doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1):
                text = t.as_py() or ""
                x = measured(text)
                out.append((post.get(tuple(votes(x)), 0.5), float(1 / (1 + np.exp(-np.clip(features(text, x) @ w[:-1] + w[-1], -50, 50))))))
            score = np.array([s for _, s in out], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([p for p, _ in out], pa.float64()), pa.array(score), pa.array(score >= KEEP)], schema.names)

    schema = StructType([*given.schema.fields]).add("posterior", "double").add("score", "double").add("keep", "boolean")
    return given.mapInArrow(giving_back(run), schema)


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, posterior (of the labellers), score (of the linear scorer) and keep (score >= KEEP) of every row.

    Null text: empty.  Empty texts are judged like any other; equal texts get equal scores; repeated rows and null doc_ids are
    judged like any other; an empty table gives no row; further columns are not read.
    """
    return _judged(docs.select("doc_id", "text")).select("doc_id", "posterior", "score", "keep")


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs that the scorer keeps; every column keeps its values, whatever its name."""
    return together(_judged(docs).where("keep"), docs.columns, ("doc_id", "text"))
