"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learnt, too: words that stand in far more toxic than other training texts.  Features are its density, plain and
after undoing look-alike characters (the difference is the obfuscation rate), how often second-person words stand near it, and
the shares of capitals, punctuation and digits.  Labels come only from training rows, and a bounded number of them: the
TRAIN_ROWS training rows whose hashed doc_id is least.  One in five of those calibrates; the lexicon and the trees see the others
alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
LEXICON = 300
#: A word must stand in so many toxic training texts and in such a share of them, and be so much likelier there (log of the ratio of shares).
LEAST_TEXTS, LEAST_SHARE, LEAST_LOG_RATIO = 4, 0.015, 1.5
NEAR = 3
ROUNDS, DEPTH, RATE, BINS, LEAST_LEAF = 80, 3, 0.15, 32, 10.0

#: Second-person words of the corpus' languages, and look-alike characters.
YOU = frozenset("you your yours yourself tu te toi vous votre vos du dich dir dein deine ihr euch usted ustedes ti tus sus".split())
LOOK_ALIKE = str.maketrans("01345789@$!|", "oieastbgasil")
_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"(?=\S*[a-z])[a-z0-9@$!|*._-]*[0-9@$!|*_][a-z0-9@$!|*_.-]*")
_SQUEEZE = str.maketrans("", "", "*._-")


def held_out(doc_id: int | None) -> bool:
    """crc32 of the doc_id as text (null: empty) leaves 0 when divided by 5."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def plain_words(low: str) -> list[str]:
    return _WORD.findall(low)


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    low = text.lower()
    words = plain_words(low)
    n, chars = max(1, len(words)), max(1, len(text))
    at = [i for i, w in enumerate(words) if w in lexicon] if not lexicon.keys().isdisjoint(words) else []
    found = [words[i] for i in at]
    hidden = []
    for m in _MIXED.findall(low):
        w = m.strip("!|.-").translate(LOOK_ALIKE)
        if w in lexicon or (w := w.translate(_SQUEEZE)) in lexicon:
            hidden.append(w)
    hidden = list((Counter(hidden) - Counter(found)).elements())
    every = found + hidden
    weight = [lexicon[w] for w in every]
    near = sum(1 for i in at if not YOU.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]))
    data = text.encode()
    shape = np.bincount(np.frombuffer(data.translate(_KIND), np.uint8), minlength=5)
    return [len(every), len(every) / n, sum(weight), max(weight, default=0.0), len(set(every)), near, near / max(1, len(at)), len(hidden) / n, float(len(hidden)), int(shape[1]) / max(1, int(shape[0] + shape[1])), int(shape[2]) / chars, int(shape[3]) / chars, int(shape[4]) / chars, math.log1p(n)]


#: Class of each byte: letters 0, capitals 1, other punctuation 2, digits 3, exclamation and question marks 4, white space 5.
_KIND = bytes(4 if c in b"!?" else 1 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 0 if c >= 128 or 97 <= c <= 122 else 5 if c <= 32 else 2 for c in range(256))


class Trees:
    """Boosted regression trees on binned features, for the logistic loss."""

    def __init__(self) -> None:
        self.edges: list[np.ndarray] = []
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, d = x.shape
        self.edges = [np.unique(np.concatenate([np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1]), np.unique(x[:, j])[1:4]]))[: BINS - 1] for j in range(d)]
        b = self.binned(x)
        p0 = (y.sum() + 1) / (n + 2)
        self.base = math.log(p0 / (1 - p0))
        f = np.full(n, self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            size = 2 ** (DEPTH + 1) - 1
            which, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            node = np.zeros(n, np.int64)
            for level in range(DEPTH):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for j in range(d):
                    key = (node - first) * BINS + b[:, j]
                    live = node >= first
                    hg = np.bincount(key[live], g[live], count * BINS).reshape(count, BINS).cumsum(1)
                    hh = np.bincount(key[live], h[live], count * BINS).reshape(count, BINS).cumsum(1)
                    gt, ht = hg[:, -1:], hh[:, -1:]
                    gain = hg**2 / (hh + 1) + (gt - hg) ** 2 / (ht - hh + 1) - gt**2 / (ht + 1)
                    hn = np.bincount(key[live], minlength=count * BINS).reshape(count, BINS).cumsum(1)
                    gain[(hn < LEAST_LEAF) | (hn[:, -1:] - hn < LEAST_LEAF)] = 0
                    top = gain.argmax(1)
                    score = gain[np.arange(count), top]
                    better = score > best
                    best[better] = score[better]
                    which[first : first + count][better] = j
                    cut[first : first + count][better] = top[better]
                split = (node >= first) & (which[np.maximum(node, 0)] >= 0)
                rows = np.flatnonzero(split)
                at = node[rows]
                node[rows] = 2 * at + 1 + (b[rows, which[at]] > cut[at])
            hg, hh = np.bincount(node, g, size), np.bincount(node, h, size)
            value = RATE * hg / (hh + 1)
            self.nodes.append((which, cut, value))
            f += value[node]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, f = self.binned(x), np.full(len(x), self.base)
        for which, cut, value in self.nodes:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                w = which[node]
                go = w >= 0
                node = np.where(go, 2 * node + 1 + (b[np.arange(len(x)), np.maximum(w, 0)] > cut[node]), node)
            f += value[node]
        return f


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (knots, values), non-decreasing."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, count, least x, largest x
    for xi, yi in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([yi, 1.0, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += c
            blocks[-1][3] = hi
    knots = np.array([v for b in blocks for v in (b[2], b[3])])
    values = np.array([(b[0] + 0.5 * p) / (b[1] + p) for b in blocks for p in (0.02, 0.02)])
    return knots, values


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Trees | None, knots: np.ndarray, values: np.ndarray):
        self.lexicon, self.trees, self.knots, self.values = lexicon, trees, knots, values

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.zeros(len(texts))
        raw = self.trees.raw(np.array([features(t, self.lexicon) for t in texts]))
        return np.clip(np.interp(raw, self.knots, self.values), 0, 1)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """The model.  Of documents only the rows with a chosen label are read further; the driver gets the lexicon's word counts
    (words in LEAST_TEXTS toxic texts or more) and at most `rows` feature vectors."""
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast
    # of several rows with one doc_id the least text trains, so the sample is bounded, too
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic"))
    calibrates = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        total = [0, 0]
        for b in batches:
            for t, y in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                seen[y == 1].update(set(plain_words((t.as_py() or "").lower())))
                total[y == 1] += 1
        words = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array([*words, ""], pa.string()), pa.array([*(seen[1][w] for w in words), total[1]], pa.int64()), pa.array([*(seen[0][w] for w in words), total[0]], pa.int64())], ["word", "bad", "good"])

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py() or "", lexicon) for t in b.column(1)]).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2).cast(pa.int64()), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "toxic", "x"])

    # every word of a partition is sent, also those of good texts alone: another partition's toxic texts may hold it
    def counted(of: DataFrame) -> tuple[dict[str, tuple[int, int]], int, int]:
        each = of.mapInArrow(count, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        found = {r.word: (r.bad, r.good) for r in each.where(f"word = '' OR bad >= {LEAST_TEXTS}").collect()}
        return found, *found.pop("", (0, 0))

    counts, bad, good = counted(sample.where(~calibrates))
    if not (bad and good):  # so few labels that none can be set aside
        counts, bad, good = counted(sample)
    ratio = {w: math.log((b + 0.5) / (bad + 1)) - math.log((g + 0.5) / (good + 1)) for w, (b, g) in counts.items() if len(w) > 2 and b >= LEAST_SHARE * bad}
    best = sorted((w for w in ratio if ratio[w] >= LEAST_LOG_RATIO), key=lambda w: (-ratio[w] * math.sqrt(counts[w][0]), w))[:LEXICON]
    lexicon = {w: ratio[w] for w in best}
    got = sample.mapInArrow(rest, "doc_id long, toxic long, x binary").collect()
    got = sorted(got, key=lambda r: (r.doc_id, r.toxic, bytes(r.x)))
    y = np.array([r.toxic == 1 for r in got], float)
    if not len(got) or y.min() == y.max():
        return Model(lexicon, None, np.zeros(1), np.zeros(1))
    x = np.stack([np.frombuffer(r.x) for r in got])
    aside = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in got])
    if aside.all() or not aside.any() or y[aside].min() == y[aside].max() or y[~aside].min() == y[~aside].max():
        aside = np.zeros(len(y), bool)
    trees = Trees().fit(x[~aside], y[~aside])
    part = aside if aside.any() else ~aside
    return Model(lexicon, trees, *isotonic(trees.raw(x[part]), y[part]))


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every text.

    Null text: empty, scored like any other.  Equal texts get equal scores.  Without labels of both kinds all scores are 0.  A
    doc_id with several labels counts as toxic if one of them says so; an empty table gives no row; further columns are not read.
    """
    model = train(docs, labels, rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores([t.as_py() or "" for t in b.column(1)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([held_out(k) for k in b.column(0).to_pylist()], pa.bool_()), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
