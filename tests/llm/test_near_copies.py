"""Near copies of the pipeline's second stage against all pairs compared by brute force."""

import random

import pyarrow as pa
import pytest

from veriforge.llm import near_copies

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _jaccard(x, y):
    def of(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    a, b = of(x), of(y)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_copies_go(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 9))) for _ in range(500)]
    texts = []
    for _ in range(60):
        base = [r.choice(words) for _ in range(r.randint(40, 400))]
        texts.append(" ".join(base))
        for share in (0.004, 0.01, 0.02, 0.03):  # edits that leave similarities from 0.98 to 0.7
            texts.append(" ".join(r.choice(words) if r.random() < share else w for w in base))
    texts += ["", None, "one two", "One  two", "one two three", texts[0].upper()]
    rows = [(i, x, "more") for i, x in enumerate(texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(texts):
        for j in range(i):
            if _jaccard(x, texts[j]) >= 0.8 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = sorted({find(i) for i in range(len(texts))})
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(3)
    got = corpus_pipeline.one_of_each(spark, docs, "")
    assert got.columns == docs.columns and sorted(x.doc_id for x in got.collect()) == want
    assert near_copies.dedup(docs.limit(0)).count() == 0


def test_few_pairs_of_a_large_group_are_made_and_no_link_is_lost(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join(base[:k] + [f"x{i}"] + base[k + 1 :]) for i in range(150) for k in [r.randrange(300)]]
    texts += [" ".join(f"y{r.randrange(10**6)}" for _ in range(100)) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = [pa.RecordBatch.from_pydict({"key": [7] * 150, "n": [296] * 150, "node": list(range(150))})]
    assert sum(b.num_rows for b in near_copies._pairs(rows, near_copies.WINDOW)) <= 4 * 150
    found = [sorted(tuple(x) for x in near_copies.clusters(docs, w).collect()) for w in (near_copies.WINDOW, 16)]
    assert found[0] == found[1] == [(i, 0 if i < 150 else i) for i in range(160)]
