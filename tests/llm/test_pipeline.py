"""The pipeline's stages: odd rows, and planted copies, passages and secrets against a brute-force version."""

import random
import zlib

import numpy as np
import pytest
from odd_rows import WORDS, intact, prose

from veriforge.llm import quality, secret_scan, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, DIR), "test")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DIR)
    assert pieces.select("doc_id").distinct().count() == before


def test_odd_rows(spark, docs, rows, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, DIR).count() == 0
        got = corpus_pipeline.materialize(stage(spark, docs, DIR), "test")
        assert got.columns == docs.columns and intact(got.collect(), rows)


def _sets(texts):
    def of(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    return [of(t) for t in texts]


def _chosen(rows, linked):
    """Of each group the row with the least doc_id; rows are in that order."""
    kept = []
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and linked(i, j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    kept = [i for i in range(len(rows)) if find(i) == i]
    return [rows[i] for i in kept]


def test_against_brute_force(spark):
    r = random.Random(3)
    passage = prose(60)
    rows = []
    for i in range(40):
        text = " ".join(r.choice(WORDS) for _ in range(r.randint(60, 200)))
        rows.append((i, text.capitalize() + "."))
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies
    for i in range(5, 12):  # near copies
        words = rows[i][1].split()
        words[r.randrange(len(words))] = "zz"
        rows.append((200 + i, " ".join(words)))
    rows += [(300 + i, f"{prose(40)} {passage} {prose(40)}") for i in range(6)]  # a shared passage
    rows += [(400 + i, f"{prose(50)} token = Abcdef{i}23456 {prose(9)}") for i in range(3)]
    rows += [(500 + i, " ".join(w + "***" for w in prose(80).split())) for i in range(8)] + [(600, None), (601, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # 1: the classifier's own judgement of each text
    weights, _ = quality.train(docs)
    good = lambda t: quality.features(t, quality.measured(t)) @ weights[:-1] + weights[-1] >= 0
    left = [x for x in rows if good(x[1] or "")]
    assert not any(500 <= k < 600 for k, _ in left) and all(x in left for x in rows[:40])
    # 2: fingerprints of five-word shingles, then sets of them
    fp = [simhash.fingerprint(x, 5) for _, x in left]
    left = _chosen(left, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    sets = _sets([x for _, x in left])
    left = _chosen(left, lambda a, b: sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    assert not any(100 <= k < 300 for k, _ in left)
    # 3: bytes of windows that a smaller doc_id has
    first: dict[bytes, int] = {}
    for k, x in left:
        b = (x or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], k)
    cut = []
    for k, x in left:
        b = (x or "").encode()
        keep = np.ones(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                keep[i : i + 50] = False
        new = np.frombuffer(b, "u1")[keep].tobytes().decode(errors="ignore")
        if new or not x:
            cut.append((k, x if keep.all() else new))
    # 4: secrets
    llr = secret_scan.train(secret_scan.samples(spark))
    from test_operators import _all_spans, _library

    want = {}
    for k, x in cut:
        for a, _, b in reversed(_all_spans(x or "", llr)):
            x = x[:a] + "[SECRET]" + x[b:]
        want[k] = x
    assert any("[SECRET]" in (x or "") for x in want.values())
    # 5: the pieces hold the ids
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), "test")
    assert {x.doc_id: x.text for x in docs.collect()} == want
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    encode = _library("word_bpe_49k.json")
    ids = {k: np.array([*encode(x), 1], "<u4") for k, x in want.items()}
    assert all(zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces) and sum(p.length for p in pieces) == sum(map(len, ids.values()))
