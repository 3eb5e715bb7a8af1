"""A training corpus from documents: five stages, each one operator of veriforge.llm.

Every stage takes (spark, docs, sf_dir).  All but the last return documents' columns, changed or filtered; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veriforge.llm import near_copies, packing, quality, secret_scan, simhash, suffix_dedup
from veriforge.llm.queries import _tokenizer
from veriforge.llm.shared import materialize, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.kept(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays: first of those whose SimHash fingerprints
    of five-word shingles link, then of those left whose sets of five-word shingles are alike to 0.8."""
    return near_copies.dedup(materialize(simhash.dedup(docs, shingle=5), "one-of-each"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that a smaller doc_id also holds are taken out; documents that this empties go."""
    return suffix_dedup.dedup(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redacted(docs, secret_scan.train(secret_scan.samples(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens.  The executors have four stages behind them, so a worker holds less than it might."""
    return packing.pack(docs, _tokenizer("word_bpe_49k.json"), end_id=1, room=packing.Room(entries=150_000, text=1 << 20, rows=1000))


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: A trained classifier and a tokenizer's ids are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read back by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
