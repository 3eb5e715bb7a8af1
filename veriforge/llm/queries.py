"""The operators' registered queries, on whole tables with production parameters, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, multi_index, packing, quality, rans, secret_scan, simhash, suffix_dedup, toxicity, winnowing
from .shared import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summary(table(spark, sf_dir, "documents"), secret_scan.train(secret_scan.samples(spark)))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.summary(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.clusters(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_winnowing, op2_secret_scan, op3_packing, op4_byte_bpe, op5_toxicity, op6_multi_index, op7_suffix_dedup, op8_simhash, op9_quality, op10_token_files)}

#: Those whose whole rows SQL can express: brute force over all pairs, and over all windows as hexadecimal digits.
ORACLES: dict[str, str] = {
    "op6_multi_index": """WITH e AS (SELECT row_number() OVER () AS own, vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        g AS (SELECT * FROM e WHERE len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(x, lambda v: v <> 0)) > 0),
        s AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score FROM g q JOIN g c ON q.vec_id % 20 = 0 AND q.own <> c.own),
        r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op7_suffix_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM d)),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM w) WHERE first < doc_id),
        b AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM r),
        n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (pos <> before + 1) AS n_spans FROM (SELECT doc_id, pos, lag(pos, 1, -9) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM b) GROUP BY doc_id),
        k AS (SELECT p.doc_id, string_agg(substr(h, 2 * p.pos + 1, 2), '' ORDER BY p.pos) AS kept FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS pos FROM d) p ANTI JOIN b ON p.doc_id = b.doc_id AND p.pos = b.pos GROUP BY p.doc_id)
        SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN k ON d.doc_id = k.doc_id""",
}
