"""Connected components of a graph given as edges, without ever holding a component in one place."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import apart, discard, giving_back, materialize, together

#: Rounds double the distance that labels travel; 60 would need more nodes than a long can number.
MAX_ROUNDS = 60


def _to_least(edges: DataFrame) -> DataFrame:
    """Every edge (hi, lo) of a node with several smaller neighbours is moved to the least of them; the others hang on that, too."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    both = edges.join(least, "hi")
    return both.select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi > lo").distinct()


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are hung on the least of its neighbours and itself."""
    sides = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return sides.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(hi, lo), hi > lo; root is the least node of the component, for root itself too.

    Each round aggregates and joins by key only: a node with very many edges costs a partial minimum and a join that Spark
    can split, never one task.  Rounds grow with the logarithm of the longest path.  Every round is written to the shared
    folder, so neither plan nor lineage grows.
    """
    edges = materialize(edges.distinct(), "edges")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        after = materialize(_to_least(_larger_to_least(edges)), "edges")
        new = _mark(after)
        discard(edges)
        edges = after
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def one_of_each(docs: DataFrame, rows: DataFrame, root: DataFrame, node_of: Callable[[str | None], int]) -> DataFrame:
    """docs, one row of each component: the one with the smallest doc_id (null: largest), of equal ones the least text.

    rows(doc_id, node) has every row's node, root(node, root) the components of more than one node.  Rows are told apart by
    doc_id; only those whose doc_id is null or repeated have their nodes made again from their texts.
    """
    own = ("doc_id", "text")
    labelled = rows.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = labelled.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best")).select("best.doc_id", "best.node")
    several = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id")
    single = docs.join(best.join(several, "doc_id", "left_anti").where("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    if several.isEmpty():
        return single

    def noded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([node_of(t.as_py()) for t in b.column(1)], pa.int64())], [*b.schema.names, "node"])

    given = apart(docs, *own)
    rest = given.join(several.where("doc_id IS NOT NULL"), "doc_id", "left_semi").union(given.where("doc_id IS NULL"))
    rest = rest.mapInArrow(giving_back(noded), StructType([*rest.schema.fields]).add("node", "long"))
    wanted = best.select(F.col("doc_id").alias("id"), F.col("node").alias("of"))
    chosen = rest.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("node") == F.col("of")), "left_semi")
    # of rows with one doc_id and node the least text, by a partial aggregation
    chosen = chosen.groupBy("doc_id", "node").agg(F.min_by(F.struct("text", "others"), F.coalesce("text", F.lit(""))).alias("row")).select("doc_id", "row.text", "row.others")
    return single.select(*docs.columns).union(together(chosen, docs.columns, own))
