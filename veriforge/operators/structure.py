"""Blocks and reference lists over tables of documents, and over tables of blocks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import document as D
from ..functions import numbers as N
from ..functions import text as T

BLOCK = "struct<kind:string,text:string,section:string,style:string,cells:array<array<string>>>"
_CELLS = pa.list_(pa.list_(pa.string()))
_BLOCK = pa.struct([*((c, pa.string()) for c in ("kind", "text", "section", "style")), ("cells", _CELLS)])

#: Markdown text to an array of blocks, without any shuffle.
blocks = N.over(lambda t: [b._asdict() for b in D.markdown_blocks(t)], f"array<{BLOCK}>", pa.list_(_BLOCK))
_TYPESET = pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("path", pa.string()), ("numbered", pa.bool_()), ("items", pa.list_(pa.string())), ("cells", _CELLS)])
#: Markdown text with front matter to struct(fields, blocks).
front_matter = N.over(
    lambda t: dict(zip(("fields", "blocks"), (lambda f: (list(f[0].items()), f[1]))(D.front_matter(t)), strict=True)),
    "struct<fields:map<string,string>,blocks:array<struct<kind:string,level:int,text:string,path:string,numbered:boolean,items:array<string>,cells:array<array<string>>>>>",
    pa.struct([("fields", pa.map_(pa.string(), pa.string())), ("blocks", pa.list_(_TYPESET))]),
)


def made(given: list[dict] | None) -> list[D.Block]:
    """Blocks of a column's value."""
    return [D.Block(b["kind"], b["text"] or "", b["section"] or "", b["style"], b["cells"] or ([] if b["kind"] == "table" else None)) for b in given or []]


in_references = N.over(lambda b: D.in_references(made(b)), "array<boolean>", pa.list_(pa.bool_()))
#: The document as text that `blocks` reads back.
dump = N.over(lambda b: D.dump(made(b)), "string", pa.string())


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if it has fewer: reading a document costs far more than moving it, and a
    small file, or a shuffle that was coalesced by its bytes, would keep one core busy.  A large table stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def plain_text(b: Column) -> Column:
    """Texts of all blocks, a line each."""
    return F.array_join(F.transform(b, lambda x: x["text"]), "\n")


def exploded(docs: DataFrame, b: Column, *keys: str) -> DataFrame:
    """keys, block_idx, kind, text, section, style, cells."""
    return docs.select(*keys, F.posexplode(b).alias("block_idx", "b")).select(*keys, "block_idx", "b.*")


def markdown_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, block_idx, kind (heading, paragraph, table), text, section, style, cells of every Markdown text."""
    return exploded(docs, blocks(F.col(text)), key)


def with_references(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """blocks, one a row, with in_refs: the same as `in_references`, for documents too large to be one value.

    The list opens at its heading and ends at a heading, a table or the first paragraph that neither looks like an entry nor is
    followed, within two paragraphs, by one; so it is a matter of windows over the block order, in one shuffle.
    """
    order = Window.partitionBy(key).orderBy("block_idx")
    par, text = F.col("kind") == "paragraph", F.col("text")
    signs = {"looks": N.looks_like_reference, "entry": N.opens_entry, "closes": N.closes_references, "note": N.opens_note, "refs": N.is_references_heading}
    b = blocks.select("*", *(f(text).alias(f"_{n}") for n, f in signs.items()))
    next_is = lambda n, c: F.coalesce(F.lead(c, n).over(order), F.lit(False))
    goes_on = (next_is(1, par) & next_is(1, F.col("_entry"))) | (next_is(1, par) & next_is(2, par) & next_is(2, F.col("_entry")))
    b = b.withColumn("_stops", par & ~F.col("_looks") & (F.col("_closes") | ~goes_on)).withColumn("_segment", F.sum((~par).cast("int")).over(order))
    inside = Window.partitionBy(key, "_segment").orderBy("block_idx")
    opens = F.first((F.col("kind") == "heading") & F.col("_refs")).over(inside)
    seen = F.sum((par & F.col("_looks")).cast("int")).over(inside)
    b = b.withColumn("in_refs", par & opens & ~F.max("_stops").over(inside) & (F.col("_looks") | ((seen > 0) & ~F.col("_note"))))
    return b.select(*blocks.columns, "in_refs")


def captions(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tables with the label and caption before them, else in the block after."""
    order = Window.partitionBy(key).orderBy("block_idx")
    label = F.when(F.col("kind") == "paragraph", F.nullif(T.table_label(F.col("text")), F.lit("")))
    group = F.sum(F.when(F.col("kind") == "table", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    b = blocks.withColumn("label", label).withColumn("g", F.coalesce(group, F.lit(0))).withColumn("following", F.lead(label).over(order)).withColumn("following_text", F.lead("text").over(order))
    own = Window.partitionBy(key, "g").orderBy("block_idx")
    b = b.withColumn("l", F.last("label", True).over(own)).withColumn("c", F.last(F.when(F.col("label").isNotNull(), F.col("text")), True).over(own))
    return b.where("kind = 'table'").select(key, "block_idx", F.coalesce("l", "following").alias("label"), F.coalesce("c", F.when(F.col("following").isNotNull(), F.col("following_text"))).alias("caption"), T.filled_rows(F.col("cells")).alias("n_rows"), F.array_max(F.transform("cells", F.size)).alias("n_cols"), "cells")


def item_ids(items: DataFrame, prefix: Column, order: list[str], by: list[str], width: int = 4) -> DataFrame:
    """items with id prefix-kind-0001 in the given order within by."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return items.withColumn("id", F.concat_ws("-", prefix, F.lpad(n.cast("string"), width, "0")))
