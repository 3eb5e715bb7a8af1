"""Deck timing and lint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grammar as G
from ..functions import vocabulary as V


def default_seconds(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in V.SECONDS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, kind), F.lit(V.OTHER_SECONDS))


def timed(slides: DataFrame, deck: str, slide: str) -> DataFrame:
    """slides(type, seconds, annex) with in_annex, own_seconds and the running total of the deck."""
    so_far = Window.partitionBy(deck).orderBy(slide).rowsBetween(Window.unboundedPreceding, 0)
    annex = F.max((F.col("type") == "annex_marker") | F.coalesce("annex", F.lit(False))).over(so_far) if "annex" in slides.columns else F.max(F.col("type") == "annex_marker").over(so_far)
    t = slides.withColumn("in_annex", annex)
    t = t.withColumn("own_seconds", F.when(F.col("in_annex"), 0).otherwise(F.coalesce("seconds", default_seconds(F.col("type")))).cast("long"))
    return t.withColumn("running", F.sum("own_seconds").over(so_far))


def totals(timed_slides: DataFrame, deck: str, target_seconds: int) -> DataFrame:
    total = timed_slides.groupBy(deck).agg(F.sum("own_seconds").alias("total"), F.count("*").alias("slides"), F.sum((~F.col("in_annex")).cast("long")).alias("timed"))
    return total.withColumn("minutes", F.round(F.col("total") / 60, 1)).withColumn("within", F.abs(F.col("total") - target_seconds) <= 0.1 * target_seconds)


def lint(slides: DataFrame, *keys: str) -> DataFrame:
    """keys and one row for each warning on slides(title, bullets, notes)."""
    words = lambda b: F.size(F.split(F.trim(b), r"\s+"))
    found = F.array(
        F.when(F.size("bullets") > 6, "more than 6 bullets"),
        F.when(F.exists("bullets", lambda b: words(b) > 14), "bullet over 14 words"),
        F.when(F.coalesce("title", F.lit("")).rlike(G.GENERIC_TITLE), "generic title"),
        F.when(F.trim(F.coalesce("notes", F.lit(""))) == "", "no notes"),
    )
    return slides.select(*keys, F.explode(F.array_compact(found)).alias("warning"))
