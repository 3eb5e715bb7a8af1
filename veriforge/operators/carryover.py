"""Carrying hand-made ledger items over to a ledger built anew.

Old and new ledgers have project, paper and the items' columns; the old one also linked_items.  Items that the reader made are
replaced by the new ones; all others are kept, and their links follow the items they point to.

A link goes to the same place if it can, else to the same value or text.  The search is greedy within one paper (an entry can be
taken once), so each paper's items meet in one task; they are as many as one document holds.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reader as R

#: Similarity from which an entry is the same one, and what a common beginning of HEAD characters is worth.
SAME_ENTRY, SAME_HEAD, HEAD = 0.8, 0.9, 80
KEYS = ["project", "paper"]
_FIELDS = ["id", "kind", "place", "paragraph_index", "raw", "normalized", "role", "context", "label", "key", "index", "text", "extracted_by"]


def _entry(text: str | None) -> str:
    return " ".join(R.reference_index(text)[1].split()).lower()


class _Paper:
    """The new items of one paper, and which are taken."""

    def __init__(self, new: list[dict]):
        new = sorted(new, key=lambda r: r["place"])
        self.of = {k: [r for r in new if r["kind"] == k] for k in ("number", "table", "figure", "citation", "reference")}
        self.by_place: dict = defaultdict(list)
        self.by_paragraph: dict = defaultdict(list)
        self.by_value: dict = defaultdict(list)
        for r in self.of["number"]:
            self.by_place[r["paragraph_index"], r["raw"]].append(r)
            self.by_paragraph[r["paragraph_index"]].append(r)
            self.by_value[r["normalized"]].append(r)
        self.taken: set[str] = set()

    def number(self, old: dict) -> tuple[str, str] | None:
        same = self.by_place[old["paragraph_index"], old["raw"]]
        if old["rank"] < len(same):
            return same[old["rank"]]["id"], "place"
        here = self.by_paragraph[old["paragraph_index"]]
        if equal := [r for r in here if r["normalized"] == old["normalized"]]:
            return equal[0]["id"], "value"
        longer = f"{old['normalized']}."
        if any(r["normalized"].startswith(longer) for r in here):
            alike = lambda r: SequenceMatcher(None, r["context"] or "", old["context"] or "").ratio() + 0.5 * r["normalized"].startswith(longer)
            if (best := max(here, key=alike))["normalized"].startswith(longer):
                return best["id"], "read longer"
        for r in self.by_value[old["normalized"]]:
            if r["id"] not in self.taken and R.same_place(r["context"], old["context"]):
                self.taken.add(r["id"])
                return r["id"], "context"
        return None

    def reference(self, old: dict) -> tuple[str, str] | None:
        was, best, score = _entry(old["text"]), None, 0.0
        for r in self.of["reference"]:
            if r["id"] in self.taken:
                continue
            now = _entry(r["text"])
            s = 1.0 if now == was else SequenceMatcher(None, was, now).ratio()
            if now.startswith(was[:HEAD]) or was.startswith(now[:HEAD]):
                s = max(s, SAME_HEAD)
            if s > score or (s == score and best is not None and r["index"] == old["index"]):
                best, score = r, s
        if best is None or score < SAME_ENTRY:
            return None
        self.taken.add(best["id"])
        return best["id"], "text"

    def find(self, old: dict) -> tuple[str, str] | None:
        kind = old["kind"]
        if kind == "number":
            return self.number(old)
        if kind == "reference":
            return self.reference(old)
        if kind == "table":
            return (self.of["table"][old["rank"]]["id"], "ordinal") if old["rank"] < len(self.of["table"]) else None
        name = {"figure": "label", "citation": "key"}.get(kind)
        # of figures with one label the last stands, as in a lookup by label
        found = [r["id"] for r in self.of.get(kind, []) if name and r[name] == old[name]]
        return (found[-1], name) if found else None


def _twins(hand: list[dict], paper: _Paper) -> Iterator[tuple[str, str, str]]:
    """Hand-made numbers that the reader now reads itself, each new item standing for one."""
    used: set[str] = set()
    for old in hand:
        for r in paper.by_value[old["normalized"]]:
            here = old["paragraph_index"] is not None and r["paragraph_index"] == old["paragraph_index"]
            if r["id"] not in used and (here or R.same_place(old["context"], r["context"])):
                used.add(r["id"])
                yield old["id"], r["id"], "duplicate"
                break


def _map_paper(old: pa.Table, new: pa.Table) -> pa.Table:
    paper, rows = _Paper(new.to_pylist()), old.to_pylist()
    hand = sorted((r for r in rows if r["extracted_by"] != "script" and r["kind"] == "number" and r["role"] != "spelled_out"), key=lambda r: r["place"])
    found = list(_twins(hand, paper))
    linked = sorted((r for r in rows if r["extracted_by"] == "script" and r["linked"] is not None), key=lambda r: (r["linked"]["place"], r["linked"]["pos"]))
    for r in linked:
        if (to := paper.find(r)) is not None:
            found.append((r["id"], *to))
    first = rows[0] if rows else dict.fromkeys(KEYS)
    return pa.table([*(pa.array([first[k]] * len(found), pa.string()) for k in KEYS), *(pa.array([f[i] for f in found], pa.string()) for i in range(3))], [*KEYS, "old_id", "new_id", "by"])


def mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    """project, paper, old_id, new_id, by (place, value, read longer, context, ordinal, label, key, text or duplicate) of the
    reader's items that kept items link to, and of hand-made numbers that the reader now reads itself."""
    links = old.where("extracted_by <> 'script'").select("project", "place", F.posexplode("linked_items").alias("pos", "id"))
    links = links.groupBy("project", "id").agg(F.min(F.struct("place", "pos")).alias("linked"))
    group = F.when(F.col("kind") == "number", F.struct(F.col("paragraph_index").cast("string").alias("a"), F.col("raw").alias("b")))
    by = Window.partitionBy(*KEYS, "extracted_by", "kind", group).orderBy("place")
    ranked = old.select(*KEYS, *_FIELDS, (F.row_number().over(by) - 1).alias("rank")).join(links, ["project", "id"], "left")
    given = ranked.select(*KEYS, *_FIELDS, "rank", "linked").where("linked IS NOT NULL OR extracted_by <> 'script'")
    theirs = new.select(*(F.col(k).alias(f"new_{k}") for k in KEYS), *(F.col(c).alias(c) for c in _FIELDS))  # columns of their own
    return given.groupBy(*KEYS).cogroup(theirs.groupBy(*(f"new_{k}" for k in KEYS))).applyInArrow(_map_paper, "project string, paper string, old_id string, new_id string, by string")


def carried(old: DataFrame, new: DataFrame, mapped: DataFrame) -> DataFrame:
    """The kept items of the old ledger: id (renamed where a new item has it), old_id, linked_items, lost_links."""
    own = ["project"]
    dropped = mapped.where("`by` = 'duplicate'").select("project", F.col("old_id").alias("id"))
    kept = old.where("extracted_by <> 'script'").join(dropped, [*own, "id"], "left_anti")
    # a free name for ids that a new item has: -H, -HH and so on
    ids = new.select("project", "id").distinct()
    suffixed = ids.where("id RLIKE '-H+$'").select("project", F.regexp_replace("id", "-H+$", "").alias("id"), (F.length(F.regexp_extract("id", "-(H+)$", 1))).alias("n")).groupBy(*own, "id").agg(F.collect_set("n").alias("used"))
    clash = kept.select("project", "id").join(ids, [*own, "id"], "left_semi").distinct().join(suffixed, [*own, "id"], "left")
    free = F.get(F.filter(F.sequence(F.lit(1), F.coalesce(F.size("used"), F.lit(0)) + 1), lambda k: ~F.array_contains(F.coalesce("used", F.array().cast("array<int>")), k)), 0)
    renamed = clash.select("project", F.col("id").alias("old_id"), F.concat("id", F.lit("-"), F.repeat(F.lit("H"), free)).alias("renamed"))
    links = kept.select("project", F.col("id").alias("item"), F.posexplode("linked_items").alias("pos", "old_id"))
    here = old.where("extracted_by <> 'script'").select("project", F.col("id").alias("old_id"), F.lit(True).alias("by_hand")).distinct()
    to = links.join(mapped.select("project", "old_id", "new_id"), [*own, "old_id"], "left").join(here, [*own, "old_id"], "left").join(renamed, [*own, "old_id"], "left")
    target = F.coalesce("new_id", F.when(F.col("by_hand"), F.coalesce("renamed", "old_id")))
    rewritten = to.groupBy("project", "item").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("old_id").alias("old"), target.alias("new")))).alias("all"))
    rewritten = rewritten.select("project", F.col("item").alias("id"), F.transform(F.filter("all", lambda x: x["new"].isNotNull()), lambda x: x["new"]).alias("linked_items"), F.transform(F.filter("all", lambda x: x["new"].isNull()), lambda x: x["old"]).alias("lost_links"))
    out = kept.drop("linked_items").join(rewritten, [*own, "id"], "left").join(renamed.withColumnRenamed("old_id", "id"), [*own, "id"], "left")
    return out.withColumnRenamed("id", "old_id").withColumn("id", F.coalesce("renamed", "old_id")).drop("renamed")


def report(kept: DataFrame, mapped: DataFrame) -> DataFrame:
    """project, carried_items, lost_links, renamed, dropped_duplicates."""
    a = kept.groupBy("project").agg(F.count("*").alias("carried_items"), F.sum(F.coalesce(F.size("lost_links"), F.lit(0))).alias("lost_links"), F.count(F.when(F.col("id") != F.col("old_id"), 1)).alias("renamed"))
    b = mapped.groupBy("project").agg(F.count(F.when(F.col("by") == "duplicate", 1)).alias("dropped_duplicates"))
    return a.join(b, "project", "left").na.fill(0)
