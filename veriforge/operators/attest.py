"""Attestation gates and approval checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T


def gated(deliverables: DataFrame) -> DataFrame:
    """deliverables(approval, approved_ref, ref, locked, open_issues, sha256, known_sha256, majors, and perhaps deck_sha256 and
    locked_deck_sha256) with reasons and issued."""
    deck = F.lit(False)
    if {"deck_sha256", "locked_deck_sha256"} <= set(deliverables.columns):
        deck = F.col("deck_sha256") != F.col("locked_deck_sha256")
    valid = (F.coalesce("approval", F.lit("")) == "valid") & F.col("approved_ref").isNotNull()
    r = F.array_compact(F.array(
        F.when(~valid, "no valid approval"),
        F.when(valid & (F.col("ref") != F.col("approved_ref")), "reference differs"),
        F.when(~F.coalesce("locked", F.lit(False)), "not locked"),
        F.when(F.coalesce("open_issues", F.lit(0)) > 0, "open issues"),
        F.when(F.col("sha256").isNull(), "file missing"),
        F.when(F.col("sha256") != F.col("known_sha256"), "stale hash"),
        F.when(F.col("sha256").isNotNull() & (F.coalesce("majors", F.lit(0)) > 0), "major findings"),
        F.when(deck, "locked deck changed"),
    ))
    return deliverables.withColumn("reasons", r).withColumn("issued", F.size(r) == 0)


def open_issues(issues: DataFrame) -> DataFrame:
    """target, open_issues, ids of the issues whose status is not closed."""
    return issues.where(F.coalesce("status", F.lit("")) != "closed").groupBy("target").agg(F.count("*").alias("open_issues"), F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("ids"))


def rolled_up(verdicts: DataFrame) -> DataFrame:
    """verdicts of `Translation` with matched/expected strings for numbers, tables and references."""
    part = lambda a, b: F.concat_ws("/", F.col(a).cast("string"), F.col(b).cast("string"))
    return verdicts.select("project", "paper", part("matched", "expected_distinct").alias("ledger_matched"), part("tables_ok", "tables").alias("tables_ok"), part("verbatim", "references").alias("references_verbatim"), F.when(F.col("majors") == 0, "attestable").otherwise("not attestable").alias("verdict"))


def approval_verdict(prefix: str, ref: Column, project: Column, name: Column, date_iso: Column, code: Column) -> Column:
    """valid, invalid or (a field is missing) unverifiable."""
    want = T.verification_code(prefix, F.trim(ref), F.upper(F.trim(project)), N.plain_name(name), F.trim(date_iso))
    missing = ref.isNull() | project.isNull() | name.isNull() | date_iso.isNull() | code.isNull()
    return F.when(missing, "unverifiable").when(want == F.upper(F.trim(code)), "valid").otherwise("invalid")


@dataclass(frozen=True)
class Letter:
    """How an institution's approval letters read: Java patterns.  code_line has four groups: code, reference, project, date;
    name has one."""

    prefix: str
    title: str
    signatory: str
    reference: str
    code_line: str
    name: str


def verified(letters: DataFrame, letter: Letter) -> DataFrame:
    """letters(text, and any of ref, project, name, date_iso, code as typed by hand, profile_project, profile_family,
    profile_first) with the fields, checks (a map; a check that can't be made is left out) and verdict.

    A field typed by hand counts before the text's.  Without a text the letter stands on the typed fields; with a field missing
    it is unverifiable; any failed check makes it invalid.
    """
    typed = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in letters.columns else F.lit(None).cast("string")
    text = F.coalesce(N.composed(F.col("text")), F.lit(""))
    found = lambda i: F.nullif(F.regexp_extract("t", letter.code_line, i), F.lit(""))
    d = letters.withColumn("t", text)
    told = F.nullif(F.trim(F.regexp_replace(F.regexp_extract("t", letter.name, 1), r"(?U)\s+", " ")), F.lit(""))
    d = d.withColumns({"f_code": F.upper(F.coalesce(typed("code"), found(1))), "f_ref": F.coalesce(typed("ref"), found(2)), "f_project": F.upper(F.coalesce(typed("project"), found(3))), "f_date": F.coalesce(typed("date_iso"), found(4)), "f_name": F.coalesce(typed("name"), told)})
    want = T.verification_code(letter.prefix, F.col("f_ref"), F.col("f_project"), N.plain_name(F.col("f_name")), F.col("f_date"))
    profile = {c: typed(f"profile_{c}") for c in ("project", "family", "first")}
    said = F.trim(F.col("t")) != ""
    name, family, first = N.plain_name(F.col("f_name")), N.plain_name(F.coalesce(profile["family"], F.lit(""))), N.plain_name(F.coalesce(profile["first"], F.lit("")))
    checks = {
        "title": F.when(said, F.col("t").rlike(letter.title)),
        "signatory": F.when(said, F.col("t").rlike(letter.signatory)),
        "code line": F.when(said, found(1).isNotNull()),
        "reference format": F.col("f_ref").rlike(f"^(?:{letter.reference})$"),
        "code": F.col("f_code") == want,
        "date format": F.col("f_date").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        "project": F.when(profile["project"].isNotNull(), F.upper(profile["project"]) == F.col("f_project")),
        "name": F.when(F.trim(F.concat(family, first)) != "", (name == F.trim(F.concat_ws(" ", family, first))) | (name == F.trim(F.concat_ws(" ", first, family)))),
    }
    made = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in checks.items())), lambda x: x["v"].isNotNull()))
    fields = ["f_code", "f_ref", "f_project", "f_date", "f_name"]
    missing = F.exists(F.array(*fields), lambda x: x.isNull())
    verdict = F.when(missing, "unverifiable").when(F.forall(F.map_values("checks"), lambda x: x), "valid").otherwise("invalid")
    return d.withColumn("checks", made).withColumn("verdict", verdict).select(*letters.columns, *(F.col(f).alias("letter_" + f[2:]) for f in fields), "checks", "verdict")
