"""Whole runs over folders: sources become a ledger, targets and decks are held against it, deliverables pass the gate.

Sources and targets lie as <folder>/<project>/<paper>.<ending>, decks as <folder>/<project>/<deck>.pptx.  Every step writes what
it made as Parquet below its output folder and later steps read that, so a step can be run again alone.  A step that cannot be
trusted raises `Refused` and those after it do not run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import attest, carryover, reconcile, structure
from ..operators import ledger as L
from ..sinks import office as sinks
from ..sources import office as sources

KEYS = ["project", "paper"]


class Refused(Exception):
    """A step that found something that forbids the next."""


def _placed(files: DataFrame, name: str) -> DataFrame:
    """files with project and name from their path."""
    part = lambda i: F.element_at(F.split("path", "/"), i)
    return files.withColumns({"project": part(-2), name: F.regexp_replace(part(-1), r"\.[^.]*$", "")})


def _save(df: DataFrame, folder: str, name: str) -> DataFrame:
    at = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.parquet(at)


def _locale(default: str, of_papers: Mapping[str, str]) -> Column:
    """A paper's own locale, or the default."""
    own = F.create_map(*(F.lit(x) for pair in of_papers.items() for x in pair)) if of_papers else None
    return F.lit(default) if own is None else F.coalesce(F.try_element_at(own, F.col("paper")), F.lit(default))


def papers(spark: SparkSession, folder: str, locale: str, locales: Mapping[str, str] | None = None) -> DataFrame:
    """project, paper, path, sha256, blocks, locale of every file under folder; two files of one project and paper, or one that can't be
    read, are refused."""
    read = _placed(structure.spread(sources.read_documents(spark, folder)), "paper").withColumn("locale", _locale(locale, locales or {}))
    return read.select(*KEYS, "path", "sha256", "blocks", "locale")


def _sound(read: DataFrame) -> DataFrame:
    """read, unless a file of it is broken or a paper comes twice."""
    broken = read.where("exists(blocks, b -> b.kind = 'error')").select("path", F.col("blocks")[0]["text"].alias("why")).limit(10).collect()
    if broken:
        raise Refused("; ".join(f"{r.path}: {r.why}" for r in broken))
    twice = read.groupBy(*KEYS).count().where("count > 1").limit(10).collect()
    if twice:
        raise Refused("several files of one paper: " + ", ".join(f"{r.project}/{r.paper}" for r in twice))
    return read


def build_ledger(spark: SparkSession, folder: str, out: str, locale: str = "fr", locales: Mapping[str, str] | None = None, old: str | None = None) -> DataFrame:
    """Writes papers (with hash, locale, reader version and blocks) and ledger; returns and writes the summary by paper.

    With the output folder of an older run as `old` the ledger also holds its hand-made items; links has the new id of each item
    that these link to, carried what became of them, and drift the changed sources."""
    if old is not None and old.rstrip("/") == out.rstrip("/"):
        raise ValueError("the older run must lie in another folder")
    read = _sound(_save(papers(spark, folder, locale, locales).withColumn("version", F.lit(L.READER_VERSION)), out, "papers"))
    items = L.extracted(read, KEYS, F.col("blocks"), F.col("locale"), F.upper("paper")).withColumn("linked_items", F.array().cast("array<string>"))
    ledger = _save(items, out, "ledger" if old is None else "read")
    if old is not None:
        before = spark.read.parquet(f"{old.rstrip('/')}/ledger")
        _save(L.drifted(spark.read.parquet(f"{old.rstrip('/')}/papers"), read, KEYS), out, "drift")
        links = _save(carryover.mapping(before, ledger), out, "links")
        kept = _save(carryover.carried(before, ledger, links), out, "kept")
        _save(carryover.report(kept, links), out, "carried")
        ledger = _save(ledger.unionByName(kept.drop("old_id", "lost_links")), out, "ledger")
    return _save(read.select(*KEYS).join(L.summary(ledger, KEYS), KEYS, "left").na.fill(0), out, "summary")


def _ledger(spark: SparkSession, out: str) -> tuple[DataFrame, str]:
    """The ledger under out and its reader's version; one that can't be compared is refused."""
    versions = [r[0] for r in spark.read.parquet(f"{out}/papers").select("version").distinct().limit(2).collect()]
    version = versions[0] if versions else L.READER_VERSION
    if len(versions) > 1 or (version != L.READER_VERSION and version not in L.COMPATIBLE):
        raise Refused(f"ledger of reader {', '.join(map(str, versions))}: rebuild it")
    return spark.read.parquet(f"{out}/ledger"), version


def translation(spark: SparkSession, ledger: str, folder: str, out: str, locale: str, locales: Mapping[str, str] | None = None, ignore: Iterable[str] = ()) -> DataFrame:
    """Targets against the ledger of an earlier step: writes every report of `reconcile.Translation`; returns the verdicts."""
    items, version = _ledger(spark, ledger)
    read = _sound(_save(papers(spark, folder, locale, locales), out, "targets"))
    targets = read.select(*KEYS, L.reading("blocks", "locale").alias("reading"))
    report = reconcile.Translation(items, targets, reconcile.ignored_values(ignore, locale))
    try:
        for name in ("values", "introduced", "dates", "spelled_out", "tables", "references", "citations"):
            _save(getattr(report, name)(), out, name)
        return _save(reconcile.rebuild_first(report.verdicts(), version), out, "verdicts")
    finally:
        report.release()


def deck(spark: SparkSession, ledger: str, folder: str, out: str, locale: str, ignore: Iterable[str] = ()) -> DataFrame:
    """Slide files against the ledger: writes what each introduces; returns the verdicts.  A file that can't be read is refused."""
    items, _ = _ledger(spark, ledger)
    read = _save(_placed(sources.read_decks(spark, folder), "deck").select("project", "deck", "path", "sha256", "slides"), out, "decks")
    broken = read.where("slides IS NULL").select("path").limit(10).collect()
    if broken:
        raise Refused("unreadable slides: " + ", ".join(r.path for r in broken))
    slides = read.select("project", "deck", F.explode("slides").alias("s")).select("project", "deck", "s.slide", N.numbers(F.col("s.text"), locale).alias("numbers"), "s.chart_values")
    report = reconcile.Deck(items, slides, reconcile.ignored_values(ignore, locale))
    _save(report.introduced(), out, "deck_introduced")
    silent = read.select("project", "deck").join(report.verdicts(), ["project", "deck"], "left").na.fill(0).na.fill("lockable", ["verdict"])
    return _save(silent, out, "deck_verdicts")


def typeset(spark: SparkSession, folder: str, out: str, lang: str) -> int:
    """A .docx for every Markdown file under folder, as <out>/<project>/<paper>.docx; returns how many."""
    files = _placed(sources.read_text(spark, folder), "paper").select(F.concat_ws("/", "project", F.concat("paper", F.lit(".docx"))).alias("name"), sinks.typeset(F.col("text"), lang)["content"].alias("content"))
    return sinks.export(files, out)


def attested(deliverables: DataFrame, out: str) -> DataFrame:
    """deliverables (see `attest.gated`) with reasons and issued, written as attestation."""
    return _save(attest.gated(deliverables), out, "attestation")
