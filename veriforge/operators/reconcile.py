"""Comparison of derived documents with the ledger of their sources, as joins of multisets.

Keys name the project and the paper.  Every comparison is an equi-join on keys and value, so papers are spread over the
cluster; only reference lists, which are as short as a paper's, are compared pair by pair, within one paper.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import document as D
from ..functions import grammar as G
from ..functions import numbers as N
from ..functions import reader as R
from . import ledger as L

#: A reference is verbatim from this similarity on.
VERBATIM = 0.985
UNCOUNTED_ROLES = ("numbering", "label_ref")
#: Roles of numbers that have reports of their own.
APART = ("spelled_out", "date")


def multiset(values: DataFrame, keys: list[str], value: str = "normalized", count: str = "n") -> DataFrame:
    return values.groupBy(*keys, value).agg(F.count("*").alias(count))


def compared(expected: DataFrame, found: DataFrame, keys: list[str], value: str = "normalized") -> DataFrame:
    """keys, value, expected, found, status: missing, under (found less often) or matched."""
    e, f = multiset(expected, keys, value, "expected"), multiset(found, keys, value, "found")
    both = e.join(f, [*keys, value], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.withColumn("status", F.when(F.col("found") == 0, "missing").when(F.col("found") < F.col("expected"), "under").otherwise("matched"))


def introduced(known: DataFrame, found: DataFrame, keys: list[str], value: str = "normalized") -> DataFrame:
    """Distinct values of the target that the source does not have."""
    return found.select(*keys, value).distinct().join(known.select(*keys, value).distinct(), [*keys, value], "left_anti")


def table_difference(source: DataFrame, target: DataFrame, keys: list[str], value: str = "normalized") -> DataFrame:
    """keys, value, missing, extra: multiset difference either way."""
    s, t = multiset(source, keys, value, "s"), multiset(target, keys, value, "t")
    d = s.join(t, [*keys, value], "full").na.fill(0, ["s", "t"])
    return d.select(*keys, value, F.greatest(F.col("s") - F.col("t"), F.lit(0)).alias("missing"), F.greatest(F.col("t") - F.col("s"), F.lit(0)).alias("extra")).where("missing > 0 OR extra > 0")


def ignored_values(texts: Iterable[str], locale: str) -> list[str]:
    """Values of the strings whose numbers are tolerated."""
    return sorted({h.normalized for t in texts for h in R.numbers(t, locale)})


def _plain_reference(text: str | None) -> str:
    return " ".join(G.INDEX.sub("", text or "").split()).casefold()  # lower() keeps ß, which capitals write SS


def best_match(entry: str | None, candidates: Iterable[tuple[str, str | None]]) -> tuple[float, str | None]:
    """(similarity, text) of the first most similar of candidates (plain, text).  Candidates whose upper bounds can't beat the
    best so far are not compared, so none is lost."""
    from difflib import SequenceMatcher

    a = _plain_reference(entry)
    best, at = 0.0, None
    for b, text in candidates:
        if a == b:
            return 1.0, text
        if 2 * min(len(a), len(b)) <= best * (len(a) + len(b)):
            continue
        m = SequenceMatcher(None, a, b)
        if m.quick_ratio() > best and (r := m.ratio()) > best:
            best, at = r, text
    return best, at


def best_references(sources: DataFrame, targets: DataFrame, keys: list[str], id_col: str = "id", text: str = "text") -> DataFrame:
    """keys, id, similarity, verbatim, target_text of each source entry's best match among the target entries of its paper.

    Entries are compared without their index and regardless of case, by the ratio of matching blocks.  Equal ones are found by an
    equi-join; the others of a paper meet that paper's list in one task.
    """
    from pyspark.sql.functions import arrow_udf

    def plain(t: pa.Array) -> pa.Array:
        return pa.array([_plain_reference(x) for x in t.to_pylist()], pa.string())

    plain.__annotations__ = {"t": pa.Array, "return": pa.Array}
    folded = arrow_udf(plain, "string")
    s = sources.select(*keys, F.col(id_col).alias("id"), F.col(text).alias("text"), folded(F.col(text)).alias("plain"))
    theirs = [f"target_{k}" for k in keys]  # columns of their own, whatever both sides come from
    t = targets.select(*(F.col(k).alias(n) for k, n in zip(keys, theirs, strict=True)), F.col(text).alias("text"), folded(F.col(text)).alias("plain"))
    equal = t.groupBy(*theirs, "plain").agg(F.min("text").alias("target_text")).toDF(*keys, "plain", "target_text")
    known = s.join(equal, [*keys, "plain"], "left")
    exact = known.where("target_text IS NOT NULL").select(*keys, "id", F.lit(1.0).alias("similarity"), "target_text")
    rest = known.where("target_text IS NULL").select(*keys, "id", "text")

    def match(given: pa.Table, others: pa.Table) -> pa.Table:
        candidates = list(zip(others.column("plain").to_pylist(), others.column("text").to_pylist(), strict=True))
        found = [best_match(x, candidates) for x in given.column("text").to_pylist()]
        return pa.table([*(given.column(k) for k in (*keys, "id")), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.string())], [*keys, "id", "similarity", "target_text"])

    schema = rest.select(*keys, "id").schema.simpleString()[len("struct<") : -1] + ",similarity:double,target_text:string"
    # only papers with an entry left over are looked at
    open_ = rest.select(*(F.col(k).alias(n) for k, n in zip(keys, theirs, strict=True))).distinct()
    near = rest.groupBy(*keys).cogroup(t.join(open_, theirs, "left_semi").groupBy(*theirs)).applyInArrow(match, schema.replace(":", " "))
    both = exact.union(near)
    return both.select(*keys, "id", F.round("similarity", 3).alias("similarity"), (F.col("similarity") >= VERBATIM).alias("verbatim"), "target_text")


def _differences(source: list[str] | None, target: list[str] | None) -> dict:
    """Values that either side has more often, with how often."""
    if source == target:
        return {"missing": [], "extra": []}
    s, t = Counter(source or ()), Counter(target or ())
    return {"missing": sorted((s - t).items()), "extra": sorted((t - s).items())}


_COUNTS = pa.map_(pa.string(), pa.int64())
_difference = N.over(_differences, "struct<missing:map<string,bigint>,extra:map<string,bigint>>", pa.struct([("missing", _COUNTS), ("extra", _COUNTS)]))


def verbatim_entries(entries: Iterable[str] | None, targets: Iterable[str] | None) -> int:
    """How many of a paper's reference entries are verbatim among those of its target (see `best_references`)."""
    there = {_plain_reference(t): t for t in targets or ()}
    return sum(_plain_reference(e) in there or best_match(e, there.items())[0] >= VERBATIM for e in entries or ())


_verbatim = N.over(verbatim_entries, "int", pa.int32())


def ranked_match(old: DataFrame, new: DataFrame, keys: list[str], old_id: str, new_id: str) -> DataFrame:
    """old_id to new_id: the n-th occurrence of a key is the n-th occurrence of it in the other version."""
    number = lambda df, i: df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(i)))
    return number(old, old_id).join(number(new, new_id), [*keys, "rank"], "left").select(old_id, new_id)


def compared_tables(papers: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ordinal, id, label, rows_src, rows_tgt, missing, extra (maps of values to counts) and ok: the k-th table of a paper
    against the k-th one of its target.

    Either side has a row a paper: own_tables (id, label, rows_src, values), and tables (values, filled_rows)."""
    both = papers.select(*keys, "own_tables").join(targets.select(*keys, "tables").hint("merge"), keys, "left")
    both = both.select(*keys, F.posexplode_outer("own_tables").alias("at", "s"), "tables").where("at IS NOT NULL").withColumn("t", F.get("tables", F.col("at")))
    both = both.withColumn("d", _difference(F.col("s.values"), F.col("t.values")))
    both = both.select(*keys, (F.col("at") + 1).alias("ordinal"), "s.id", "s.label", "s.rows_src", F.col("t.filled_rows").alias("rows_tgt"), "d.missing", "d.extra")
    return both.withColumn("ok", F.col("rows_tgt").isNotNull() & (F.size("missing") == 0) & (F.size("extra") == 0) & F.col("rows_src").eqNullSafe(F.col("rows_tgt")))


def compared_papers(papers: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """keys, expected_distinct, matched, missing, tables, tables_ok, references, verbatim, majors and verdict of each target.

    Either side has a row a paper: expected (values of text and tables), own_tables and own_references, and found (values), tables and
    entries.  What is compared here is no longer than the paper, and either side is read and moved once."""
    both = targets.select(*keys, "found", F.col("tables").alias("t"), "entries").join(papers.select(*keys, F.array_distinct("expected").alias("expected"), F.col("own_tables").alias("s"), F.col("own_references").alias("refs")).hint("merge"), keys, "left")
    whole = lambda n: F.coalesce(n, F.lit(0)).cast("long")
    same = lambda a, b: b["filled_rows"].eqNullSafe(a["rows_src"]) & b["filled_rows"].isNotNull() & F.sort_array(a["values"]).eqNullSafe(F.sort_array(b["values"]))
    known = F.array_compact(F.array_intersect("expected", "found"))
    out = both.select(
        *keys, whole(F.size("expected")).alias("expected_distinct"), whole(F.size(known)).alias("matched"), whole(F.size("expected") - F.size(known)).alias("missing"),
        whole(F.size("s")).alias("tables"), whole(F.size(F.filter(F.transform("s", lambda x, i: same(x, F.get("t", i))), lambda ok: ok))).alias("tables_ok"),
        whole(F.size("refs")).alias("references"), _verbatim("refs", "entries").cast("long").alias("verbatim"),
    )
    out = out.withColumn("majors", F.col("missing") + F.col("tables") - F.col("tables_ok") + F.col("references") - F.col("verbatim"))
    return out.withColumn("verdict", F.when(F.col("majors") == 0, "attestable").otherwise("not attestable"))


def text_papers(text: Column, locale: Column, prefix: Column, ignore: Iterable[str] = ()) -> Column:
    """struct(expected, own_tables, own_references) of a paper's Markdown text: the same as a ledger's items of it come to."""
    apart, ignored = {*UNCOUNTED_ROLES, *APART}, set(ignore)

    def facts(t: str | None, locale: str | None, prefix: str | None) -> dict:
        numbers, tables, references = D.own_facts(D.markdown_blocks(t), locale, prefix)
        running = [h.normalized for h in numbers if h.role not in apart and h.normalized not in ignored]
        return {"expected": [*running, *(v for x in tables for v in x["values"])], "own_tables": tables, "own_references": references}

    kind = pa.struct([("expected", pa.list_(pa.string())), ("own_tables", L._OWN_TABLES), ("own_references", pa.list_(pa.string()))])
    return N.over(facts, f"struct<expected:array<string>,own_tables:{L.OWN_TABLES},own_references:array<string>>", kind)(text, locale, prefix)


class Translation:
    """A translated paper against the ledger: it must carry every item of its paper.

    ledger has project, paper and the items' columns; targets has one row of project, paper and reading (see `ledger.reading`) for
    each paper.  Both are kept by Spark, as most reports read them several times, until `release`; a lost executor's part is made
    anew.  `tables` and `verdicts` read either once: for one of these alone nothing need be kept.
    """

    PROJECT, KEYS = ["project"], ["project", "paper"]

    def __init__(self, ledger: DataFrame, targets: DataFrame, ignore: Iterable[str] = (), keep: bool = True):
        if keep:
            ledger, targets = ledger.persist(), targets.persist()
        self.ledger, self.targets, self.ignore = ledger, targets, list(ignore)
        self.hits = targets.select(*self.KEYS, F.posexplode("reading.numbers").alias("pos", "h")).select(*self.KEYS, "pos", "h.*")
        self.counts = multiset(self.hits, self.KEYS, count="found")
        self.counted = (F.col("kind") == "number") & ~F.coalesce("role", F.lit("")).isin(*UNCOUNTED_ROLES) & ~F.col("normalized").isin(self.ignore)
        self.numbers = ledger.where(self.counted)
        self.table_values = ledger.where("kind = 'table'").select(*self.KEYS, F.explode("values").alias("normalized"))

    def release(self) -> None:
        self.ledger.unpersist()
        self.targets.unpersist()

    def values(self) -> DataFrame:
        """keys, normalized, expected, found, status, example_id, context of every value of the text and the tables."""
        running = self.numbers.where("coalesce(role, '') NOT IN ('spelled_out', 'date')")
        every = running.select(*self.KEYS, "normalized", F.struct("place", "id", "context").alias("example")).unionByName(self.table_values, allowMissingColumns=True)
        expected = every.groupBy(*self.KEYS, "normalized").agg(F.count("*").alias("expected"), F.min("example").alias("example"))
        both = expected.join(self.counts, [*self.KEYS, "normalized"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
        status = F.when(F.col("found") == 0, "missing").when(F.col("found") < F.col("expected"), "under").otherwise("matched")
        return both.select(*self.KEYS, "normalized", "expected", "found", status.alias("status"), F.col("example.id").alias("example_id"), F.substring("example.context", 1, 160).alias("context"))

    def _first_unknown(self) -> DataFrame:
        """The first place of each target value that the project does not know."""
        everywhere = self.ledger.where("kind = 'number'").select("project", "normalized").union(self.ledger.where("kind = 'figure'").select("project", F.explode("values"))).union(L.date_parts(self.ledger, self.PROJECT))
        found = self.hits.where(~F.coalesce("role", F.lit("")).isin(*UNCOUNTED_ROLES) & ~F.col("normalized").isin(self.ignore))
        found = found.join(everywhere.distinct(), ["project", "normalized"], "left_anti").join(self.table_values.distinct(), [*self.KEYS, "normalized"], "left_anti")
        return found.groupBy(*self.KEYS, "normalized").agg(F.min_by(F.struct("raw", "role", "context"), "pos").alias("x")).select(*self.KEYS, "normalized", "x.raw", "x.role", F.substring(F.trim("x.context"), 1, 160).alias("context"))

    def introduced(self) -> DataFrame:
        """keys, normalized, raw, context of the target's values that no source has."""
        return self._first_unknown().where("coalesce(role, '') <> 'date'").drop("role")

    def dates(self) -> DataFrame:
        """Dates to look at by eye: those of the ledger, found in the target or not, and those that only the target has."""
        own = self.numbers.where("role = 'date'").join(self.counts, [*self.KEYS, "normalized"], "left")
        own = own.select(*self.KEYS, "id", "raw", "normalized", F.col("found").isNotNull().alias("found_in_target"))
        return own.unionByName(self._first_unknown().where("role = 'date'").select(*self.KEYS, F.lit(None).cast("string").alias("id"), "raw", "normalized", F.lit(True).alias("found_in_target")))

    def spelled_out(self) -> DataFrame:
        """Numbers written in words, and whether the target has them as digits; never a finding."""
        own = self.numbers.where("role = 'spelled_out'").join(self.counts, [*self.KEYS, "normalized"], "left")
        return own.select(*self.KEYS, "id", "raw", "normalized", F.col("found").isNotNull().alias("found_as_digits"))

    def tables(self) -> DataFrame:
        """See `compared_tables`."""
        return compared_tables(self._papers(), self._targets("tables"), self.KEYS)

    def _papers(self) -> DataFrame:
        """keys, expected (values of text and tables), own_tables (in order) and own_references of each paper of the ledger, in one pass."""
        kind = F.col("kind")
        filled = F.coalesce(F.size(F.filter("cells", lambda r: F.exists(r, lambda c: F.trim(c) != ""))), F.col("n_rows"))
        counted = self.counted & ~F.coalesce("role", F.lit("")).isin(*APART)
        return self.ledger.where("kind IN ('number', 'table', 'reference')").groupBy(*self.KEYS).agg(
            F.flatten(F.collect_list(F.when(kind == "table", F.col("values")).when(counted, F.array("normalized")))).alias("expected"),
            F.array_sort(F.collect_list(F.when(kind == "table", F.struct("place", "id", "label", filled.alias("rows_src"), "values")))).alias("own_tables"),
            F.collect_list(F.when(kind == "reference", F.coalesce("text", F.lit("")))).alias("own_references"),
        )

    def _targets(self, *fields: str) -> DataFrame:
        return self.targets.select(*self.KEYS, *(F.col(f"reading.{c}").alias(c) for c in fields))

    def references(self) -> DataFrame:
        """keys, id, similarity, verbatim, target_text of each reference of the ledger."""
        return best_references(self.ledger.where("kind = 'reference'"), self.targets.select(*self.KEYS, F.explode("reading.entries").alias("text")), self.KEYS)

    def citations(self) -> DataFrame:
        """keys, key, expected, found, ok of each citation of the ledger."""
        found = self.targets.select(*self.KEYS, F.explode("reading.citations").alias("key")).groupBy(*self.KEYS, "key").agg(F.count("*").alias("found"))
        both = self.ledger.where("kind = 'citation'").join(found, [*self.KEYS, "key"], "left")
        return both.select(*self.KEYS, "key", F.col("occurrences").alias("expected"), F.coalesce("found", F.lit(0)).alias("found")).withColumn("ok", F.col("expected") == F.col("found"))

    def verdicts(self) -> DataFrame:
        """See `compared_papers`."""
        targets = self._targets("numbers", "tables", "entries").withColumn("found", F.transform("numbers", lambda h: h["normalized"]))
        return compared_papers(self._papers(), targets, self.KEYS)


def rebuild_first(verdicts: DataFrame, version: str) -> DataFrame:
    """verdicts with rebuild_ledger_first: major findings against a ledger of an older reader are no proof against the target."""
    older = F.lit(version != L.READER_VERSION) & (F.col("majors") > 0)
    return verdicts.withColumn("rebuild_ledger_first", older).withColumn("verdict", F.when(older, F.concat("verdict", F.lit(": rebuild the ledger first"))).otherwise(F.col("verdict")))


class Deck:
    """Slides against the ledger: a deck may condense but not introduce a number.

    slides has project, deck, slide, numbers (hits) and chart_values (series, category, normalized).
    """

    def __init__(self, ledger: DataFrame, slides: DataFrame, ignore: Iterable[str] = ()):
        # one pass over the ledger, which need not be kept; merged, as a project's values are many: broadcast, they would fill the driver
        value = F.coalesce("normalized", F.lit(""))
        values = F.when((F.col("kind") == "number") & (F.col("role") == "date"), F.concat(F.array(value), F.split(value, "-"))).when(F.col("kind") == "number", F.array(value)).when(F.col("kind").isin("table", "figure"), F.col("values"))
        self.known = ledger.select("project", F.explode(values).alias("normalized")).where("normalized <> ''").distinct().withColumn("known", F.lit(True)).hint("merge")
        # outer: else Spark reads each slide once more to filter by the size of the array
        said = slides.select("project", "deck", "slide", F.posexplode_outer("numbers").alias("pos", "h")).where("pos IS NOT NULL").select("project", "deck", "slide", "pos", "h.raw", "h.normalized", "h.context", F.coalesce("h.role", F.lit("")).alias("role"), "h.unit")
        enumeration = F.col("normalized").rlike("^[1-9]$") & F.col("unit").isNull() & (F.col("role") == "")
        said = said.where(~F.col("normalized").isin(list(ignore)) & ~F.col("role").isin(*UNCOUNTED_ROLES) & ~enumeration)
        shown = slides.select("project", "deck", "slide", F.posexplode("chart_values").alias("pos", "c")).select("project", "deck", "slide", (F.col("pos") + 1_000_000).alias("pos"), F.col("c.normalized").alias("raw"), "c.normalized", F.concat(F.lit("chart value: "), "c.series", F.lit(" / "), "c.category").alias("context"))
        self.checked = said.drop("role", "unit").unionByName(shown).join(self.known, ["project", "normalized"], "left").withColumn("known", F.coalesce("known", F.lit(False)))

    def introduced(self) -> DataFrame:
        """project, deck, slide, raw, normalized, context of each number that no paper has, repeats included."""
        return self.checked.where(~F.col("known")).select("project", "deck", "slide", "raw", "normalized", F.substring(F.trim("context"), 1, 120).alias("context"))

    def verdicts(self) -> DataFrame:
        """project, deck, covered (distinct ledger numbers shown), introduced, verdict."""
        out = self.checked.groupBy("project", "deck").agg(F.count_distinct(F.when(F.col("known"), F.col("normalized"))).alias("covered"), F.count(F.when(~F.col("known"), 1)).alias("introduced"))
        return out.withColumn("verdict", F.when(F.col("introduced") == 0, "lockable").otherwise("not lockable"))


def glossary_counts(texts: DataFrame, entries: list[dict], source_lang: str, keys: list[str]) -> DataFrame:
    """keys, lang, entry, source, target, acronym, keeps_acronym of each entry that the source text has.

    texts has keys, lang and body; the entries (term_<lang>, variants_<lang>, acronym, keep_latin_acronym) are a glossary of
    bounded size and travel with the plan.
    """
    def terms(lang: str) -> list[str]:
        return [x for e in entries for x in (e.get(f"term_{lang}") or "", *(e.get(f"variants_{lang}") or []))]

    def summed(lang: str, counts, variants: bool):
        places, at = [], 1
        for e in entries:
            n = 1 + len(e.get(f"variants_{lang}") or [])
            places.append((at, n if variants else 1))
            at += n
        return [F.aggregate(F.slice(counts, a, n), F.lit(0), lambda x, y: x + y) for a, n in places]

    acronyms = [e.get("acronym") or "" for e in entries]

    def counted(lang: str, variants: bool) -> DataFrame:
        t = texts.where(F.col("lang") == lang).withColumn("c", N.term_counts(F.col("body"), terms(lang))).withColumn("a", N.term_counts(F.col("body"), acronyms))
        return t.select(*keys, F.posexplode(F.array(*(F.struct(n.alias("n"), F.get("a", F.lit(i)).alias("a")) for i, n in enumerate(summed(lang, F.col("c"), variants))))).alias("entry", "x")).select(*keys, "entry", "x.n", "x.a")

    langs = sorted({k[len("term_") :] for e in entries for k in e if k.startswith("term_")} - {source_lang})
    source = counted(source_lang, False).select(*keys, "entry", (F.col("n") + F.col("a")).alias("source")).where("source > 0")
    keeps = F.array(*(F.lit(bool(e.get("acronym") and e.get("keep_latin_acronym"))) for e in entries))
    out = None
    for lang in langs:
        one = source.join(counted(lang, True).select(*keys, "entry", F.col("n").alias("target"), F.col("a").alias("acronym")), [*keys, "entry"]).withColumn("lang", F.lit(lang)).withColumn("keeps_acronym", F.get(keeps, "entry"))
        out = one if out is None else out.unionByName(one)
    return out


def glossary_problems(counts: DataFrame) -> DataFrame:
    """counts(source, target, acronym, keeps_acronym) with problems: absent, acronym absent, under half of the source."""
    total = F.col("target") + F.col("acronym")
    found = F.array_compact(F.array(F.when(total == 0, "absent"), F.when(F.col("keeps_acronym") & (F.col("acronym") == 0), "acronym absent"), F.when(total < 0.5 * F.col("source"), "under-used")))
    return counts.where("source > 0").withColumn("problems", found)
