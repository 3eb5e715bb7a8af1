"""Secret scans: fixed patterns, and Markov models of random strings and ordinary identifiers.

All of it is DataFrame and SQL expressions.  A pattern's matches are found with their places by framing each with a mark
(U+E000, replaced beforehand in the text by another private character), splitting at the mark and adding up lengths.

Both models are first-order chains over characters, counted from labelled samples and smoothed.  A candidate's score is the
sum of log(P(b | a) under random / P(b | a) under ordinary) over its neighbouring characters, looked up in a literal array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import apart, together

#: The three patterns, as (kind, Java pattern, condition on the match m).
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"""length(regexp_extract(m, '(?i:password|passwd|secret|token|api_?key)["\']?\\x20*[:=]\\x20*["\']?([A-Za-z0-9+/_.=-]+)', 1)) >= 6"""),
    ("access", r"AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", r"[0-9a-f]{24,}", "true"),
]
_CHAR = "[A-Za-z0-9+/_=-]"
#: Tokens that the models judge: 16 characters or more with a letter and a digit among them, or 20 or more with a letter.
CANDIDATE = f"(?<!{_CHAR})(?={_CHAR}*[A-Za-z])(?:(?={_CHAR}*[0-9]){_CHAR}{{16,}}|{_CHAR}{{20,}})"
MARK, STAND_IN = "", ""
#: Characters of candidates have codes from 43 to 122.
LOW, SIZE = 43, 80
#: Log-likelihood ratio beyond which a candidate counts as random: mean of its steps, and their sum.
THRESHOLD, LEAST_SUM = 0.25, 8.0
SMOOTHING = 0.5
REDACTED = "[SECRET]"
_BLOCK = 512

#: Common parts of identifiers, from which ordinary samples are joined.
PARTS = """account action address amount array async attribute average base batch block body buffer build byte cache call category change channel char
check child class clean client close cluster code column command comment commit common config connect content context control convert copy count create
current customer data date default delete detail device dictionary direction display document domain download edge editor element email empty encode end
engine entity entry error event example execute export factory feature field file filter find first flag folder form format frame function generate global
group handler hash header height helper history host image import index info init input insert instance int item iterator job join key label language last
layer layout length level library limit line link list listener load local location lock log login loop main manager map margin mask master match matrix max
memory menu message meta method metric middle model module mouse name network next node notify number object offset option order output owner package page
panel param parent parse partition password path pattern percent person phone pixel plugin point policy pool position price print process product profile
project property proxy query queue random range rate reader record region register relation release remote remove render report request reset resource
response result return role root route row rule sample scale schema scope score script search section segment select send sequence server service session
setting shape share signal size skip sort source space split stack stage start state static status step stop storage store stream string structure style
submit summary support switch symbol sync system table tag target task template test text thread time title token tool total trace track transaction
transform tree trigger type unit update upload user util valid value variable vector version view visible volume wait watch weight widget width window
worker wrapper write zone""".split()


def samples(spark: SparkSession, n: int = 3000) -> DataFrame:
    """Labelled samples (text, label): 1 random, 0 ordinary.  n of each form; a table of one's own may take their place."""
    parts = "array(" + ",".join(f"'{p}'" for p in PARTS) + ")"
    word = lambda salt: f"element_at({parts}, CAST(pmod(xxhash64(id, {salt}), {len(PARTS)}) AS INT) + 1)"
    ids = spark.range(n, numPartitions=1).select("id", F.expr("sha2(CAST(id AS STRING), 256)").alias("h"), *(F.expr(word(i)).alias(f"w{i}") for i in range(3)))
    random = ids.select(F.expr("explode(array(h, base64(unhex(h)), translate(base64(unhex(h)), '+/=', '-_'), regexp_replace(upper(base64(unhex(h))), '[^A-Z0-9]', '')))").alias("text"), F.lit(1).alias("label"))
    ordinary = ids.select(F.expr("explode(array(concat_ws('_', w0, w1, w2), concat_ws('-', w0, w1, w2), concat(w0, initcap(w1), initcap(w2)), concat_ws('/', w0, w1, concat(w2, CAST(id % 10 AS STRING))), upper(concat_ws('_', w0, w1)), concat(w0, '_', CAST(1990 + id % 40 AS STRING), '-', CAST(10 + id % 3 AS STRING))))").alias("text"), F.lit(0).alias("label"))
    return random.union(ordinary)


def train(labelled: DataFrame) -> list[float]:
    """Log ratios by SIZE * (first - LOW) + (second - LOW).  The driver gets SIZE * SIZE counts of either label at most."""
    steps = labelled.where("text IS NOT NULL AND label IS NOT NULL").select("label", "text", F.expr("explode(sequence(1, greatest(length(text) - 1, 1)))").alias("i"))
    pairs = steps.select("label", F.expr(f"ascii(substr(text, i, 1)) - {LOW}").alias("a"), F.expr(f"ascii(substr(text, i + 1, 1)) - {LOW}").alias("b"))
    counts = {(r.label, r.a, r.b): r.n for r in pairs.where(f"a BETWEEN 0 AND {SIZE - 1} AND b BETWEEN 0 AND {SIZE - 1}").groupBy("label", "a", "b").agg(F.count("*").alias("n")).collect()}
    rows = {(y, a): sum(counts.get((y, a, b), 0) for b in range(SIZE)) for y in (0, 1) for a in range(SIZE)}
    p = lambda y, a, b: (counts.get((y, a, b), 0) + SMOOTHING) / (rows[y, a] + SMOOTHING * SIZE)
    return [math.log(p(1, a, b) / p(0, a, b)) for a in range(SIZE) for b in range(SIZE)]


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bound(expression: str, name: str, use: str) -> str:
    """use, with the expression computed once under a name."""
    return f"transform(array({expression}), {name} -> {use})[0]"


def _matches(text: str, pattern: str, kind: int, condition: str) -> str:
    """Array of struct(s, k, e, m): the pattern's matches in column text that meet the condition on m, by start.

    Segments are folded in blocks, each from place 0; then the blocks' lengths are added up and every block moved to its place.
    So a text with n matches takes time in proportion to n and to the square of its blocks alone.
    """
    segs = f"split(regexp_replace({text}, {_quoted('(' + pattern + ')')}, '{MARK}$1{MARK}'), '{MARK}')"
    none = "CAST(array() AS ARRAY<STRUCT<s: INT, k: INT, e: INT, m: STRING>>)"
    hit = f"named_struct('s', c.pos, 'k', {kind}, 'e', c.pos + length(x), 'm', x)"
    block = f"aggregate(slice(segs, b * {_BLOCK} + 1, {_BLOCK}), named_struct('pos', 0, 'i', 0, 'out', {none}), (c, x) -> named_struct('pos', c.pos + length(x), 'i', c.i + 1, 'out', IF(c.i % 2 = 1, array_append(c.out, {hit}), c.out)))"
    blocks = f"transform(sequence(0, (size(segs) - 1) DIV {_BLOCK}), b -> {block})"
    places = "aggregate(blocks, named_struct('at', 0, 'all', CAST(array() AS ARRAY<INT>)), (a, x) -> named_struct('at', a.at + x.pos, 'all', array_append(a.all, a.at)), a -> a.all)"
    moved = "flatten(transform(blocks, (x, i) -> transform(x.out, h -> named_struct('s', h.s + places[i], 'k', h.k, 'e', h.e + places[i], 'm', h.m))))"
    found = f"IF(size(segs) < 2, {none}, {_bound(blocks, 'blocks', _bound(places, 'places', moved))})"
    kept = found if condition == "true" else f"filter({found}, y -> {_bound('y.m', 'm', condition)})"
    return _bound(segs, "segs", kept)


def _spans(docs: DataFrame, llr: list[float]) -> DataFrame:
    """doc_id, text, others (all further columns of docs), base and added: arrays of struct(s, k, e, m), by start; k is the place
    of the kind in KINDS, 3 for the models'.

    Places are in code points, ends exclusive.  An added span meets no base span.  Null text: none.
    """
    given = apart(docs, "doc_id", "text")
    own = given.columns
    clean = given.withColumn("scan_text", F.translate(F.coalesce("text", F.lit("")), MARK, STAND_IN))
    found = clean.select(*own, *(F.expr(_matches("scan_text", rx, k, cond)).alias(f"scan_{k}") for k, (_, rx, cond) in enumerate(KINDS)), F.expr(_matches("scan_text", CANDIDATE, len(KINDS), "true")).alias("scan_more"))
    base = found.withColumn("base", F.expr("array_sort(concat(" + ",".join(f"scan_{k}" for k in range(len(KINDS))) + "))"))
    scored = base.withColumn("scan_ratios", F.expr("array(" + ",".join(f"{x:.6f}D" for x in llr) + ")"))
    step = f"element_at(scan_ratios, {SIZE} * (ascii(substr(t.m, i, 1)) - {LOW}) + ascii(substr(t.m, i + 1, 1)) - {LOW} + 1)"
    ratio = f"aggregate(sequence(1, length(t.m) - 1), 0D, (z, i) -> z + {step})"
    random = _bound(ratio, "r", f"r > {LEAST_SUM}D AND r > {THRESHOLD}D * (length(t.m) - 1)")
    return scored.select(*own, "base", F.expr(f"filter(scan_more, t -> NOT exists(base, b -> b.s < t.e AND t.s < b.e) AND {random})").alias("added"))


def joined(found: Column) -> Column:
    names = ",".join(f"'{k}'" for k, *_ in KINDS) + ",'markov'"
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", F.element_at(F.expr(f"array({names})"), x.k + 1), x.s.cast("string"), x.e.cast("string"))))


def summary(docs: DataFrame, llr: list[float]) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of every text.  A map over the scan.

    Null text: empty, without spans; null doc_ids stay null; repeated rows give repeated results; an empty table gives no row;
    further columns are not read.
    """
    found = _spans(docs.select("doc_id", "text"), llr)
    count = lambda k: F.size(F.filter("base", lambda x: x.k == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.expr("array_sort(concat(base, added))")).alias("spans"), F.size("added").cast("long").alias("n_markov"))


def redacted(docs: DataFrame, llr: list[float]) -> DataFrame:
    """docs with each span of text, or union of overlapping ones, replaced by REDACTED; n_chars follows, if there is one.

    All rows stay; every other column keeps its values, whatever its name; null text stays null.
    """
    kinds = dict(docs.dtypes)
    found = _spans(docs, llr).withColumn("found", F.expr("array_sort(concat(base, added))"))
    fold = f"aggregate(found, named_struct('at', 0, 'out', CAST(array() AS ARRAY<STRING>)), (a, x) -> named_struct('at', greatest(a.at, x.e), 'out', IF(x.s < a.at, a.out, concat(a.out, array(substr(text, a.at + 1, x.s - a.at), '{REDACTED}')))), a -> array_join(concat(a.out, array(substr(text, a.at + 1))), ''))"
    new = together(found.withColumn("text", F.expr(f"IF(size(found) = 0, text, {fold})")), docs.columns, ("doc_id", "text"))
    return new.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kinds["n_chars"])) if "n_chars" in kinds else new
