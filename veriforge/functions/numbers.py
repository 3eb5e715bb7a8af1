"""The reader's functions over columns: Arrow batches in, Arrow arrays out."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import reader as R

HIT = "struct<start:int,end:int,raw:string,normalized:string,unit:string,role:string,context:string>"
_HIT = pa.struct([("start", pa.int32()), ("end", pa.int32()), *((c, pa.string()) for c in ("raw", "normalized", "unit", "role", "context"))])
_STRINGS = pa.list_(pa.string())


def over(f: Callable, result: str, kind: pa.DataType) -> Callable[..., Column]:
    """f, a function of plain values, as a function of columns."""

    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([f(*row) for row in zip(*(c.to_pylist() for c in columns), strict=True)], kind)

    forms: list[Callable] = [lambda a: run(a), lambda a, b: run(a, b), lambda a, b, c: run(a, b, c)]
    for g, names in zip(forms, ("a", "ab", "abc"), strict=True):
        g.__annotations__ = {**dict.fromkeys(names, pa.Array), "return": pa.Array}
    return lambda *columns: F.arrow_udf(forms[len(columns) - 1], result)(*columns)


def hit(h: R.Hit) -> dict:
    return h._asdict()


_numbers = over(lambda t, locale: [hit(h) for h in R.numbers(t, locale)], f"array<{HIT}>", pa.list_(_HIT))
#: Keys cited in a text, repeats included: numeric ones expanded as [k], author-date ones in canonical form.
citations = over(R.citations, "array<string>", _STRINGS)
composed = over(R.visible, "string", pa.string())
plain_name = over(R.plain_name, "string", pa.string())
folded = over(R.folded, "string", pa.string())
is_references_heading = over(R.is_references_heading, "boolean", pa.bool_())
looks_like_reference = over(R.looks_like_reference, "boolean", pa.bool_())
opens_entry = over(R.opens_entry, "boolean", pa.bool_())
closes_references = over(lambda t: bool(R.G.AFTER_REFERENCES.match(t or "")), "boolean", pa.bool_())
opens_note = over(lambda t: bool(R.G.NOTE_OPENS.match(t or "")), "boolean", pa.bool_())
reference_index = over(lambda t: dict(zip(("index", "body"), R.reference_index(t), strict=True)), "struct<index:int,body:string>", pa.struct([("index", pa.int32()), ("body", pa.string())]))
reference_entries = over(lambda parts: R.reference_entries(parts or []), "array<string>", _STRINGS)
#: Runs of Arabic and other script; neutral characters stay with the run before them.
script_runs = over(lambda t: [{"text": s, "arabic": a} for s, a in R.script_runs(t)], "array<struct<text:string,arabic:boolean>>", pa.list_(pa.struct([("text", pa.string()), ("arabic", pa.bool_())])))
inline_runs = over(
    lambda t, lang: [dict(zip(("text", "rtl", "bold", "italic"), r, strict=True)) for r in R.inline_runs(t, lang)],
    "array<struct<text:string,rtl:boolean,bold:boolean,italic:boolean>>",
    pa.list_(pa.struct([("text", pa.string()), *((c, pa.bool_()) for c in ("rtl", "bold", "italic"))])),
)
has_arabic = over(R.has_arabic, "boolean", pa.bool_())
mostly_latin = over(R.mostly_latin, "boolean", pa.bool_())
same_place = over(R.same_place, "boolean", pa.bool_())


def numbers(t: Column, locale: str | Column) -> Column:
    """Hits of text t by start: struct(start, end, raw, normalized, unit, role, context); the locale may differ by row."""
    return _numbers(t, locale if isinstance(locale, Column) else F.lit(locale))


def term_counts(t: Column, terms: list[str]) -> Column:
    """How often each of the terms stands in text t; both sides are folded.  The list travels with the function, so it must be
    a glossary's, not a table's."""
    if len(terms) > 10_000:
        raise ValueError("join a table of so many terms instead")

    def counts(text: str | None) -> list[int]:
        plain = R.folded(text)
        return [R.term_count(x, plain) for x in terms]

    return over(counts, "array<int>", pa.list_(pa.int32()))(t)
