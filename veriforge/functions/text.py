"""Scalar text functions as native Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import grammar as G
from . import vocabulary as V

MARK = "\ue000"


def java(rx: re.Pattern) -> str:
    """A pattern of `grammar` for Spark's functions."""
    return ("(?iuU)" if rx.flags & re.I else "(?U)") + rx.pattern


def segments(t: Column, rx: str) -> Column:
    """Text between and inside the matches of rx, in turn; odd places are matches.  t holds no private-use character."""
    return F.split(F.regexp_replace(t, f"({rx})", f"{MARK}$1{MARK}"), MARK)


def rewritten(t: Column, rx: str, new: Callable[[Column, Column, Column], Column]) -> Column:
    """t with each match replaced by new(match, text before it, text after it)."""

    def each(segs: Column) -> Column:
        new_text = F.array_join(F.transform(segs, lambda s, i: F.when(i % 2 == 1, new(s, F.array_join(F.slice(segs, F.lit(1), i), ""), F.array_join(F.slice(segs, i + 2, F.size(segs)), ""))).otherwise(s)), "")
        return F.when(F.size(segs) < 2, F.get(segs, F.lit(0))).otherwise(new_text)

    # bound by a lambda, so that t is evaluated once however deep the rewritings are nested
    return F.get(F.transform(F.array(segments(t, rx)), each), F.lit(0))


def blanked(t: Column, rx: str) -> Column:
    """Matches become as many spaces, so places stay."""
    return rewritten(t, rx, lambda s, b, a: F.repeat(F.lit(" "), F.length(s)))


def visible(t: Column) -> Column:
    """Without bidi controls, zero-width and soft-hyphen characters and private-use glyphs."""
    return F.regexp_replace(F.coalesce(t, F.lit("")), java(G.NO_TEXT), "")


def western_digits(t: Column) -> Column:
    return F.translate(t, V.ARABIC_DIGITS + V.PERSIAN_DIGITS, "0123456789" * 2)


def normalized_number(raw: Column, locale: str) -> Column:
    """Canonical decimal string: precision as written, no leading zeros, sign kept."""
    bare = F.regexp_replace(F.trim(raw), G.any_of(V.ORDINALS) + "$", "")
    if locale == "fr":
        bare = F.translate(F.regexp_replace(bare, G.one_of(V.GROUP_FR), ""), ",", ".")
    else:
        bare = F.translate(F.regexp_replace(bare, G.one_of(V.GROUP_EN + " "), ""), V.ARABIC_DECIMAL, ".")
    sign = F.when(bare.rlike("^[-\u2212]"), "-").otherwise("")
    bare = F.regexp_replace(bare, "^[-\u2212]", "")
    whole, part = F.split_part(bare, F.lit("."), F.lit(1)), F.split_part(bare, F.lit("."), F.lit(2))
    whole = F.regexp_replace(whole, r"^0+(?=\d)", "")
    return F.concat(sign, F.when(whole == "", "0").otherwise(whole), F.when(part == "", "").otherwise(F.concat(F.lit("."), part)))


def without_bullet(t: Column) -> Column:
    return F.regexp_replace(F.trim(t), java(G.LEADING_BULLET), "")


def doi(t: Column) -> Column:
    d = F.regexp_replace(F.regexp_extract(t, "(10\\.\\d{4,9}/[^\\s\"<>]+)", 1), "[.;,]+$", "")
    return F.when(d != "", d)


def table_label(t: Column) -> Column:
    return F.regexp_extract(t, java(G.TABLE_LABEL), 2)


def figure_label(t: Column) -> Column:
    return F.regexp_extract(t, java(G.FIGURE_LABEL), 2)


def filled_rows(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda r: F.exists(r, lambda c: F.trim(c) != "")))


def is_rule_row(row: Column) -> Column:
    """A Markdown rule line; a row of empty cells is a real one."""
    said = F.filter(row, lambda c: F.trim(c) != "")
    return (F.size(said) > 0) & F.forall(said, lambda c: F.trim(c).rlike("^:?-{2,}:?$"))


def expanded_keys(inner: Column) -> Column:
    """1,3-5 -> 1 3 4 5; a range must ascend by less than 60, a malformed part is left out."""

    def part(p: Column) -> Column:
        ends = F.split(F.regexp_replace(p, r"(?U)\s", ""), "[-\u2013\u2014]")
        a, b = F.element_at(ends, 1).try_cast("int"), F.element_at(ends, -1).try_cast("int")
        ok = a.isNotNull() & b.isNotNull() & (a <= b) & (b - a < 60) & (F.size(ends) <= 2)
        return F.when(ok, F.transform(F.sequence(a, F.when(ok, b).otherwise(a)), lambda k: k.cast("string"))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.split(inner, "[,;]"), part))


def verification_code(prefix: str, *fields: Column) -> Column:
    h = F.upper(F.substring(F.sha2(F.concat_ws("|", F.lit(prefix), *fields), 256), 1, 10))
    return F.concat(F.substring(h, 1, 5), F.lit("-"), F.substring(h, 6, 5))
