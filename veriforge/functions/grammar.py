"""Patterns of figures, citations and references, put together from the fixed values by a few rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from . import vocabulary as V


def bare(text: str) -> str:
    """Without the accents that writers leave out."""
    return text.translate(str.maketrans("éèûÉÈÛ", "eeuEEU"))


def any_of(words: Iterable[str], loose_stop: bool = False, loose_accents: bool = False) -> str:
    """One of the words, longest first.  White space in them is any; a last * stands for any ending.  With loose_stop a last full
    stop may be missing, with loose_accents any accent of é, è and û."""

    def one(w: str) -> str:
        stem, ending = (w[:-1], r"\.?") if loose_stop and w.endswith(".") else (w[:-1], r"\w*") if w.endswith("*") else (w, "")
        out = r"\s+".join(map(re.escape, stem.split())) + ending
        return "".join(f"[{c}{bare(c)}]" if bare(c) != c else c for c in out) if loose_accents else out

    return "(?:" + "|".join(one(w) for w in sorted(words, key=len, reverse=True)) + ")"


def one_of(characters: str) -> str:
    return "[" + re.escape(characters) + "]"


def not_after(*what: str) -> str:
    return "".join(f"(?<!{w})" for w in what)


def not_before(*what: str) -> str:
    return "".join(f"(?!{w})" for w in what)


def listed(item: str, joint: str, least: int = 1) -> str:
    """At least `least` items with a joint between each two."""
    return f"{item}(?:{joint}{item}){{{least - 1},}}"


def _characters(ranges: Iterable[tuple[int, int]]) -> str:
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]"


NO_TEXT = re.compile(_characters(V.NO_TEXT))
WESTERN = str.maketrans(V.ARABIC_DIGITS + V.PERSIAN_DIGITS, "0123456789" * 2)

DIGITS, YEAR = r"\d+", r"(?:19|20)\d{2}"
LETTER = r"[^\W\d_]"
CAPITAL = "[A-ZÀ-ÝŒ]"
ALONE = not_after(r"[\w.,]")

# -- what looks like a figure but is none

#: Beginnings of addresses that end with the word they stand in.
ADDRESS_OPENS = re.compile(r"https?://(?=\S)|www\.(?=\S)", re.I)
DOI_LABEL = re.compile(r"\bdoi\s*:\s*\S+", re.I)
DOI = re.compile(r"\b10\.\d{4,9}/[^\s\"<>]+")
HOST_AND_PATH = re.compile(r"\b" + listed(r"[\w-]+", r"\.") + r"\." + any_of(V.DOMAINS) + r"/\S+", re.I)
DIGEST = re.compile(r"\b[0-9a-f]{32,}\b")
SECTION_NUMBER = re.compile(ALONE + listed(DIGITS, r"\.", 3) + not_before(r"\w"))

# -- citations in brackets, and lists

KEY = r"\d{1,3}"
KEYS = re.compile(r"\[(" + listed(KEY, rf"\s*[,;{V.DASHES}]\s*") + r")\]")
ENTRY = r"\d{1,4}(?:[-–]\d{1,4})?"
COMMA_LIST = re.compile(not_after(r"[\d,.]") + listed(ENTRY, ",", 3) + not_before(r"[\d,]", r"\.\d"))
COMMA_AFTER_SPACE = re.compile(r",(?<=\s,)")
SPACED_COMMA = re.compile(r"\s+,(?=\d)")

# -- dates

_DAY, _YEAR4, _PART = r"\d{1,2}", r"\d{4}", "[-/.]"
DATE_IN_FIGURES = re.compile(ALONE + f"(?:{_YEAR4}{_PART}{_DAY}{_PART}{_DAY}|{_DAY}{_PART}{_DAY}{_PART}{_YEAR4})" + not_before(r"\w"))
MONTH_NUMBER = {bare(w.rstrip(".")): k for k, names in V.MONTHS.items() for w in names}
_MONTH = any_of([w for names in V.MONTHS.values() for w in names], loose_stop=True, loose_accents=True)
_DAY_FIRST = rf"(?P<day>{_DAY}){any_of(V.DAY_ORDINALS)}?\s+(?P<month>{_MONTH})\s+(?P<year>{YEAR})"
_MONTH_FIRST = rf"(?P<month2>{_MONTH})\s+(?P<day2>{_DAY}){any_of(['st', 'nd', 'rd', 'th'])}?,?\s+(?P<year2>{YEAR})"
DATE_IN_WORDS = re.compile(ALONE + f"(?:{_DAY_FIRST}|{_MONTH_FIRST})" + not_before(r"\w"), re.I)

# -- figures

_SIGN = f"(?:{not_after(chr(92) + 'w')}{one_of(V.MINUS)})?"
_BARE_DECIMAL = rf"(?:(?<={one_of('=<>≤≥(:;/[')})|(?<!\S))[.,]\d+"
_NO_LABEL = not_before(r"[\d_@]", any_of(V.ITEM_LABELS) + not_before("[a-zà-ÿ]"))


def figure(group: str, decimal: str, ordinal: bool) -> re.Pattern:
    """A figure with these group and decimal separators; an ordinal suffix follows outside of the group `num`."""
    whole = rf"(?:\d{{1,3}}(?:{one_of(group)}\d{{3}})+|\d+)"
    suffix = f"{any_of(V.ORDINALS)}?" if ordinal else ""
    return re.compile(not_after("[0-9_]", r"\d[,.]") + f"(?P<num>{_SIGN}{whole}(?:{one_of(decimal)}\\d+)?|{_BARE_DECIMAL}){suffix}{_NO_LABEL}")


FIGURES = {"fr": figure(V.GROUP_FR, ",.", True), "en": figure(V.GROUP_EN, "." + V.ARABIC_DECIMAL, True), "ar": figure(V.GROUP_EN, "." + V.ARABIC_DECIMAL, False)}
#: Every character that a figure may begin with: found first, it spares a try at each letter.
FIGURE_OPENS = re.compile(rf"[\d.,{re.escape(V.MINUS)}]")
PERCENT = re.compile(f"{one_of(V.GROUP_FR)}?[%{V.ARABIC_PERCENT}]")


#: The statistics sign that has digits.
NINETY_FIVE = re.compile(r"95\s*%")
FOUR_DIGITS = re.compile(r"\d{4}")


def _arabic(words: list[str]) -> str:
    """The words with or without the article: all but the first of a phrase, or the only one."""
    article = f"(?:{V.ARABIC_ARTICLE})?"
    return article + words[0] if len(words) == 1 else words[0] + "".join(rf"\s+{article}{w}" for w in words[1:])


STATISTICS = [
    re.compile(rf"\b{any_of(V.STATISTICS_ACRONYMS)}\b|{NINETY_FIVE.pattern}|±"),
    re.compile(
        "|".join(
            [
                any_of(V.STATISTICS_WORDS).replace(r"\-", "[- ]"),
                rf"\b{any_of(V.STATISTICS_WHOLE_WORDS)}\b",
                rf"{any_of(V.STATISTICS_WORD_ENDS)}\b",
                rf"\b{any_of(V.STATISTICS_WORD_STARTS)}\b",
                *map(_arabic, V.STATISTICS_ARABIC),
                any_of(V.STATISTICS_ARABIC_PLAIN),
            ]
        ),
        re.I,
    ),
]

# -- citations by author and year

_NAME_WORD = rf"{CAPITAL}(?:{LETTER}|['’\-](?={LETTER}))+"
_OTHERS = rf"(?:et\s+al\.?|و\s?{V.ARABIC_AND_OTHERS})"
_AUTHORS = listed(_NAME_WORD, rf"\s+{any_of(V.CITATION_JOINERS)}\s+") + rf"(?:\s+{_OTHERS})?"
_CITED = rf"{_AUTHORS}\s*,?\s*{YEAR}[a-z]?"
IN_PARENTHESES = re.compile(r"\((" + listed(f"(?:{_CITED})", r"\s*;\s*") + r")\)")
IN_RUNNING_TEXT = re.compile(not_after(r"[\w'’\-]") + rf"({_AUTHORS})\s*\(\s*({YEAR}[a-z]?)\s*\)")
OTHERS = re.compile(rf"\s*(?:\bet\s+al\.?|و\s?{V.ARABIC_AND_OTHERS})\s*", re.I)
JOINER = re.compile(rf"\s+{any_of(V.CITATION_JOINERS)}\s+" + not_before(r"al\b"))
LAST_YEAR = re.compile(rf"\s*,?\s*({YEAR}[a-z]?)$")

# -- headings and reference entries

_NUMBERED = r"^\s*(?:\d{1,2}[.)]?\s*)?"
_ITEM = r"^\s*(?:[A-Za-z]|\d{1,2})?[.)]?\s*"
_ARABIC_LIST = rf"(?:{V.REFERENCE_ARABIC_LIST}\s+)?{V.REFERENCE_ARABIC}"
REFERENCES_HEADING = re.compile(_NUMBERED + any_of(V.REFERENCE_HEADINGS, loose_accents=True) + r"\s*:?\s*$", re.I)
REFERENCES_OPEN = re.compile(_ITEM + rf"(?:{any_of(V.REFERENCE_WORDS, loose_accents=True)}|{V.REFERENCE_STEM}\w*|{_ARABIC_LIST})\b", re.I)
REFERENCES_CLOSE = re.compile(_ITEM + rf"[^\d()]{{0,30}}?(?<!\w)(?:{any_of(V.REFERENCE_WORDS, loose_accents=True)}|{V.REFERENCE_STEM}\w*|{V.REFERENCE_ARABIC})\s*:?\s*$", re.I)
ANNEX_OPENS = re.compile(_NUMBERED + any_of(V.ANNEXES, loose_accents=True) + r"\b", re.I)
AFTER_REFERENCES = re.compile(_NUMBERED + any_of(V.AFTER_REFERENCES, loose_accents=True) + r"\b", re.I)
NOTE_OPENS = re.compile(r"^\s*" + any_of(V.NOTES) + r"\b", re.I)

BULLET = rf"(?:{one_of(V.BULLETS)}+\s*|o\s+)"
LEADING_BULLET = re.compile(r"^\s*" + BULLET)
_INDEX_ENDS = r"(?:[.)]\s*|\s+)"
INDEX = re.compile(rf"^\s*{BULLET}?\[?(\d{{1,3}})([a-d])?\]?{_INDEX_ENDS}(?=[^\d\s])")
_PARTICLES = rf"(?:(?i:{any_of(V.PARTICLES)})[\s'’]*)"
_SURNAME = rf"{CAPITAL}[\w'’\-À-ÿ]*(?:[\s-]+{_PARTICLES}?{CAPITAL}[\w'’\-À-ÿ]*)*"
_INITIALS_FIRST = rf"{_SURNAME}\s+{CAPITAL}{{1,4}}\b(?:[.,;]|\s+(?:et\s+al|and|&|و{V.ARABIC_AND_OTHERS}))"
_INITIALS_AFTER_COMMA = rf"{_SURNAME},\s*{CAPITAL}\.?(?:\s*-?\s*{CAPITAL}\.?)*[,.;&\s]"
_ORGANISATION = rf"{CAPITAL}[\w'’\-À-ÿ]+(?:\s+(?:{CAPITAL}[\w'’\-À-ÿ]+|{any_of(V.ORGANISATION_WORDS)}))*\s*(?:\([A-Z]+\))?\s*(?:\.|\(\s*{YEAR}[a-z]?\s*\))"
AUTHOR_OPENS = re.compile(rf"^\s*{BULLET}?(?:\[?\d{{1,3}}[a-d]?\]?{_INDEX_ENDS})?{_PARTICLES}*(?:{_INITIALS_FIRST}|{_INITIALS_AFTER_COMMA}|{_ORGANISATION})")
WHOLE_YEAR = re.compile(not_after(r"\d") + YEAR + not_before(r"\d"))
LINKED = re.compile(r"\bdoi\b|https?://|\b10\.\d{4,9}/", re.I)
AND_OTHERS = re.compile(r"\bet\s+al\b", re.I)
VOLUME_AND_PAGES = re.compile(r"\d{1,4}\s*\(\d{1,3}\)|\d+\s*[–-]\s*\d+\.?$")

TABLE_LABEL = re.compile(r"^\s*(" + any_of(V.TABLE_LABELS) + r")\s*(\d+[a-z]?)\b", re.I)
FIGURE_LABEL = re.compile(r"^\s*(" + any_of(V.FIGURE_LABELS) + r")\s*(\d+[a-z]?)\b", re.I)

# -- titles

TITLE_NUMBER = re.compile(r"^\s*\d{1,2}(?:\.\d{1,2}){0,3}[.)]?\s*")
MANY_LEVELS = re.compile(rf"^\s*\d{{1,2}}(?:\.\d{{1,2}}){{1,3}}\.?\s+{LETTER}")
TITLE_LABEL = re.compile(r"^\s*" + any_of(V.TITLE_LABELS, loose_accents=True) + r"\s+(?:\d{1,2}|[IVX]{1,5})\s*[:.\-–—]?\s*", re.I)
STATISTIC_SIGN = re.compile(r"[%=<>±≤≥]|\bp\s*[<=>]|\b[nN]\s*=|\(\s*\d|\d\s*\)")
SENTENCE_BREAK = re.compile(rf"[.!?]\s+{CAPITAL}")
GENERIC_TITLE = r"(?iu)^\s*" + any_of(V.GENERIC_TITLES) + r"\s*\d*\s*$"
