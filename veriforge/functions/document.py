"""One document as blocks in order: reading them from Markdown, finding the reference list, and taking out the facts.

Pure functions of one document; `structure` and `ledger` run them over columns.  Nothing here looks at another document, so
a table of documents is read without any shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from typing import NamedTuple

from . import grammar as G
from . import reader as R

LIST_ITEM = re.compile(r"^\s*([-*•]|\d+[.)])\s+(.*)$")


class Block(NamedTuple):
    kind: str  # heading, paragraph, table (or error, of a file that can't be read)
    text: str
    section: str
    style: str | None = None
    cells: list[list[str]] | None = None


def is_rule(row: list[str]) -> bool:
    """A Markdown rule line; a row of empty cells is a real one."""
    filled = [c for c in row if c]
    return bool(filled) and all(re.fullmatch(":?-{2,}:?", c) for c in filled)


def filled_rows(cells: Iterable[Iterable[str]]) -> int:
    return sum(any((c or "").strip() for c in row) for row in cells)


def table_text(cells: list[list[str]]) -> str:
    return "\n".join("\t".join(row) for row in cells)


def _kind(line: str) -> str:
    if not line.strip():
        return "blank"
    return "heading" if line.startswith("#") else "table" if line.lstrip().startswith("|") else "item" if LIST_ITEM.match(line) else "text"


def _row(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def markdown_blocks(text: str | None) -> list[Block]:
    """A heading begins with #; lines that begin with | are a table; a list item is a paragraph; other lines join up to a blank
    one."""
    out: list[Block] = []
    section, before = "", "blank"
    for line in (text or "").splitlines():
        line, kind = line.rstrip(), _kind(line)
        if kind == "heading":
            section = line.lstrip("#").strip()
            out.append(Block("heading", R.visible(section), section))
        elif kind == "table":
            if before != "table":
                out.append(Block("table", "", section, None, []))
            if not is_rule(row := [R.visible(c) for c in _row(line)]):
                out[-1].cells.append(row)
        elif kind == "item":
            out.append(Block("paragraph", R.visible(line.strip()), section))
        elif kind == "text":
            if before == "text":
                out[-1] = out[-1]._replace(text=out[-1].text + "\n" + R.visible(line))
            else:
                out.append(Block("paragraph", R.visible(line), section))
        before = kind
    return [b._replace(text=table_text(b.cells)) if b.kind == "table" else b for b in out]


def front_matter(text: str | None) -> tuple[dict[str, str], list[dict]]:
    """(fields, typesetting blocks) of a Markdown text that may begin with key: value lines between rules."""
    lines = (text or "").splitlines()
    fields: dict[str, str] = {}
    if lines and lines[0].strip() == "---":
        end = next((i for i, x in enumerate(lines[1:], 1) if x.strip() == "---"), len(lines))
        for x in lines[1:end]:
            if m := re.match(r"^\s*([A-Za-z_]+)\s*:\s*(.*)$", x):
                fields[m[1].lower()] = m[2].strip()
        lines = lines[end + 1 :]
    out: list[dict] = []
    before = "blank"
    for line in (x.rstrip() for x in lines):
        heading, picture = re.match(r"^(#{1,4})\s+(.*)$", line), re.match(r"^!\[(.*?)\]\((.*?)\)\s*$", line)
        item = LIST_ITEM.match(line)
        if not line.strip():
            kind = "blank"
        elif line.strip() == "<<<pagebreak>>>":
            kind = "pagebreak"
            out.append({"kind": kind})
        elif heading:
            kind = "heading"
            out.append({"kind": kind, "level": len(heading[1]), "text": heading[2].strip()})
        elif picture:
            kind = "figure"
            out.append({"kind": kind, "text": picture[1], "path": picture[2]})
        elif line.lstrip().startswith("|"):
            kind = "table"
            if before != kind:
                out.append({"kind": kind, "cells": []})
            if not is_rule(row := _row(line)):
                out[-1]["cells"].append(row)
        elif item:
            kind = "list"
            if before != kind:
                out.append({"kind": kind, "numbered": item[1][0].isdecimal(), "items": []})
            out[-1]["items"].append(item[2].strip())
        else:
            kind = "paragraph"
            if before == kind:
                out[-1]["text"] += " " + line.strip()
            else:
                out.append({"kind": kind, "text": line.strip()})
        before = kind
    return fields, out


def in_references(blocks: list[Block]) -> list[bool]:
    """Which blocks are entries of the reference list.

    It opens at its heading and ends at a heading, a table, or the first paragraph that neither looks like an entry nor is
    followed, within two paragraphs, by one.  Notes in it are body text.
    """
    inside, seen, out = False, 0, []
    for i, b in enumerate(blocks):
        if b.kind != "paragraph":
            inside, seen = b.kind == "heading" and R.is_references_heading(b.text), 0
            out.append(False)
            continue
        if inside and R.looks_like_reference(b.text):
            seen += 1
            out.append(True)
        elif inside and not G.AFTER_REFERENCES.match(b.text) and _goes_on(blocks[i + 1 : i + 3]):
            out.append(bool(seen) and not G.NOTE_OPENS.match(b.text))
        else:
            inside = False
            out.append(False)
    return out


def _goes_on(following: list[Block]) -> bool:
    for b in following:
        if b.kind != "paragraph":
            return False
        if R.opens_entry(b.text):
            return True
    return False


def _parts(blocks: list[Block], locale: str | None) -> tuple[str, list[dict], list[str]]:
    """A target's body, tables and reference entries."""
    body, tables, entries = [], [], []
    for b, listed in zip(blocks, in_references(blocks), strict=True):
        if b.kind == "table":
            tables.append(_read_table(b, locale))
            body.append(b.text)
        elif listed:
            entries.append(b.text.strip())
        elif b.kind == "paragraph":
            text = b.text
            for label in (G.TABLE_LABEL, G.FIGURE_LABEL):
                text = label.sub(lambda m: " " * len(m[0]), text)
            body.append(text)
    return "\n".join(body), tables, R.reference_entries(entries)


def _read_table(b: Block, locale: str | None) -> dict:
    return {"values": [h.normalized for row in b.cells for c in row for h in R.numbers(c, locale)], "n_rows": len(b.cells), "filled_rows": filled_rows(b.cells)}


def reading(blocks: list[Block], locale: str | None) -> dict:
    """What a target document says: numbers and citations of its body, numbers and rows of each table, reference entries."""
    text, tables, entries = _parts(blocks, locale)
    return {"body": text, "numbers": [h._asdict() for h in R.numbers(text, locale)], "tables": tables, "entries": entries, "citations": R.citations(text)}


def read_tables(blocks: list[Block], locale: str | None) -> list[dict]:
    """The tables of `reading` alone."""
    return [_read_table(b, locale) for b in blocks if b.kind == "table"]


def read_values(blocks: list[Block], locale: str | None) -> dict:
    """The values, tables and entries of `reading`: what a verdict is made of."""
    text, tables, entries = _parts(blocks, locale)
    return {"found": [h.normalized for h in R.numbers(text, locale)], "tables": tables, "entries": entries}


FIELDS = ["kind", "id", "section", "paragraph_index", "raw", "normalized", "unit", "role", "context", "label", "caption", "n_rows", "n_cols", "header", "cells", "values", "key", "occurrences", "index", "text", "doi", "extracted_by"]
_NOTHING = dict.fromkeys(FIELDS)
KINDS = frozenset({"number", "table", "figure", "reference", "citation"})


def items(blocks: list[Block], locale: str | None, prefix: str | None, kinds: frozenset[str] = KINDS, plain: list[R.Hit] | None = None) -> list[dict]:
    """The ledger items of one paper in encounter order, then references, then citations by length and key.  Of other kinds than the
    given ones nothing is read; no item depends on another kind's.  With a list as plain, numbers go there as they were read."""
    out: list[dict] = []
    count: Counter = Counter()
    cited: Counter = Counter()
    entries: list[str] = []
    label = caption = None
    paragraph = 0

    def add(kind: str, code: str, **fields) -> None:
        count[code] += 1
        out.append({**_NOTHING, "kind": kind, "id": f"{prefix}-{code}-{count[code]:04d}", "extracted_by": "script", **fields})

    for i, (b, listed) in enumerate(zip(blocks, in_references(blocks), strict=True)):
        if b.kind == "paragraph":
            paragraph += 1
            if listed:
                entries.append(b.text)
                continue
            table, figure = G.TABLE_LABEL.match(b.text), G.FIGURE_LABEL.match(b.text)
            hits = R.numbers(b.text, locale) if "number" in kinds or (figure and "figure" in kinds) else []
            if table:
                label, caption = f"{table[1].capitalize()} {table[2]}", b.text.strip()
            if figure and "figure" in kinds:
                values = [h.normalized for h in hits]
                own = bool(values) and values[0] == R.normalized_number(figure[2], locale or "en")
                add("figure", "F", section=b.section, label=f"Figure {figure[2]}", caption=b.text.strip(), values=values[own:])
            if "citation" in kinds:
                cited.update(R.citations(b.text))
            counted = hits[1 if table or figure else 0 :] if "number" in kinds else []
            if plain is not None:
                plain += counted
                continue
            for h in counted:
                add("number", "N", section=b.section, paragraph_index=paragraph, raw=h.raw, normalized=h.normalized, unit=h.unit, role=h.role, context=h.context.strip())
        elif b.kind == "table":
            following = blocks[i + 1] if i + 1 < len(blocks) else None
            if label is None and following and following.kind == "paragraph" and (m := G.TABLE_LABEL.match(following.text)):
                label, caption = f"{m[1].capitalize()} {m[2]}", following.text.strip()
            cells = [c for row in b.cells for c in row]
            if "citation" in kinds:
                for c in cells:
                    cited.update(R.citations(c))
            if "table" in kinds:
                values = [h.normalized for c in cells for h in R.numbers(c, locale)]
                add("table", "T", section=b.section, label=label or f"(table sans légende #{count['T'] + 2})", caption=caption, n_rows=len(b.cells), n_cols=max(map(len, b.cells), default=0), header=b.cells[0] if b.cells else [], cells=b.cells, values=values)
            label = caption = None
    for n, entry in enumerate(R.reference_entries(entries) if "reference" in kinds else (), 1):
        index, body = R.reference_index(entry)
        add("reference", "REF", index=n if index is None else index, text=body, doi=R.doi(body))
    for key in sorted(cited, key=lambda k: (len(k), k)):
        add("citation", "C", key=key, occurrences=cited[key])
    return out


def _held(x: dict) -> dict:
    return {"id": x["id"], "label": x["label"], "rows_src": filled_rows(x["cells"]), "values": x["values"]}


def own_tables(blocks: list[Block], locale: str | None, prefix: str | None) -> list[dict]:
    """A paper's tables as its translation is held against them: id, label, rows with text, values."""
    return [_held(x) for x in items(blocks, locale, prefix, frozenset({"table"}))]


def own_facts(blocks: list[Block], locale: str | None, prefix: str | None) -> tuple[list[R.Hit], list[dict], list[str]]:
    """A paper's numbers, tables (see `own_tables`) and reference entries, of which its translation's verdict is made."""
    numbers: list[R.Hit] = []
    found = items(blocks, locale, prefix, frozenset({"number", "table", "reference"}), numbers)
    return numbers, [_held(x) for x in found if x["kind"] == "table"], [x["text"] for x in found if x["kind"] == "reference"]


def dump(blocks: list[Block]) -> str:
    """The document as text that `markdown_blocks` reads back: headings with ##, one paragraph for each reference entry."""
    out = []
    for b, listed in zip(blocks, in_references(blocks), strict=True):
        if b.kind == "heading":
            out.append(f"\n## {b.text}\n")
        else:
            out += [f"{e}\n" for e in (R.reference_entries([b.text]) if listed and "\n" in b.text else [b.text])]
    return "\n".join(out) + ("\n" if out else "")


# -- headings of word-processor files


def carries_statistics(text: str) -> bool:
    """A figure beyond a section number or a title's label, in a long line or next to a sign of statistics."""
    rest = G.TITLE_LABEL.sub("", G.TITLE_NUMBER.sub("", text.strip()))
    return re.search(r"\d", rest) is not None and (len(text.strip()) > 90 or G.STATISTIC_SIGN.search(rest) is not None)


def looks_like_heading(text: str, style: str, all_bold: bool) -> bool:
    """By its style, or as a short line without figures that is all bold or opens with a section number of several levels."""
    if style.lower().startswith(("heading", "titre", "title")):
        return True
    text = text.strip()
    if not text or len(text) > 90 or "\n" in text or re.search(r"\d", G.TITLE_LABEL.sub("", G.TITLE_NUMBER.sub("", text))):
        return False
    numbered, stopped = G.MANY_LEVELS.match(text) is not None, text.endswith((".", ";", ",", ":"))
    return (all_bold and (numbered or not stopped)) or (numbered and not stopped)


def classified(text: str, style: str, heading: bool) -> bool:
    """Whether a line is a heading after all, whatever its style: the name of a closing section is, a result or an entry is not."""
    t = text.strip()
    if not heading and len(t) <= 60 and not t.endswith((".", ";", ",")):
        heading = R.is_references_heading(t) or G.ANNEX_OPENS.match(t) is not None
    if heading and style.lower() not in ("title", "titre"):
        prose = len(t) > 160 and G.SENTENCE_BREAK.search(t)
        entry = len(t) >= 50 and R.opens_entry(t) and re.search(rf"{G.YEAR}|10\.\d{{4,9}}/", t)
        return not (prose or carries_statistics(t) or entry)
    return heading


def paragraph_blocks(text: str, style: str, heading: bool, section: str) -> list[Block]:
    """The blocks of one paragraph: a heading with a line break in it is a heading and a paragraph."""
    if not (t := text.strip()):
        return []
    head, _, rest = t.partition("\n")
    if heading and head.strip() and rest.strip():
        return [Block("heading", head.strip(), head.strip(), style), Block("paragraph", rest.strip(), head.strip())]
    return [Block("heading", t, t, style)] if classified(t, style, heading) else [Block("paragraph", text, section)]
