"""Word-processor, slide, Markdown and text files: one document a row, with its blocks."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import document as D
from ..functions import grammar as G
from ..functions import numbers as N
from ..functions import reader as R
from ..functions import vocabulary as V
from ..operators import structure

_UNSEEN = ("del", "delText", "Fallback", "moveFrom", "txbxContent", "instrText")
_PLAIN = {"tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-"}
_RAISED_KEYS = re.compile(r"\s*" + G.listed(G.KEY, rf"\s*[,;{V.DASHES}]\s*") + r"\s*")
_BROKEN_THOUSANDS = re.compile(r"(?<![\d,.])(\d{1,3})\n(\d{3})(?!\d)")
_UNIT_ENDS = re.compile(rf"(?:^|[^A-Za-zÀ-ÿ]){G.any_of(V.UNITS_BEFORE_RAISED)}\s?$")


def name_of(e: ElementTree.Element) -> str:
    """The tag without its namespace."""
    return e.tag.rpartition("}")[2]


def _attribute(e: ElementTree.Element | None, name: str) -> str:
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] == name), "") if e is not None else ""


def _child(e: ElementTree.Element | None, *path: str) -> ElementTree.Element | None:
    for name in path:
        e = next((x for x in e if name_of(x) == name), None) if e is not None else None
    return e


def _is_raised(run: ElementTree.Element) -> bool:
    return _attribute(_child(run, "rPr", "vertAlign"), "val") == "superscript"


def _parts(e: ElementTree.Element, raised: bool = False) -> Iterator[tuple[str, bool]]:
    """(text, raised) of what is visible in an element: insertions and fields count, deletions and fallbacks do not."""
    for x in e:
        kind = name_of(x)
        if kind == "t":
            yield x.text or "", raised
        elif kind in _PLAIN:
            yield _PLAIN[kind], False
        elif kind not in _UNSEEN:
            yield from _parts(x, _is_raised(x) if kind == "r" else raised)


def paragraph_text(p: ElementTree.Element, raised_keys: bool) -> str:
    """Visible text.  With raised_keys, raised figures are citation keys unless a unit or a digit stands before them."""
    out, held = "", ""
    for text, raised in [*_parts(p), ("", False)]:
        if raised and raised_keys:
            held += text
            continue
        if held:
            key = _RAISED_KEYS.fullmatch(held) and not _UNIT_ENDS.search(out) and not out[-1:].isdecimal()
            out += "[" + re.sub(r"\s", "", held).replace(";", ",") + "]" if key else held
            held = ""
        out += text
    return out


def cites_by_raised_figures(body: ElementTree.Element) -> bool:
    """Three raised runs of figures or more."""
    found = 0
    for run in (x for x in body.iter() if name_of(x) == "r"):
        found += _is_raised(run) and _RAISED_KEYS.fullmatch("".join(t.text or "" for t in run if name_of(t) == "t")) is not None
        if found == 3:
            return True
    return False


class _Word:
    def __init__(self, z: zipfile.ZipFile):
        self.body = _child(ElementTree.fromstring(z.read("word/document.xml")), "body")
        if self.body is None:
            raise KeyError("body")
        self.raised_keys = cites_by_raised_figures(self.body)
        self.styles = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")):
                if name_of(s) == "style":
                    self.styles[_attribute(s, "styleId")] = _attribute(_child(s, "name"), "val")

    def elements(self, parent: ElementTree.Element) -> Iterator[ElementTree.Element]:
        """Paragraphs and tables in order, content controls opened, text boxes after their paragraph, navigation left out."""
        for e in parent:
            kind = name_of(e)
            if kind == "tbl":
                yield e
            elif kind == "sdt":
                gallery = next((_attribute(x, "val").lower() for x in e.iter() if name_of(x) == "docPartGallery"), "")
                if not any(g in gallery for g in V.NAVIGATION_GALLERIES):
                    for x in e:
                        if name_of(x) == "sdtContent":
                            yield from self.elements(x)
            elif kind == "p":
                own = _attribute(_child(e, "pPr", "pStyle"), "val")
                if not any(x.lower().startswith(tuple(V.NAVIGATION_STYLES)) for x in (own, self.styles.get(own, ""))):
                    yield e
                    yield from self.boxes(e)

    def boxes(self, e: ElementTree.Element) -> Iterator[ElementTree.Element]:
        for x in e:
            if name_of(x) == "txbxContent":
                yield from (p for p in x if name_of(p) == "p")
            if name_of(x) != "Fallback":
                yield from self.boxes(x)

    def cells(self, table: ElementTree.Element) -> list[list[str]]:
        """A merged cell is read once; the places it covers are empty."""
        out = []
        for tr in (x for x in table if name_of(x) == "tr"):
            out.append([])
            for tc in (x for x in tr if name_of(x) == "tc"):
                properties = _child(tc, "tcPr")
                merged = _child(properties, "vMerge")
                text = "\n".join(paragraph_text(p, self.raised_keys) for p in tc.iter() if name_of(p) == "p")
                covered = merged is not None and _attribute(merged, "val") != "restart"
                out[-1].append("" if covered else R.visible(_BROKEN_THOUSANDS.sub(r"\1 \2", text)).strip())
                out[-1] += [""] * (int(_attribute(_child(properties, "gridSpan"), "val") or 1) - 1)
        return out

    def blocks(self) -> list[D.Block]:
        out: list[D.Block] = []
        section = ""
        for e in self.elements(self.body):
            if name_of(e) == "tbl":
                cells = self.cells(e)
                out.append(D.Block("table", D.table_text(cells), section, None, cells))
                continue
            own = _attribute(_child(e, "pPr", "pStyle"), "val")
            style = self.styles.get(own, own)
            runs = [r for r in e if name_of(r) == "r" and "".join(t for t, _ in _parts(r)).strip()]
            bold = [(b := _child(r, "rPr", "b")) is not None and _attribute(b, "val") not in ("0", "false") for r in runs]
            heading = D.looks_like_heading(paragraph_text(e, False), style, bool(runs) and all(bold))
            for b in D.paragraph_blocks(R.visible(paragraph_text(e, self.raised_keys)), style, heading, section):
                section = b.section
                out.append(b)
        return out


def docx_blocks(data: bytes) -> list[D.Block]:
    return _Word(zipfile.ZipFile(io.BytesIO(data))).blocks()


# -- slides


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    """Relation ids of a part to (kind, part)."""
    folder, name = posixpath.split(part)
    rels = f"{folder}/_rels/{name}.rels"
    if rels not in z.namelist():
        return {}
    return {x.get("Id", ""): (x.get("Type", "").rpartition("/")[2], posixpath.normpath(posixpath.join(folder, x.get("Target", "")))) for x in ElementTree.fromstring(z.read(rels))}


def _frame_text(e: ElementTree.Element) -> str:
    return "\n".join("".join((x.text or "") if name_of(x) == "t" else "\n" if name_of(x) == "br" else "" for x in p.iter()) for p in e.iter() if name_of(p) == "p")


def _chart_values(chart: ElementTree.Element) -> tuple[list[str], list[tuple[str, str, str]]]:
    """(categories, (series, category, value)) of a chart's first plot."""
    points = lambda e: {int(p.get("idx", 0)): next((v.text or "" for v in p if name_of(v) == "v"), "") for p in e.iter() if name_of(p) == "pt"} if e is not None else {}
    area = next((x for x in chart.iter() if name_of(x) == "plotArea"), None)
    plot = next((x for x in area if any(name_of(s) == "ser" for s in x)), None) if area is not None else None
    categories, out = [], []
    for s in (x for x in (plot if plot is not None else ()) if name_of(x) == "ser"):
        name = next(iter(points(_child(s, "tx")).values()), "")
        named = points(_child(s, "cat"))
        categories = categories or [named[i] for i in sorted(named)]
        for i, v in sorted(points(_child(s, "val")).items()):
            plain = repr(float(v))
            out.append((name, named.get(i, ""), R.normalized_number(plain.rstrip("0").rstrip(".") if "e" not in plain else plain, "en")))
    return categories, out


def pptx_slides(data: bytes, notes: bool = False) -> list[dict]:
    """slide, layout, text, tables, chart_values and notes of each slide in order; footers, dates and numbers are left out."""
    z, out = zipfile.ZipFile(io.BytesIO(data)), []
    listed = _relations(z, "ppt/presentation.xml")
    order = [listed[i][1] for x in ElementTree.fromstring(z.read("ppt/presentation.xml")).iter() if name_of(x) == "sldId" if (i := next((v for k, v in x.attrib.items() if k.endswith("}id")), "")) in listed]
    for n, part in enumerate(order, 1):
        relations = _relations(z, part)
        texts, tables, charts = [], [], []
        tree = next(x for x in ElementTree.fromstring(z.read(part)).iter() if name_of(x) == "spTree")
        for shape in tree:
            held = next((_attribute(x, "type") for x in shape.iter() if name_of(x) == "ph"), "")
            if held in ("ftr", "sldNum", "dt"):
                continue
            if name_of(shape) == "sp" and (t := R.visible(_frame_text(shape))).strip():
                texts.append(t)
            elif name_of(shape) == "graphicFrame":
                for tbl in (x for x in shape.iter() if name_of(x) == "tbl"):
                    rows = [[R.visible(_frame_text(tc)).strip() for tc in tr if name_of(tc) == "tc"] for tr in tbl if name_of(tr) == "tr"]
                    tables.append(rows)
                    texts.append(D.table_text(rows))
                for c in (x for x in shape.iter() if name_of(x) == "chart"):
                    target = relations.get(next((v for k, v in c.attrib.items() if k.endswith("}id")), ""), ("", ""))[1]
                    if target in z.namelist():
                        categories, values = _chart_values(ElementTree.fromstring(z.read(target)))
                        charts += values
                        texts += [f"CHART {s}: " + ", ".join(categories) for s in dict.fromkeys(v[0] for v in values)]
        layout = next((p for kind, p in relations.values() if kind == "slideLayout" and p in z.namelist()), None)
        named = next((x.get("name", "") for x in ElementTree.fromstring(z.read(layout)).iter() if name_of(x) == "cSld"), "") if layout else ""
        said = next((p for kind, p in relations.values() if kind == "notesSlide" and p in z.namelist()), None) if notes else None
        spoken = ""
        if said:
            bodies = (x for x in ElementTree.fromstring(z.read(said)).iter() if name_of(x) == "sp" and any(_attribute(h, "type") == "body" for h in x.iter() if name_of(h) == "ph"))
            spoken = R.visible("\n".join(map(_frame_text, bodies)))
        out.append({"slide": n, "layout": named, "text": "\n".join(texts), "tables": tables, "chart_values": [dict(zip(("series", "category", "normalized"), c, strict=True)) for c in charts], "notes": spoken})
    return out


_CELLS = pa.list_(pa.list_(pa.string()))
_SLIDES = pa.list_(pa.struct([("slide", pa.int32()), ("layout", pa.string()), ("text", pa.string()), ("tables", pa.list_(_CELLS)), ("chart_values", pa.list_(pa.struct([(c, pa.string()) for c in ("series", "category", "normalized")]))), ("notes", pa.string())]))
SLIDES = "array<struct<slide:int,layout:string,text:string,tables:array<array<array<string>>>,chart_values:array<struct<series:string,category:string,normalized:string>>,notes:string>>"
#: Files that can't be read.
_BROKEN = (zipfile.BadZipFile, KeyError, ElementTree.ParseError, StopIteration, ValueError, UnicodeDecodeError)
#: Contents of slide files to their slides, notes included; null if a file can't be read.
slides = N.over(lambda data: _tried(lambda: pptx_slides(data, True)), SLIDES, _SLIDES)


def _tried(f):
    try:
        return f()
    except _BROKEN:
        return None


def file_blocks(path: str, data: bytes) -> list[D.Block]:
    """Blocks of a file by its ending; of one that can't be read, or has another ending, one block of kind error."""
    ending = path.lower().rpartition(".")[2]
    try:
        if ending == "docx":
            return docx_blocks(data)
        if ending == "pptx":
            return [D.Block("slide", s["text"], s["layout"], str(s["slide"]), [r for t in s["tables"] for r in t] or None) for s in pptx_slides(data)]
        if ending in ("md", "txt", "markdown"):
            return D.markdown_blocks(data.decode())
    except _BROKEN as e:
        return [D.Block("error", f"{type(e).__name__}: {e}", "")]
    return [D.Block("error", f"unsupported file: .{ending}", "")]


_blocks = N.over(lambda p, data: [b._asdict() for b in file_blocks(p, data)], f"array<{structure.BLOCK}>", pa.list_(structure._BLOCK))


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, sha256, content of the files under path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "content")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, blocks of every file under path, whatever its format: .docx, .pptx, .md, .markdown or .txt; another one or a
    broken one is a row with a block of kind error."""
    return read_files(spark, path).select("path", "sha256", _blocks(F.col("path"), F.col("content")).alias("blocks"))


def read_office(spark: SparkSession, path: str) -> DataFrame:
    """path, block_idx, kind, text, section, style, cells of the blocks of the files under path."""
    return structure.exploded(read_documents(spark, path), F.col("blocks"), "path")


def read_decks(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, slides of the .pptx files under path."""
    return read_files(spark, path, "*.pptx").select("path", "sha256", slides(F.col("content")).alias("slides"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """path, text, sha256 of the Markdown and text files under path."""
    return read_files(spark, path, "*.{md,markdown,txt}").select("path", F.decode("content", "UTF-8").alias("text"), "sha256")


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON files of one object or array each (a ledger, a register, a specification)."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, text of approval letters: PDF files with a text layer, if the pypdf library is there, and text files.  A file
    without text has an empty one, to be verified by fields typed by hand."""

    def text(p: str, data: bytes) -> str:
        if not p.lower().endswith(".pdf"):
            return _tried(data.decode) or ""
        try:
            from pypdf import PdfReader
        except ImportError:
            return ""
        return _tried(lambda: "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages)) or ""

    read: Column = N.over(text, "string", pa.string())(F.col("path"), F.col("content"))
    return read_files(spark, path, "*.{pdf,txt}").select("path", "sha256", read.alias("text"))
