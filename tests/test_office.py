"""Word-processor and slide files: written by hand with the features of real ones, and by our own sinks."""

import zipfile

from pyspark.sql import functions as F

from veriforge.functions import reader as R
from veriforge.operators import structure
from veriforge.sinks import office as sinks
from veriforge.sources import office

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006"'


def _p(*runs, style=""):
    return f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr>{"".join(runs)}</w:p>'


def _r(text, more=""):
    return f"<w:r><w:rPr>{more}</w:rPr><w:t>{text}</w:t></w:r>"


UP = '<w:vertAlign w:val="superscript"/>'


def _docx(path, body, styles=""):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f"<w:styles {W}>{styles}</w:styles>")


def test_word_features(tmp_path):
    cell = lambda t, props="": f"<w:tc><w:tcPr>{props}</w:tcPr>{''.join(_p(_r(x)) for x in t.split('/'))}</w:tc>"
    box = lambda t: f"<w:txbxContent>{_p(_r(t))}</w:txbxContent>"
    body = "".join(
        [
            _p(_r("Table des matières 9"), style="TM1"),
            f'<w:sdt><w:sdtPr><w:docPartObj><w:docPartGallery w:val="Table of Contents"/></w:docPartObj></w:sdtPr><w:sdtContent>{_p(_r("Sommaire 8"))}</w:sdtContent></w:sdt>',
            _p(_r("Résultats"), style="T1"),
            _p(_r("Le port a 33 quais."), _r("4,5", UP), _r(" Long de 12 m"), _r("2", UP), _r(", puis."), _r("7", UP), "<w:del><w:r><w:delText>999</w:delText></w:r></w:del><w:ins>", _r(" ajouté"), "</w:ins>", _r("9", UP)),
            _p(_r("2.3 Méthode")),
            _p(_r("En gras", "<w:b/>")),
            _p(_r("Taux de 85 %", "<w:b/>")),
            _p(_r("3. SUJET"), "<w:r><w:br/></w:r>", _r("Un texte de 30 mots."), style="T1"),
            _p(_r("Trois valeurs α &lt; 0,70"), style="T1"),
            _p(_r("avant"), f"<w:r><mc:AlternateContent><mc:Choice>{box('Encadré 150')}</mc:Choice><mc:Fallback>{box('Encadré 150')}</mc:Fallback></mc:AlternateContent></w:r>"),
            f"<w:tbl><w:tr>{cell('Nom')}{cell('OR', '<w:gridSpan w:val=&quot;2&quot;/>'.replace('&quot;', chr(34)))}</w:tr><w:tr>{cell('A', '<w:vMerge w:val=' + chr(34) + 'restart' + chr(34) + '/>')}{cell('1/588')}{cell('x')}</w:tr><w:tr>{cell('A', '<w:vMerge/>')}{cell('y')}{cell('')}</w:tr></w:tbl>",
            f"<w:sdt><w:sdtContent>{_p(_r('Références'))}{_p(_r('1. Roy A. Boats. 2010.'))}</w:sdtContent></w:sdt>",
        ]
    )
    styles = '<w:style w:styleId="T1"><w:name w:val="heading 1"/></w:style><w:style w:styleId="TM1"><w:name w:val="toc 1"/></w:style>'
    _docx(tmp_path / "a.docx", body, styles)
    got = office.docx_blocks((tmp_path / "a.docx").read_bytes())
    assert [(b.kind, b.text) for b in got if b.kind != "table"] == [
        ("heading", "Résultats"), ("paragraph", "Le port a 33 quais.[4,5] Long de 12 m2, puis.[7] ajouté[9]"), ("heading", "2.3 Méthode"), ("heading", "En gras"), ("paragraph", "Taux de 85 %"), ("heading", "3. SUJET"), ("paragraph", "Un texte de 30 mots."),
        ("paragraph", "Trois valeurs α < 0,70"), ("paragraph", "avant"), ("paragraph", "Encadré 150"), ("heading", "Références"), ("paragraph", "1. Roy A. Boats. 2010."),
    ]
    assert next(b.cells for b in got if b.kind == "table") == [["Nom", "OR", ""], ["A", "1 588", "x"], ["", "y", ""]]
    assert [b.section for b in got][-1] == "Références"


def test_files_of_all_kinds(spark, tmp_path):
    _docx(tmp_path / "a.docx", _p(_r("n = 12")))
    (tmp_path / "b.docx").write_bytes(b"no zip")
    (tmp_path / "c.md").write_text("# One\n\n1. first\n2. second\nmore\n\n| a | b |\n|---|---|\n| 1 | |\n\ntail\nline")
    (tmp_path / "d.xyz").write_text("?")
    rows = {r.path.rpartition("/")[2]: r for r in office.read_documents(spark, str(tmp_path)).collect()}
    assert [b.text for b in rows["a.docx"].blocks] == ["n = 12"] and rows["b.docx"].blocks[0].kind == rows["d.xyz"].blocks[0].kind == "error"
    md = rows["c.md"].blocks
    assert [(b.kind, b.text) for b in md] == [("heading", "One"), ("paragraph", "1. first"), ("paragraph", "2. second"), ("paragraph", "more"), ("table", "a\tb\n1\t"), ("paragraph", "tail\nline")] and md[4].cells == [["a", "b"], ["1", ""]]
    assert office.read_office(spark, str(tmp_path)).count() == 9 and office.read_text(spark, str(tmp_path)).count() == 1
    (tmp_path / "j.json").write_text('{"a": 1}')
    assert office.read_json(spark, str(tmp_path / "j.json"), "a int").first().a == 1
    (tmp_path / "l.txt").write_text("Letter")
    assert [r.text for r in office.read_letters(spark, str(tmp_path)).collect()] == ["Letter"]


def test_arabic_typesetting():
    source = "---\ntitle: عنوان\n---\n## النتائج\n\nكما قيل [21–24] بنسبة ٧٨.\n\n| أ | b |\n|---|---|\n| 1 | ق |\n\n## المراجع\n\n1. Roy A. Boats. 2010.\n"
    content, counts = sinks.typeset_text(source, "ar")
    xml = zipfile.ZipFile(__import__("io").BytesIO(content)).read("word/document.xml").decode()
    assert counts == {"headings": 2, "paragraphs": 1, "tables": 1, "figures": 0, "lists": 0, "references": 1}
    assert "‪[21–24]‬" in xml and "w:bidiVisual" in xml and "78" in xml and 'w:jc w:val="both"' not in xml
    blocks = office.docx_blocks(content)
    assert [b.text for b in blocks if b.kind == "heading"] == ["عنوان", "النتائج", "المراجع"] and R.citations(blocks[2].text) == ["[21]", "[22]", "[23]", "[24]"]
    assert sinks.typeset_text(source, "ar")[0] == content


def test_decks(spark, tmp_path):
    slides = [
        {"type": "title", "title": "Boats", "subtitle": "A. Roy", "notes": "Welcome\nall"},
        {"type": "table", "title": "Scores", "header": ["Quay", "Score"], "rows": [["North", "4,2"]]},
        {"type": "chart", "title": "Entries", "chart": {"kind": "pie", "categories": ["a", "b"], "series": [{"name": "s", "values": [50.0, 0.25]}]}},
        {"type": "bullets", "title": "Points", "bullets": [{"text": "one", "level": 0}, {"text": "two", "level": 1}]},
    ]
    (tmp_path / "d.pptx").write_bytes(sinks.slide_file(slides, "foot 77"))
    got = office.pptx_slides((tmp_path / "d.pptx").read_bytes(), notes=True)
    assert [s["layout"] for s in got] == ["title", "table", "chart", "bullets"] and got[0]["text"] == "Boats\nA. Roy" and got[0]["notes"] == "Welcome\nall"
    assert got[1]["tables"] == [[["Quay", "Score"], ["North", "4,2"]]] and got[3]["text"] == "Points\none\ntwo" and not any("77" in s["text"] for s in got)
    assert [(c["series"], c["category"], c["normalized"]) for c in got[2]["chart_values"]] == [("s", "a", "50"), ("s", "b", "0.25")]
    (deck,) = office.read_decks(spark, str(tmp_path)).collect()
    assert len(deck.slides) == 4 and deck.slides[2].chart_values[1].normalized == "0.25"
    script = sinks.notes_text([{"slide": 1, "type": "title", "title": "Boats", "notes": "Welcome", "in_annex": False, "own_seconds": 70, "running": 70}], "Script")
    blocks = office.docx_blocks(script)
    assert any("cumul 1:10" in b.text for b in blocks) and blocks[-1].cells[1] == ["1", "Boats", "70", "1:10"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "# One\n\ntext 1\n"), ("b", "# Two\n\ntext 2\n")], "paper string, text string")
    made = df.select(F.concat("paper", F.lit(".docx")).alias("name"), sinks.typeset(F.col("text"), "en").alias("f")).select("name", "f.content")
    assert sinks.export(made, str(tmp_path / "out")) == 2 and [b.text for b in office.docx_blocks((tmp_path / "out" / "b.docx").read_bytes())] == ["Two", "text 2"]
    sinks.write_dump(df.withColumn("blocks", structure.blocks(F.col("text"))), str(tmp_path / "dump"), "blocks", "paper")
    again = spark.read.text(str(tmp_path / "dump"), wholetext=True).withColumn("blocks", structure.blocks(F.col("value")))
    assert sorted((r.paper, r.t) for r in again.select("paper", structure.plain_text(F.col("blocks")).alias("t")).collect()) == [("a", "One\ntext 1"), ("b", "Two\ntext 2")]
    sinks.write_json(df, str(tmp_path / "json"), "paper")
    assert spark.read.json(str(tmp_path / "json")).count() == 2
