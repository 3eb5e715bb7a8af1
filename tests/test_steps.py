"""Whole runs over folders, and their command line."""

import pytest
from pyspark.sql import functions as F

from veriforge.__main__ import main
from veriforge.plans import steps
from veriforge.sinks import office as sinks

SOURCE = "# Résultats\n\nAu port, 1 340 barques (taux 71,4 %) sont entrées [1].\n\n| Quai | Score |\n|---|---|\n| Nord | 4,2 |\n\n## Références\n\n1. Roy A, et al. Boats in harbours. J Sea. 2011;12(3):441-9.\n"
TARGET = "# Results\n\nIn the harbour 1,340 boats (rate 71.4%) came in [1].\n\n| Quay | Score |\n|---|---|\n| North | 4.2 |\n\n## References\n\n1. Roy A, et al. Boats in harbours. J Sea. 2011;12(3):441-9.\n"


def _put(folder, name, text):
    at = folder / "p 1+2"
    at.mkdir(parents=True, exist_ok=True)
    (at / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def test_translation_run(spark, tmp_path):
    source, ledger = _put(tmp_path / "src", "a%20.md", SOURCE), str(tmp_path / "ledger")
    assert main(["ledger", source, ledger], spark) == 0
    (s,) = spark.read.parquet(f"{ledger}/summary").collect()
    assert (s.project, s.paper, s.numbers, s.tables, s.references) == ("p 1+2", "a%20", 2, 1, 1)

    good = _put(tmp_path / "good", "a%20.md", TARGET)
    assert main(["translation", good, str(tmp_path / "ok"), "--ledger", ledger, "--locale", "en"], spark) == 0
    bad = _put(tmp_path / "bad", "a%20.md", TARGET.replace("1,340", "1,430"))
    assert main(["translation", bad, str(tmp_path / "no"), "--ledger", ledger, "--locale", "en"], spark) == 1
    assert [r.normalized for r in spark.read.parquet(str(tmp_path / "no" / "introduced")).collect()] == ["1430"]
    (v,) = spark.read.parquet(str(tmp_path / "no" / "verdicts")).collect()
    assert (v.missing, v.majors) == (1, 1)


def test_ledger_again(spark, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    steps.build_ledger(spark, _put(tmp_path / "a", "x.md", SOURCE), first)
    read = spark.read.parquet(f"{first}/ledger")
    (boats,) = read.where("normalized = '1340'").collect()
    own = read.where("normalized = '1340'").withColumns({"id": F.lit("X-CLAIM-1"), "kind": F.lit("claim"), "extracted_by": F.lit("hand"), "normalized": F.lit(None).cast("string"), "linked_items": F.array(F.lit(boats.id))})
    read.union(own).write.mode("overwrite").parquet(f"{tmp_path}/kept/ledger")
    spark.read.parquet(f"{first}/papers").write.parquet(f"{tmp_path}/kept/papers")
    first = f"{tmp_path}/kept"
    steps.build_ledger(spark, _put(tmp_path / "b", "x.md", "Dix barques de plus : 52.\n\n" + SOURCE), second, old=first)
    assert [r.paper for r in spark.read.parquet(f"{second}/drift").collect()] == ["x"]
    new = {r.id: r for r in spark.read.parquet(f"{second}/ledger").collect()}
    (target,) = new["X-CLAIM-1"].linked_items
    assert target != boats.id and new[target].normalized == "1340"
    assert len(new) == spark.read.parquet(f"{second}/read").count() + 1
    with pytest.raises(ValueError):
        steps.build_ledger(spark, str(tmp_path / "b"), second, old=second)


def test_deck_run(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    steps.build_ledger(spark, _put(tmp_path / "src", "a.md", SOURCE), ledger)
    slide = lambda said: sinks.slide_file([{"type": "bullets", "title": "Bilan", "bullets": [{"text": said, "level": 0}]}])
    decks = _put(tmp_path / "decks", "sound.pptx", slide("1 340 barques"))
    assert main(["deck", decks, str(tmp_path / "d"), "--ledger", ledger], spark) == 0
    _put(tmp_path / "decks", "new.pptx", slide("1 345 barques"))
    _put(tmp_path / "decks", "silent.pptx", slide("Merci"))
    assert main(["deck", decks, str(tmp_path / "d"), "--ledger", ledger], spark) == 1
    found = {r.deck: r.verdict for r in spark.read.parquet(str(tmp_path / "d" / "deck_verdicts")).collect()}
    assert found == {"sound": "lockable", "new": "not lockable", "silent": "lockable"}
    _put(tmp_path / "decks", "broken.pptx", "no slides")
    assert main(["deck", decks, str(tmp_path / "d"), "--ledger", ledger], spark) == 2


def test_refused_sources(spark, tmp_path):
    folder = _put(tmp_path / "src", "a.md", SOURCE)
    _put(tmp_path / "src", "a.txt", SOURCE)
    assert main(["ledger", folder, str(tmp_path / "out")], spark) == 2
    assert main(["ledger", _put(tmp_path / "odd", "a.xyz", "?"), str(tmp_path / "out")], spark) == 2


def test_typeset_run(spark, tmp_path):
    assert steps.typeset(spark, _put(tmp_path / "src", "a.md", SOURCE), str(tmp_path / "out"), "fr") == 1
    (f,) = (tmp_path / "out").rglob("*.docx")
    assert f.read_bytes() == sinks.typeset_text(SOURCE, "fr")[0]
