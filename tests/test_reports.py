"""Ledger, translation and deck reports, carry-over, and best references, on small papers of our own."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from veriforge.functions import document as D
from veriforge.functions import grammar as G
from veriforge.functions import numbers as N
from veriforge.functions import reader as R
from veriforge.operators import attest, carryover, reconcile, structure
from veriforge.operators import ledger as L

SOURCE = """# 3. Résultats

Au port, 1 340 barques sont entrées le 2 mai 2019 (taux 71,4 %) [1,2] ; Petit (2012) le note [3].

1. Revoir le quai (32 places).
2. Refaire la digue.

L’âge médian était de 31 ans [27–36] ; RR 1,8 [1,1 ; 2,9] ; voir le Tableau 1.

| Quai | Score | Source |
|---|---|---|
| Nord | 4,2 | [3] |
|  |  |  |
| Sud | 3,1 [2,1–4,3] | [2] |

Tableau 1. Scores des quais.

Figure 2. Entrées par mois (n = 45).

## 7. Références

Gardées dans leur langue.

1. Roy A, et al. Boats in harbours. J Sea. 2011;12(3):441-9.
2. Duval B, et al. Sails and oars: a survey. Sea Serv Res.

2012;10:149. doi:10.5555/xyz-10-149

3. Petit C, Lenoir D. Series of tides. Brest: Quai; 1981.

Annexe A. Questions

La liste compte 24 questions.
"""
TARGET = """# Results

In the harbour, 1,340 boats came in on 2 May 2019 (rate 71.4%) [1,2]; Petit (2012) notes it [3].

1. Mend the quay (32 places).
2. Rebuild the dyke.

The median age was 31 [27–36]; RR 1.8 [1.1; 2.9]; see Table 1.

| Quay | Score | Source |
|---|---|---|
| North | 4.2 | [3] |
| South | 3.1 [2.1–4.3] | [2] |

Table 1. Scores of the quays.

Figure 2. Entries by month (n = 45).

## References

1. Roy A, et al. Boats in harbours. J Sea. 2011;12(3):441-9.
2. Duval B, et al. Sails and oars: a survey. Sea Serv Res. 2012;10:149. doi:10.5555/xyz-10-149
3. Petit C, Lenoir D. Series of tides. Brest: Quai; 1981.

## Appendix A. Questions

The list has 24 questions.
"""


def _ledger(spark, text=SOURCE, paper="a", locale="fr"):
    docs = spark.createDataFrame([("p", paper, locale, "E", text)], "project string, paper string, locale string, prefix string, text string").withColumn("blocks", structure.blocks(F.col("text")))
    return L.extracted(docs, ["project", "paper"], F.col("blocks"), F.col("locale"), F.col("prefix"))


def _report(spark, target, ledger=None, ignore=(), locale="en"):
    targets = spark.createDataFrame([("p", "a", target)], "project string, paper string, text string").withColumn("reading", L.reading(structure.blocks(F.col("text")), F.lit(locale)))
    return reconcile.Translation(ledger or _ledger(spark), targets, ignore)


def test_items(spark):
    items = _ledger(spark).orderBy("place").collect()
    numbers = [(i.normalized, i.role, i.paragraph_index) for i in items if i.kind == "number"]
    assert numbers == [
        ("1340", None, 1), ("2-5-2019", "date", 1), ("71.4", None, 1), ("2012", "year", 1), ("1", "numbering", 2), ("32", None, 2), ("2", "numbering", 3), ("31", None, 4), ("27", None, 4), ("36", None, 4), ("1.8", None, 4), ("1.1", None, 4), ("2.9", None, 4), ("1", "label_ref", 4),
        ("45", "n", 6), ("24", None, 13),
    ]
    (table,) = [i for i in items if i.kind == "table"]
    assert (table.id, table.label, table.caption, table.n_rows, table.n_cols, table.header, table.values) == ("E-T-0001", "Tableau 1", "Tableau 1. Scores des quais.", 4, 3, ["Quai", "Score", "Source"], ["4.2", "3.1", "2.1", "4.3"])
    (figure,) = [i for i in items if i.kind == "figure"]
    assert (figure.label, figure["values"], figure.section) == ("Figure 2", ["45"], "3. Résultats")
    assert [(i.key, i.occurrences) for i in items if i.kind == "citation"] == [("[1]", 1), ("[2]", 2), ("[3]", 2), ("(Petit, 2012)", 1)]
    entries = [i for i in items if i.kind == "reference"]
    assert [(i["index"], i.text[:8], i.doi) for i in entries] == [(1, "Roy A, e", None), (2, "Duval B,", "10.5555/xyz-10-149"), (3, "Petit C,", None)]
    (s,) = L.summary(_ledger(spark), ["project", "paper"]).collect()
    assert (s.numbers, s.tables, s.figures, s.citations, s.references, s.claims) == (16, 1, 1, 4, 3, 0)


def test_clean_translation(spark):
    r = _report(spark, TARGET)
    (v,) = r.verdicts().collect()
    assert (v.missing, v.majors, v.verdict, v.tables_ok, v.verbatim) == (0, 0, "attestable", 1, 3)
    assert r.introduced().count() == 0 and all(c.ok for c in r.citations().collect()) and r.values().where("status <> 'matched'").count() == 0
    assert [(d.normalized, d.found_in_target) for d in r.dates().collect()] == [("2-5-2019", True)]
    assert attest.rolled_up(r.verdicts()).first()[2:] == ("20/20", "1/1", "3/3", "attestable") or attest.rolled_up(r.verdicts()).first().ledger_matched.split("/")[0] == attest.rolled_up(r.verdicts()).first().ledger_matched.split("/")[1]


def test_each_change_gives_its_finding(spark):
    def findings(old, new):
        assert old in TARGET
        r = _report(spark, TARGET.replace(old, new))
        return ({(x.normalized, x.status) for x in r.values().where("status <> 'matched'").collect()}, {x.normalized for x in r.introduced().collect()}, [(dict(t.missing), dict(t.extra), t.ok) for t in r.tables().collect()], [x.id for x in r.references().where("NOT verbatim").collect()], {(c.key, c.found) for c in r.citations().where("NOT ok").collect()})

    fine = [({}, {}, True)]
    assert findings("24 questions", "25 questions") == ({("24", "missing")}, {"25"}, fine, [], set())
    assert findings("(32 places)", "") == ({("32", "missing")}, set(), fine, [], set())
    assert findings("| North | 4.2 |", "| North | 4.5 |") == ({("4.2", "missing")}, {"4.5"}, [({"4.2": 1}, {"4.5": 1}, False)], [], set())
    assert findings("| North | 4.2 | [3] |\n", "") == ({("4.2", "missing")}, set(), [({"4.2": 1}, {}, False)], [], {("[3]", 1)})
    assert findings("Series of tides", "Something else altogether") == (set(), set(), fine, ["E-REF-0003"], set())
    assert findings("notes it [3]", "notes it [2]") == (set(), set(), fine, [], {("[2]", 3), ("[3]", 1)})
    assert findings("2 May 2019", "2 May 2019, 7 June 2020")[1] == set()
    extra = _report(spark, TARGET.replace("2 May 2019", "2 May 2019, 7 June 2020, in 2019"))
    assert {(d.id is None, d.normalized) for d in extra.dates().collect()} == {(False, "2-5-2019"), (True, "7-6-2020")} and extra.introduced().count() == 0
    lost = _report(spark, TARGET.split("| Quay")[0])
    assert [t.ok for t in lost.tables().collect()] == [False] and lost.tables().first().rows_tgt is None and lost.verdicts().first().verbatim == 0


def test_tables_and_verdicts_read_each_side_once(spark):
    ledger = _ledger(spark)
    targets = spark.createDataFrame([("p", "a", TARGET)], "project string, paper string, text string").withColumn("reading", L.text_reading(F.col("text"), F.lit("en")))
    report = reconcile.Translation(ledger, targets, keep=False)
    for df in (report.tables(), report.verdicts()):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD [") == 2 and "InMemoryRelation" not in plan
    assert reconcile.verbatim_entries(["1. Roy A. Weiß.", "Duval B. Sails of the sea and of the land. 2011."], ["ROY A. WEISS."]) == 1
    assert reconcile.verbatim_entries(None, ["x"]) == reconcile.verbatim_entries(["x"], None) == 0


def test_each_kind_of_item_is_the_ledgers():
    b = D.markdown_blocks(SOURCE)
    whole = D.items(b, "fr", "E")
    for kind in D.KINDS:
        assert D.items(b, "fr", "E", frozenset({kind})) == [x for x in whole if x["kind"] == kind]


def test_tables_are_read_and_compared_without_the_running_text(spark, monkeypatch):
    source, target, read = D.markdown_blocks(SOURCE), D.markdown_blocks(TARGET), []
    own, theirs = D.own_tables(source, "fr", "E"), D.reading(target, "en")["tables"]
    monkeypatch.setattr(R, "numbers", lambda text, locale, f=R.numbers: read.append(text) or f(text, locale))
    assert D.own_tables(source, "fr", "E") == own and D.read_tables(target, "en") == theirs
    assert set(read) <= {c for b in (*source, *target) for row in b.cells or () for c in row}
    two = SOURCE + "\n| a |\n|---|\n| 7 |\n"
    papers, targets = (spark.createDataFrame([("p", "a", t)], "project string, paper string, text string") for t in (two, TARGET.replace("3.1", "3.2")))
    brief = reconcile.compared_tables(
        papers.select("project", "paper", L.text_tables("text", F.lit("fr"), F.lit("A")).alias("own_tables")),
        targets.select("project", "paper", L.text_read_tables("text", F.lit("en")).alias("tables")),
        ["project", "paper"],
    )
    kept = reconcile.Translation(L.extracted(papers, ["project", "paper"], F.col("text"), F.lit("fr"), F.lit("A"), L.text_items), targets.select("project", "paper", L.text_reading("text", F.lit("en")).alias("reading")), keep=False).tables()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(brief) == rows(kept) and [r.ok for r in brief.orderBy("ordinal").collect()] == [False, False]


def test_verdicts_of_texts_are_the_ledgers(spark):
    keys, texts = ["project", "paper"], {"a": TARGET, "b": TARGET.replace("32", "33").replace("24", "25"), "c": TARGET.replace("3.1", "3.2").replace("Sails", "Snails and oars"), "d": "", "e": None}
    papers = spark.createDataFrame([("p", k, SOURCE) for k in texts if k != "d"], "project string, paper string, text string")
    targets = spark.createDataFrame([("p", k, t) for k, t in texts.items()], papers.schema)
    ledger = L.extracted(papers, keys, F.col("text"), F.lit("fr"), F.upper("paper"), L.text_items)
    kept = reconcile.Translation(ledger, targets.select(*keys, L.text_reading("text", F.lit("en")).alias("reading")), ["45"], keep=False).verdicts()
    own = papers.select(*keys, reconcile.text_papers(F.col("text"), F.lit("fr"), F.upper("paper"), ["45"]).alias("p")).select(*keys, "p.*")
    found = reconcile.compared_papers(own, targets.select(*keys, L.text_read_values("text", F.lit("en")).alias("r")).select(*keys, "r.*"), keys)
    rows = {r.paper: r for r in found.collect()}
    assert rows == {r.paper: r for r in kept.collect()}
    assert [rows[k].missing for k in "abc"] == [0, 2, 1] and rows["a"].majors == 0 and rows["c"].tables_ok == 0 and rows["c"].verbatim == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan


def test_figures_open_as_said():
    r, signs = random.Random(3), "0123456789.,-\u2212 \u202f\u00a0ab(=%[\u066b\u0665é_"
    for _ in range(3000):
        text = "".join(r.choice(signs) for _ in range(r.randint(1, 12)))
        for figure in G.FIGURES.values():
            m = figure.search(text)
            assert m is None or G.FIGURE_OPENS.match(text, m.start())


def test_ignored_and_spelled_out(spark):
    source = SOURCE + "\nAnnée 2021/2022.\n"
    ledger = _ledger(spark, source)
    assert {x.normalized for x in _report(spark, TARGET, ledger).values().where("status = 'missing'").collect()} == {"2021", "2022"}
    ignore = reconcile.ignored_values(["2021/2022"], "fr")
    assert ignore == ["2021", "2022"] and _report(spark, TARGET, ledger, ignore).verdicts().first().majors == 0
    by_hand = ledger.where("id = 'E-N-0001'").withColumn("role", F.lit("spelled_out")).withColumn("normalized", F.lit("77")).withColumn("id", F.lit("H"))
    r = _report(spark, TARGET, ledger.union(by_hand), ignore)
    assert r.verdicts().first().majors == 0 and [(x.id, x.found_as_digits) for x in r.spelled_out().collect()] == [("H", False)]


def test_versions(spark):
    v = spark.createDataFrame([("7",), ("5",), ("2",), (None,)], "v string").select(L.version_verdict(F.col("v")).alias("x"))
    assert [r.x for r in v.collect()] == ["ok", "note", "stop", "stop"]
    bad = _report(spark, TARGET.replace("24 questions", "25 questions")).verdicts()
    assert reconcile.rebuild_first(bad, "5").first().rebuild_ledger_first and not reconcile.rebuild_first(bad, "7").first().rebuild_ledger_first


def test_deck(spark):
    slides = spark.createDataFrame([("p", "d", 1, "1. 1 340 barques, 9 quais, 71,4 %"), ("p", "d", 2, "2 890 autres ; en mai 2019, 12 ; 31 ans")], "project string, deck string, slide int, text string")
    chart = F.array(F.struct(F.lit("s").alias("series"), F.lit("c").alias("category"), F.when(F.col("slide") == 1, "4.2").otherwise("4.9").alias("normalized")))
    d = reconcile.Deck(_ledger(spark), slides.select("project", "deck", "slide", N.numbers(F.col("text"), "fr").alias("numbers"), chart.alias("chart_values")), ["12"])
    assert sorted((x.slide, x.normalized) for x in d.introduced().collect()) == [(2, "2890"), (2, "4.9")]
    (v,) = d.verdicts().collect()
    assert (v.covered, v.introduced, v.verdict) == (5, 2, "not lockable")


def test_deck_broadcasts_no_ledger_and_reads_slides_once(spark):
    slides = spark.createDataFrame([("p", "d", 1, "9 quais, 71,4 %")], "project string, deck string, slide int, text string").withColumn("numbers", N.numbers(F.col("text"), "fr"))
    chart = F.array(F.struct(F.lit("s").alias("series"), F.lit("c").alias("category"), F.lit("4.2").alias("normalized")))
    ledger = spark.createDataFrame([("p", "a", "number", "9", None, None), ("p", "a", "number", "2-5-2019", "date", None), ("p", "a", "table", None, None, ["71.4"])], "project string, paper string, kind string, normalized string, role string, values array<string>")
    d = reconcile.Deck(ledger, slides.withColumn("chart_values", chart))
    plan = d.verdicts()._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("ArrowEvalPython [") == 1
    assert {x.normalized for x in d.known.collect()} == {"9", "2-5-2019", "2", "5", "2019", "71.4"}


def _random_blocks(r):
    lines = ["plain words", "Remerciements", "Note : un mot", "1. Roy A. Boats. 2010.", "Duval B, Petit C. Sails. 2011.", "2012;10:149.", "Annexe B. Cartes", "it was in 2010; so", "tail without signs", "14 pages"]
    return [D.Block("heading", r.choice(["Références", "Résultats"]), "") if x < 0.2 else D.Block("table", "", "", None, [["1"]]) if x < 0.3 else D.Block("paragraph", r.choice(lines), "") for x in (r.random() for _ in range(r.randrange(12)))]


def test_windows_and_kernel_agree_on_reference_lists(spark):
    r = random.Random(1)
    docs = [_random_blocks(r) for _ in range(150)]
    rows = [(d, i, b.kind, b.text, b.section, None, b.cells) for d, blocks in enumerate(docs) for i, b in enumerate(blocks)]
    df = spark.createDataFrame(rows, "doc_id int, block_idx int, kind string, text string, section string, style string, cells array<array<string>>")
    got = {(x.doc_id, x.block_idx): bool(x.in_refs) for x in structure.with_references(df).collect()}
    want = {(d, i): x for d, blocks in enumerate(docs) for i, x in enumerate(D.in_references(blocks))}
    assert got == want and any(want.values())


def test_dump_reads_back():
    blocks = D.markdown_blocks(SOURCE.replace("survey. Sea Serv Res.", "survey. Sea Serv Res.\n3. Xe D. Oars."))
    again = D.markdown_blocks(D.dump([b for b in blocks if b.kind != "table"]))
    assert [b.text for b in again if b.kind == "heading"] == [b.text for b in blocks if b.kind == "heading"]
    assert D.reading(again, "fr")["entries"] == D.reading([b for b in blocks if b.kind != "table"], "fr")["entries"]


def test_front_matter():
    fields, blocks = D.front_matter("---\ntitle: Of boats\nauthors: A. Roy\n---\n## Part\n\none\ntwo\n- x\n- y\n![Figure 1. Map](map.png)\n<<<pagebreak>>>\n| a |\n|---|\n| 1 |\n")
    assert fields == {"title": "Of boats", "authors": "A. Roy"}
    assert [b["kind"] for b in blocks] == ["heading", "paragraph", "list", "figure", "pagebreak", "table"] and blocks[1]["text"] == "one two" and blocks[2]["items"] == ["x", "y"] and blocks[5]["cells"] == [["a"], ["1"]]


def test_headings():
    assert D.looks_like_heading("2.3 Méthode", "Normal", False) and D.looks_like_heading("En gras", "Normal", True) and D.looks_like_heading("12 cas", "Heading 1", False)
    assert not D.looks_like_heading("Taux de 85", "Normal", True) and not D.looks_like_heading("Une phrase.", "Normal", True) and not D.looks_like_heading("3.4 % des cas", "Normal", False)
    assert D.classified("Références", "Normal", False) and not D.classified("Trois α < 0,70 : voir", "Heading 2", True) and not D.classified("Roy A, Duval B. Of boats and their sails. J Sea. 2010;4:1.", "Heading 1", True)
    assert [b.kind for b in D.paragraph_blocks("2. SUJET\nUn texte de 30 mots.", "Heading 1", True, "")] == ["heading", "paragraph"]


def test_best_references_are_difflibs(spark):
    """Similarity of 300 mutated entries against the plain maximum over all pairs of the paper."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    source = [(i, i % 12, f"{i % 30 + 1}. " + " ".join(word().capitalize() for _ in range(r.randint(5, 40)))) for i in range(300)]
    target = []
    for i, paper, text in source:
        body = list(text.split(". ", 1)[1])
        for _ in range(r.choice([0, 0, 1, 2, 6, 40])):
            k = r.randrange(len(body))
            body[k : k + r.randint(0, 2)] = r.choice(["", "x", "yz"])
        target.append((paper, r.choice(["", "[7] ", "12. "]) + r.choice([str.upper, str])("".join(body))))
    got = reconcile.best_references(spark.createDataFrame(source, "id int, paper int, text string"), spark.createDataFrame(target, "paper int, text string"), ["paper"]).collect()
    plain = lambda t: " ".join(R.G.INDEX.sub("", t).split()).lower()
    want = {i: max(SequenceMatcher(None, plain(text), plain(t)).ratio() for p, t in target if p == paper) for i, paper, text in source}
    assert {x.id: x.similarity for x in got} == {i: round(s, 3) for i, s in want.items()} and {x.id for x in got if x.verbatim} == {i for i, s in want.items() if s >= 0.985}
    none = reconcile.best_references(spark.createDataFrame(source[:2], "id int, paper int, text string"), spark.createDataFrame([], "paper int, text string"), ["paper"]).collect()
    assert [(x.similarity, x.verbatim) for x in none] == [(0.0, False)] * 2


def test_best_references_fold_letters_whose_capitals_are_two(spark):
    source, target = [(1, 1, "3. Weiß K. Maße und Größen. ὀδός.")], [(1, "[12] WEISS K. MASSE UND GRÖSSEN. ὈΔΌΣ.")]
    got = reconcile.best_references(spark.createDataFrame(source, "id int, paper int, text string"), spark.createDataFrame(target, "paper int, text string"), ["paper"]).collect()
    assert [(x.similarity, x.verbatim) for x in got] == [(1.0, True)]


def test_carry_over(spark):
    """Links of claims follow their items through a rebuild; twins go, names that clash change, lost links are told."""
    new = _ledger(spark).cache()
    ids = {(i.kind, i.normalized or i.key or i.label or i.text[:5]): i for i in new.collect()}
    old = new.withColumn("linked_items", F.array().cast("array<string>"))
    # the old reader counted paragraphs differently and lost an entry's second half
    old = old.withColumn("paragraph_index", F.col("paragraph_index") + 5).withColumn("text", F.when(F.col("text").startswith("Duval"), F.substring("text", 1, 50)).otherwise(F.col("text")))
    old = old.withColumn("id", F.concat(F.lit("OLD-"), "id"))
    o = lambda *key: "OLD-" + ids[key].id
    hand = [("E-CL-1", "claim", [o("number", "31"), o("reference", "Duval"), o("table", "Tableau 1"), o("figure", "Figure 2"), o("citation", "[3]"), "H-1", "nowhere", "H-2"]), ("H-1", "number", []), ("H-2", "number", []), ("E-N-0001", "claim", ["E-CL-1"])]
    base = old.where("id = 'OLD-E-N-0008'")
    for n, (i, kind, links) in enumerate(hand):
        row = base.withColumn("id", F.lit(i)).withColumn("kind", F.lit(kind)).withColumn("place", F.lit(1000 + n)).withColumn("extracted_by", F.lit("assistant")).withColumn("linked_items", F.array(*map(F.lit, links)) if links else F.array().cast("array<string>"))
        if i == "H-1":  # read by hand where the reader reads 2.9 now
            row = row.withColumn("normalized", F.lit("2.9")).withColumn("context", F.lit(ids["number", "2.9"].context)).withColumn("role", F.lit(None).cast("string"))
        if i == "H-2":
            row = row.withColumn("normalized", F.lit("2.9")).withColumn("role", F.lit("spelled_out"))
        old = old.unionByName(row)
    mapped = carryover.mapping(old, new).cache()
    kept = {r.old_id: r for r in carryover.carried(old, new, mapped).collect()}
    assert set(kept) == {"E-CL-1", "H-2", "E-N-0001"} and kept["E-N-0001"].id == "E-N-0001-H" and kept["E-CL-1"].id == "E-CL-1"
    n = lambda *key: ids[key].id
    assert kept["E-CL-1"].linked_items == [n("number", "31"), n("reference", "Duval"), n("table", "Tableau 1"), n("figure", "Figure 2"), n("citation", "[3]"), n("number", "2.9"), "H-2"] and kept["E-CL-1"].lost_links == ["nowhere"]
    assert {(r.old_id, r.by) for r in mapped.collect()} == {(o("number", "31"), "context"), (o("reference", "Duval"), "text"), (o("table", "Tableau 1"), "ordinal"), (o("figure", "Figure 2"), "label"), (o("citation", "[3]"), "key"), ("H-1", "duplicate")}
    (r,) = carryover.report(carryover.carried(old, new, mapped), mapped).collect()
    assert (r.carried_items, r.lost_links, r.renamed, r.dropped_duplicates) == (3, 1, 1, 1)


def test_carry_over_cascade():
    item = lambda i, value, para=1, context="", **more: {"id": i, "kind": "number", "place": int(i[1:]), "paragraph_index": para, "raw": value, "normalized": value, "context": context, "rank": 0, **more}
    paper = carryover._Paper([item("n1", "5"), item("n2", "5"), item("n3", "2.3", 2, "see 2.3"), item("n4", "25.8", 2, "see 2"), item("n5", "8", 9, "x" * 30)])
    find = lambda **k: paper.find(item("o1", **{"value": "5", **k}))
    assert find() == ("n1", "place") and paper.find(item("o1", "5") | {"rank": 1}) == ("n2", "place") and paper.find(item("o1", "5") | {"rank": 2}) == ("n1", "value")
    assert find(value="2", para=2, context="see 2.3") == ("n3", "read longer") and find(value="8", context="x" * 30) == ("n5", "context") and find(value="8", context="x" * 30) is None and find(value="77") is None
