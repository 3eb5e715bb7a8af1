"""The reader on sentences of our own, each for one rule; kernel first, then over columns."""

import pytest
from pyspark.sql import functions as F

from veriforge.functions import numbers as N
from veriforge.functions import reader as R
from veriforge.functions import text as T

FIGURES = {
    "fr": [
        # groups, decimals, signs, ordinals, letters that touch
        ("2 417 colis", "2417"), ("2 417 colis", "2417"), ("soit 3,75 litres", "3.75"), ("soit 3.75 litres", "3.75"), ("à −4,5 degrés", "-4.5"), ("la 2e salle a 40 lits", "2 40"), ("TVA20%", "20"), ("x7", "7"), ("r0,62", "0.62"),
        ("30jours", "30"), ("HR1,4", "1.4"), ("lots9", "9"), ("7c", ""), ("Annexe 4ter", ""), ("7C", "7"), ("1999ABC", "1999"), ("post-1998", "1998"), ("T11-Q06", "11 6"), ("lea21@courrier.org", ""), ("007,50", "7.50"), ("_8 et 8_", ""),
        # decimals without a zero
        ("r = ,71", "0.71"), ("r=.2", "0.2"), ("r ,71", "0.71"), ("β ,33", "0.33"), (",4", "0.4"), ("8 ,9", "8 0.9"), ("(,15)", "0.15"), ("Score : ,3", "0.3"),
        # stray commas
        ("Lenoiretal. ,2017 ASTR", "2017"), ("Duval ,2018 ; Roy ,2016", "2018 2016"), ("(Petit) ,2015", "2015"), ("Duval\n,2018", "2018"),
        # lists of integers
        ("(2,4,6,8,11 seulement)", "2 4 6 8 11"), ("points 3,5,9=Non", "3 5 9"), ("(cf. 11,14,17-19)", "11 14 17 19"), ("7,654,321 sacs", "7654321"), ("points 3,5", "3.5"), ("0,2,0,3", "0.2"), ("entre 1,5 et 2,5", "1.5 2.5"),
        # labels
        ("le tableau 4 250 sacs", "4 250"), ("la figure 2 130 cas", "2 130"), ("phase 1 300 cas", "1 300"),
        # intervals and citations
        ("RR 1,8 [1,1 ; 2,9]", "1.8 1.1 2.9"), ("1,8 [0,7–1,6]", "1.8 0.7 1.6"), ("moyenne 31 [27–36]", "31 27 36"), ("divers auteurs [21–24]", ""), ("[61,5–88,5]", "61.5 88.5"), ("[2,1–4,3]", "2.1 4.3"), ("part suffisante [40,2–58,6]", "40.2 58.6"),
        ("selon eux [2,4-6,9]", ""), ("selon eux [2,40]", ""), ("RR 1,8 voir [5,6]", "1.8"), ("[2,1–4,3] chez elles", "2.1 4.3"), ("selon eux [2–30]", "2 30"), ("étendue [24–33]", "24 33"), ("CI 95 % : 0,90–1,20", "95 0.90 1.20"),
        # what is no figure
        ("doi: 10.5555/abc.2019.07", ""), ("(https://doi.org/10.5555/z-3456)", ""), ("www.exemple.fr/12 puis 13", "13"), ("exemple.org/p?n=4 5", "5"), ("partie 4.2.7", ""), ("(cf. 4.2)", "4.2"), ("a" * 20 + "0123456789ab" + " 6", "6"),
        # dates
        ("le 1er mars 2021", "1-3-2021"), ("03/11/2020", "3-11-2020"), ("2020-11-03", "3-11-2020"), ("le 14 août 2019 et le 15 aout 2019", "14-8-2019 15-8-2019"), ("en mars 2021", "2021"), ("61-14-0007", "61 14 7"), ("le 3 févr 2020", "3 2020"), ("le 3 févr. 2020, le 3 fév. 2020", "3 2020 3-2-2020"),
        ("", ""), (None, ""), ("rien", ""),
    ],
    "en": [("2,417 parcels", "2417"), ("2 417 parcels", "2417"), ("2 417 parcels", "2 417"), ("March 14, 2021", "14-3-2021"), ("on the 2nd floor, 5 beds", "2 5"), ("near .25", "0.25"), ("91,5 %", "91"), ("(see 4.2)", "4.2"), ("points 2,4,6", "2 4 6"), ("Roy et al., 2016 ASTR", "2016"), ("HR 1.8 [1.1; 2.9]", "1.8 1.1 2.9")],
    "ar": [("2٬417 طرد", "2417"), ("نسبة ٣٫٧٥٪", "3.75"), ("بلغت و91.5% و340 وال340 ب4", "91.5 340 340 4"), ("في 9 شتنبر 2022", "9-9-2022"), ("مدى [24–33]", "24 33"), ("بلغ وسيط السن 31 [27–36]", "31 27 36"), ("البنود 3,5,9", "3 5 9"), ("كما ذكر [‪21–24]‬ هناك", "")],
    "xx": [("2,417 parcels", "2417")],
}


@pytest.mark.parametrize("locale", FIGURES)
def test_figures(spark, locale):
    assert [(t, " ".join(h.normalized for h in R.numbers(t, locale))) for t, _ in FIGURES[locale]] == FIGURES[locale]
    df = spark.createDataFrame([(t, w, locale) for t, w in FIGURES[locale]], "t string, want string, locale string")
    read = lambda by: F.array_join(F.transform(N.numbers(F.col("t"), by), lambda h: h["normalized"]), " ")
    assert all(r.want == r.a == r.b for r in df.select("want", read(locale).alias("a"), read(F.col("locale")).alias("b")).collect())


def test_roles_units_places_and_context():
    told = lambda t, locale="fr": [(h.normalized, h.role, h.unit) for h in R.numbers(t, locale)]
    assert told("1. Revoir 12 salles") == [("1", "numbering", None), ("12", None, None)]
    assert told("2) 40 %") == [("2", "numbering", None), ("40", None, "%")]
    assert told("1.5 de marge") == [("1.5", None, None)] and told("-3. non") == [("-3", None, None)]
    assert told("p = 0,03, p < 0,01, p 5, n = 40, n < 3") == [("0.03", "p_value", None), ("0.01", "p_value", None), ("5", None, None), ("40", "n", None), ("3", None, None)]
    assert told("en 2019, 2019 %, 1850, cap = 7") == [("2019", "year", None), ("2019", None, "%"), ("1850", None, None), ("7", None, None)]
    assert told("cf. § 4.2, annexe 3, القسم 5, tableau 2 019") == [("4.2", "label_ref", None), ("3", "label_ref", None), ("5", "label_ref", None), ("2", "label_ref", None), ("19", None, None)]
    text = "​Un début assez long, puis 12,50 litres\nd’eau versés ; le reste du texte continue encore longtemps après cela, sans fin."
    (h,) = R.numbers(text, "fr")
    clean = R.visible(text)
    assert clean[h.start : h.end] == h.raw == "12,50" and h.context == clean[max(0, h.start - 60) : h.end + 60].replace("\n", " ")


def test_long_texts_take_time_in_proportion():
    hits = R.numbers("selon [1,2] et 3,5 ; (4,5,6) voir 7 ,8 " * 20_000, "fr")
    assert len(hits) == 20_000 * 6


CITATIONS = [
    ("selon eux [2,4]", "[2] [4]"), ("en 2018 [21–24]", "[21] [22] [23] [24]"), ("RR 1,8 [1,1 ; 2,9]", ""), ("[61,5–88,5]", ""), ("selon eux [2,4-6,9]", "[2] [4] [5] [6] [9]"), ("selon [2,40] et [7]", "[2] [40] [7]"), ("[9-3] et [1–90]", ""),
    ("Moreau et al. (2019) puis (Roy & Duval, 2011; Petit, 2004b)", "(Roy & Duval, 2011) (Petit, 2004b) (Moreau et al., 2019)"), ("Roy and Duval (2011), Roy et Duval (2011)", "(Roy & Duval, 2011) (Roy & Duval, 2011)"), ("D’Arc-Lenoir (2001)", "(D’Arc-Lenoir, 2001)"),
    ("Roy وآخرون (2015)", "(Roy et al., 2015)"), ("ZETA-7 (2015) et roy (2015)", ""), (None, ""),
]


def test_citations(spark):
    assert [(t, " ".join(R.citations(t))) for t, _ in CITATIONS] == CITATIONS
    df = spark.createDataFrame(CITATIONS, "t string, want string")
    assert all(r.want == r.got for r in df.select("want", F.array_join(N.citations(F.col("t")), " ").alias("got")).collect())
    assert R.plausible_keys("2,4-6,9") and not R.plausible_keys("40,2–58,6") and not R.plausible_keys("3,2") and not R.plausible_keys("1–40") and not R.plausible_keys("0,1")
    assert R.expanded_keys("1,3-5; 9, x, 7-2") == ["1", "3", "4", "5", "9"]


def test_reference_predicates():
    assert all(map(R.is_references_heading, ["Références", "9. Références", "REFERENCES", "Bibliographie :", "Reference list", "قائمة المراجع", "Références (complètes)", "Sources et références", "B. Références du chapitre"]))
    assert not any(map(R.is_references_heading, ["Annexe : références", "2.4 Sources", "", None, "Le texte cite 12 références", "Discussion"]))
    entries = ["3. Roy A, Duval B. Of boats.", "[12] Roy A. Boats.", "Roy, A., & Duval, B. (2010). Boats.", "van Dael K, et al. Sails.", "Ministry of Boats.", "• Roy A, Duval B. Boats.", "14.Roy A. Boats"]
    assert all(map(R.opens_entry, entries)) and all(map(R.looks_like_reference, entries))
    assert not any(map(R.opens_entry, ["Annexe B. Cartes", "then we sailed", "2010;4:12.", "Remerciements", ""])) and R.looks_like_reference("it sank; 2010.") and R.looks_like_reference("see doi 5") and not R.looks_like_reference("Tableau 2. Roy, 2010.")
    assert [R.reference_index(x) for x in ("12. Roy A.", "[5b] Roy A.", "• 3. Roy", "Roy A.", "2010;4", None)] == [(12, "Roy A."), (5, "Roy A."), (3, "Roy"), (None, "Roy A."), (None, "2010;4"), (None, "")]
    assert R.doi("x doi:10.5555/ab.c., y") == "10.5555/ab.c" and R.doi("10.5/ab") is None


def test_reference_entries():
    assert R.reference_entries(["1. Roy A. Boats. J Sea.", "2010;4:12.", "2. Duval B. Sails. 2011.", "14 pages, 3 maps.", "3. Petit C. Oars. 2012."]) == ["1. Roy A. Boats. J Sea. 2010;4:12.", "2. Duval B. Sails. 2011. 14 pages, 3 maps.", "3. Petit C. Oars. 2012."]
    assert R.reference_entries(["Roy, A. (2010). Boats. J, 1, 2-3.", "14 études, 3 pays.", "Duval, B. (2011). Sails. J, 2.", "Sea Research Quarterly, 12(2), 85–112."]) == ["Roy, A. (2010). Boats. J, 1, 2-3. 14 études, 3 pays.", "Duval, B. (2011). Sails. J, 2. Sea Research Quarterly, 12(2), 85–112."]
    assert R.reference_entries(["1. Roy A. Boats. 2010.\n2. Duval B; Group of Sailors.\nAnd the wind. 2011.\n3. Petit C. Oars."]) == ["1. Roy A. Boats. 2010.", "2. Duval B; Group of Sailors. And the wind. 2011.", "3. Petit C. Oars."]
    assert R.reference_entries([]) == [] and R.reference_entries([None, "", "• "]) == []


def test_folding_and_names():
    assert R.folded("  Les  Étapes ") == "les étapes" and R.folded("والمراجعة") == R.folded("مراجعة") and R.folded("é") == "é"
    assert R.term_count("port", R.folded("Le port, porte et PORT-port")) == 3 and R.term_count("دراسة", R.folded("الدراسة ودراسة")) == 2 and R.term_count("", "x") == 0
    assert R.plain_name(" Zoé  Brûlé ") == "ZOE BRULE"
    assert R.same_place("aa bb  cc dd ee ff gg hh ii", "zz aa bb cc dd ee ff gg hh yy") and not R.same_place("abc " * 3, "abc " * 3) and not R.same_place(None, "x" * 40)


def test_scripts():
    assert R.script_runs("ab قد 12, x") == [("ab ", False), ("قد ", True), ("12, x", False)]
    assert R.inline_runs("see **two** *x*", "en") == [("see ", False, False, False), ("two", False, True, False), (" ", False, False, False), ("x", False, False, True)]
    assert R.inline_runs("قالوا [21–24] هنا", "ar") == [("قالوا ", True, False, False), ("‪[21–24]‬ ", False, False, False), ("هنا", True, False, False)]
    assert R.has_arabic("a ق") and not R.has_arabic("a") and R.mostly_latin("abc ق") and not R.mostly_latin("a قد")


def test_native_text(spark):
    r = spark.range(1).select(
        T.normalized_number(F.lit("007,50"), "fr").alias("n"), T.doi(F.lit("see 10.5555/ab.c.")).alias("d"), T.verification_code("A", F.lit("b")).alias("v"), T.without_bullet(F.lit(" • Roy")).alias("b"), F.array_join(T.expanded_keys(F.lit("1,3-5,x")), " ").alias("k"),
        T.is_rule_row(F.array(F.lit("---"), F.lit(":--:"))).alias("rule"), T.is_rule_row(F.array(F.lit("-"))).alias("short"), T.is_rule_row(F.array(F.lit(""))).alias("blank"), T.filled_rows(F.array(F.array(F.lit("a")), F.array(F.lit(" ")))).alias("rows"),
        T.table_label(F.lit("Tableau 3b. x")).alias("t"), T.figure_label(F.lit("Fig. 2 x")).alias("f"), T.blanked(F.lit("a12b"), r"\d+").alias("blanked"), T.western_digits(F.lit("٣۴")).alias("digits"), N.composed(F.lit("é​")).alias("nfc"), N.plain_name(F.lit(" Zoé ")).alias("name"),
        N.script_runs(F.lit("ab قد")).alias("s"), N.reference_index(F.lit("[5b] Roy")).alias("i"), N.has_arabic(F.lit("ق")).alias("ar"),
    ).first()
    assert (r.n, r.d, r.b, r.k, r.rule, r.short, r.blank, r.rows, r.t, r.f, r.blanked, r.digits, r.nfc, r.name) == ("7.50", "10.5555/ab.c", "Roy", "1 3 4 5", True, False, False, 1, "3b", "2", "a  b", "34", "é", "ZOE")
    assert len(r.v) == 11 and [(x.text, x.arabic) for x in r.s] == [("ab ", False), ("قد", True)] and r.i["index"] == 5 and r.ar


def test_equal_cells_are_read_once(monkeypatch):
    read, dates = [], R._dates
    monkeypatch.setattr(R, "_dates", lambda t: read.append(t) or dates(t))
    for locale, value in (("fr", "71.4"), ("en", "71"), ("fr", "71.4")):
        assert [R.numbers("quay 71,4 once more", locale)[-1].normalized for _ in range(50)] == [value] * 50
    assert len(read) == 2


def test_statistics_vocabulary_does_not_depend_on_figures():
    told = [(t, [h.normalized for h in R.numbers(t, "fr")]) for t in ("IC 95 % [1–3]", "IC 12 [1–3]", "à 95 % le [1–3]", "à 12 % le [1–3]", "à 38 % le [1–3]", "médiane 7 de [4–9]")]
    assert told == [("IC 95 % [1–3]", ["95", "1", "3"]), ("IC 12 [1–3]", ["12", "1", "3"]), ("à 95 % le [1–3]", ["95", "1", "3"]), ("à 12 % le [1–3]", ["12"]), ("à 38 % le [1–3]", ["38"]), ("médiane 7 de [4–9]", ["7", "4", "9"])]
