"""Words, separators and formats that decide what a figure, a citation or a heading is.

Lists are in natural order and in plain letters.  Patterns are made of them in `grammar`.
"""

# Separators.  Figure groups are parted by no-break, narrow, thin, figure and plain spaces.
SPACES = {"no-break": "\u00a0", "narrow": "\u202f", "thin": "\u2009", "figure": "\u2007", "plain": " "}
GROUP_FR = "".join(SPACES.values())
ARABIC_THOUSANDS, ARABIC_DECIMAL, ARABIC_PERCENT = "٬", "٫", "٪"
GROUP_EN = "," + "".join(v for k, v in SPACES.items() if k != "plain") + ARABIC_THOUSANDS
ARABIC_DIGITS, PERSIAN_DIGITS = "٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹"
DASHES = "–—-"
MINUS = "-−"

# Code points without text (zero width, bidi marks, embeddings and isolates, byte order mark, soft hyphen,
# private use).
NO_TEXT = [(0x200B, 0x200B), (0x200E, 0x200F), (0x202A, 0x202E), (0x2066, 0x2069), (0xFEFF, 0xFEFF), (0x00AD, 0x00AD), (0xE000, 0xF8FF)]

# Month names in French, English and Arabic, Moroccan names included.  A last full stop may be missing.
MONTHS = {
    1: ["janvier", "janv.", "january", "jan.", "يناير", "كانون الثاني"],
    2: ["février", "fevrier", "fév.", "fev.", "february", "feb.", "فبراير", "شباط"],
    3: ["mars", "march", "mar.", "مارس", "آذار"],
    4: ["avril", "avr.", "april", "apr.", "أبريل", "إبريل", "ابريل", "نيسان"],
    5: ["mai", "may", "ماي", "مايو", "أيار"],
    6: ["juin", "june", "jun.", "يونيو", "يونيه", "حزيران"],
    7: ["juillet", "juil.", "july", "jul.", "يوليو", "يوليوز", "تموز"],
    8: ["août", "aout", "august", "aug.", "أغسطس", "غشت", "آب"],
    9: ["septembre", "sept.", "sep.", "september", "سبتمبر", "شتنبر", "أيلول"],
    10: ["octobre", "oct.", "october", "أكتوبر", "اكتوبر", "تشرين الأول"],
    11: ["novembre", "nov.", "november", "نوفمبر", "نونبر", "تشرين الثاني"],
    12: ["décembre", "decembre", "déc.", "dec.", "december", "ديسمبر", "دجنبر", "كانون الأول"],
}

# Ordinal suffixes, item letters that make a number a label, and top-level domains of addresses without a scheme.
ORDINALS = ["er", "ère", "ere", "re", "e", "ème", "eme", "st", "nd", "rd", "th"]
DAY_ORDINALS = ["er", "ère", "re", "e", "st", "nd", "rd", "th"]
ITEM_LABELS = ["a", "b", "c", "d", "bis", "ter"]
DOMAINS = ["com", "org", "net", "app", "edu", "gov", "int", "io", "ma", "fr", "ca", "uk", "ch", "be", "eu", "info"]

# Words whose number is a label.
LABELS = [
    "tableau", "table", "figure", "fig.", "الجدول", "الشكل", "جدول", "شكل", "composante", "component", "étape", "step", "phase", "partie", "part", "section", "chapitre", "chapter",
    "annexe", "appendix", "objectif", "objective", "hypothèse", "hypothese", "hypothesis", "paragraphe", "paragraph", "§",
    "المكون", "المكوّن", "الملحق", "المرحلة", "القسم", "الفصل", "الجزء", "الفقرة", "البند", "الباب",
]

# Statistics acronyms (as written) and words (in any case; Arabic ones with or without the article).
STATISTICS_ACRONYMS = ["IC", "CI", "OR", "aOR", "ORa", "ORaj", "RR", "aRR", "RRa", "HR", "aHR", "RP", "PR", "IRR", "EIQ", "IIQ", "IQR", "SD", "ET", "DS"]
STATISTICS_WORDS = ["intervalle", "interval", "interquartile", "étendue", "moyenne", "average", "écart-type", "écart type", "standard deviation"]
STATISTICS_WHOLE_WORDS = ["range", "mean"]
STATISTICS_WORD_ENDS = ["médiane", "mediane", "médian", "median"]
STATISTICS_WORD_STARTS = ["min", "minimum", "max", "maximum"]
STATISTICS_ARABIC = [["فترة", "ثقة"], ["فاصل", "ثقة"], ["مجال", "ثقة"], ["مدى"], ["وسيط"], ["متوسط"], ["ربيعي"], ["نسبة", "أرجحية"]]
STATISTICS_ARABIC_PLAIN = ["الحد الأدنى", "الحد الأقصى", "أدنى", "أقصى", "انحراف"]
ARABIC_ARTICLE = "ال"

# What stands before a decimal without its zero, and what closes a word.
DECIMAL_OPENERS = "=<>≤≥±≈~(:;/["
CLOSERS = ")]»”\"’'"

# Words of citations.
CITATION_JOINERS = ["&", "and", "et", "و"]
ARABIC_AND_OTHERS = "آخرون"

# Headings that open the reference list, alone or as a part of a heading.
REFERENCE_HEADINGS = [
    "références", "references", "référence", "reference", "références bibliographiques", "references bibliographiques", "référence bibliographiques", "reference bibliographiques", "bibliographie", "bibliography",
    "references list", "reference list", "liste des références", "liste des references", "works cited",
    "المراجع", "قائمة المراجع", "المراجع والمصادر", "قائمة المراجع والمصادر", "المصادر", "المصادر والمراجع",
]
REFERENCE_WORDS = ["références", "references", "référence", "reference"]
REFERENCE_STEM = "bibliograph"
REFERENCE_ARABIC, REFERENCE_ARABIC_LIST = "المراجع", "قائمة"

# Openings of annexes, and of other sections after the reference list.  A last * stands for any ending.
ANNEXES = ["annexes", "annexe", "appendix", "appendices", "supplementary", "suppléments", "supplements", "supplément", "supplement", "الملاحق", "الملحق", "ملاحق", "ملحق"]
AFTER_REFERENCES = [
    *ANNEXES, "matériels suppl*", "matériel suppl*", "materiels suppl*", "materiel suppl*", "données suppl*", "donnees suppl*", "remerciements", "remerciement", "acknowledg*",
    "déclarations", "déclaration", "declarations", "declaration", "conflits d", "conflit d", "conflicts of", "conflict of", "financement", "funding", "contributions", "contribution",
    "disponibilité des données", "disponibilite des donnees", "data availability", "tableau", "table", "figure", "fig.", "encadré", "encadre",
    "شكر", "إقرار", "تصريح", "تمويل", "مساهم*", "الجدول", "جدول", "الشكل", "شكل",
]
NOTES = ["note", "nb", "n.b.", "remarque", "nota", "ملاحظة", "تنبيه"]

# Hand-typed bullets, particles of names, and small words inside names of organisations.
BULLETS = "•▪■◦‣·-–—*"
PARTICLES = ["van", "von", "de", "der", "den", "du", "da", "di", "le", "la", "el", "al", "bin", "ibn", "ben", "mac", "mc", "o'", "d'", "l'"]
ORGANISATION_WORDS = ["de", "du", "des", "la", "le", "et", "of", "and", "the", "for", "على", "في", "و"]

# Captions, titles that say nothing, titles whose number is a label.
TABLE_LABELS = ["tableau", "table", "الجدول", "جدول"]
FIGURE_LABELS = ["figure", "fig.", "الشكل", "شكل"]
GENERIC_TITLES = ["résultats", "résultat", "resultats", "resultat", "discussion", "méthodes", "méthode", "methodes", "methode", "introduction", "conclusion"]
TITLE_LABELS = [
    "chapitre", "chapter", "partie", "part", "section", "étape", "etape", "step", "phase", "axe", "axis", "objectif", "objective", "hypothèse", "hypothese", "hypothesis", "composante", "component",
    "الفصل", "الباب", "الجزء", "المحور", "الهدف", "المرحلة", "الخطوة",
]

# Galleries and styles of tables of contents and lists of figures.
NAVIGATION_GALLERIES = ["table of contents", "table des mati", "list of figures", "table of figures", "list of tables", "table des illustrations", "table des figures", "liste des"]
NAVIGATION_STYLES = ["toc", "tm ", "tm1", "tm2", "tm3", "tm4", "table of figures", "table des illustrations", "en-tête de table", "en-ttedetable", "tableoffigures", "tableofcontents", "contents"]
UNITS_BEFORE_RAISED = ["km", "cm", "mm", "dm", "µm", "m"]

# Seconds for each kind of slide.
SECONDS = {"title": 30, "section": 10, "bullets": 50, "two_columns": 55, "table": 60, "image": 50, "chart": 50, "closing": 10, "annex_marker": 0}
OTHER_SECONDS = 45
