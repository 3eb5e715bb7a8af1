"""Command line of the steps: python -m veriforge ledger|translation|deck|typeset ...

A report with findings ends with 1, a refused step with 2, like a failed check in a script.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import steps


def _pairs(given: list[str]) -> dict[str, str]:
    return dict(x.split("=", 1) for x in given)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="veriforge", description=__doc__)
    commands = parser.add_subparsers(dest="step", required=True)

    def command(name: str, told: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=told)
        c.add_argument("folder", help="<folder>/<project>/<file>")
        c.add_argument("out", help="folder of the results")
        return c

    ledger = command("ledger", "read sources into a ledger")
    ledger.add_argument("--old", help="results of an older run, whose hand-made items are carried over")
    translation, deck = command("translation", "hold translations against a ledger"), command("deck", "hold slides against a ledger")
    for c in (ledger, translation, deck):
        c.add_argument("--locale", default="fr", choices=("fr", "en", "ar"))
    for c in (ledger, translation):
        c.add_argument("--paper-locale", action="append", default=[], metavar="PAPER=LOCALE")
    for c in (translation, deck):
        c.add_argument("--ledger", required=True, help="results of the ledger step")
        c.add_argument("--ignore", action="append", default=[], help="a text whose numbers are tolerated")
    command("typeset", "write Markdown files as .docx").add_argument("--lang", default="fr", choices=("fr", "en", "ar"))
    return parser


def main(given: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _arguments().parse_args(given)
    spark = spark or SparkSession.builder.appName("veriforge").getOrCreate()
    try:
        if a.step == "ledger":
            steps.build_ledger(spark, a.folder, a.out, a.locale, _pairs(a.paper_locale), a.old).show(truncate=False)
            return 0
        if a.step == "typeset":
            print(steps.typeset(spark, a.folder, a.out, a.lang), "files")
            return 0
        if a.step == "translation":
            verdicts = steps.translation(spark, a.ledger, a.folder, a.out, a.locale, _pairs(a.paper_locale), a.ignore)
            bad = "verdict <> 'attestable'"
        else:
            verdicts = steps.deck(spark, a.ledger, a.folder, a.out, a.locale, a.ignore)
            bad = "verdict <> 'lockable'"
        verdicts.show(truncate=False)
        return int(not verdicts.where(bad).isEmpty())
    except steps.Refused as e:
        print(f"refused: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
