"""The odd rows of odd_rows.py as a table."""

import pytest
from odd_rows import CLASHES, made


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text)"""
    return made()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with a column for each clashing name, whose values follow from the row's place."""
    return spark.createDataFrame([(k, x, *(f"{c}{i}" for c in CLASHES)) for i, (k, x) in enumerate(rows)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
