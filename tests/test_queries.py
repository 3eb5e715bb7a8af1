"""Every registered query that has an oracle, against DuckDB on a small scale."""

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == cols
    place = [want.columns.index(c) for c in cols]
    said = lambda x: f"{x:.9f}" if isinstance(x, float) else str(x)
    assert sorted(tuple(said(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(said(r[i]) for i in place) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
