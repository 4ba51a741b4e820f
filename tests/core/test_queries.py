"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{ROOT}/{t}.parquet'")
    return con


def rows(frame, columns):
    def one(x):
        if pd.isna(x):
            return "null"
        return f"{float(x):.7g}" if isinstance(x, (bool, int, float)) or hasattr(x, "dtype") else str(x)

    return sorted(tuple(one(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n != "pipeline"))
def test_query(spark, sql, name):
    got, want = entry.queries()[name](spark, ROOT).toPandas(), sql.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
