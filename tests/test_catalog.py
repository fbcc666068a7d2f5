"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return "NULL"
        if isinstance(x, bool):
            return str(int(x))
        return repr(x.item() if hasattr(x, "item") else x)

    return sorted(tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
