"""Every query runs on the smallest tables, and those with SQL give its rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables(small):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) and len(SQL) > 35


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, small, tables, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    mine = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    cur = tables.execute(SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert mine == sorted(repr([plain(r[i]) for i in at]) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
