"""Every catalogue query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL
from eqlake.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = sorted(set(catalog.QUERIES) - set(E.oracle_sql()))
    assert missing == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "processed_value" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    s_idx = [cols.index(c) for c in sorted(cols)]
    o_idx = [ocols.index(c) for c in sorted(cols)]
    assert len(srows) == len(orows)
    assert _key([tuple(r[i] for i in s_idx) for r in srows]) == _key([tuple(r[i] for i in o_idx) for r in orows])
