"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from martstar import registry
from scripts.oracle_check import TABLES, digest
from tests.conftest import SF_SMALL

# the corpus queries have their own tests
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}
SQLS = {k: v for k, v in E.oracle_sql().items() if k in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQLS) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQLS[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["symbol", "company_name", "trade_date"]
    assert df.count() >= 0
