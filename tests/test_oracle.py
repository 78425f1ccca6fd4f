"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same compare at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from chanlake.plans import catalog
from tools.oracle_check import TABLES, canon, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(df.columns) > 0
        return
    rel = con.sql(sql)
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(rel.columns, rel.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "message" in df.columns
