"""Every named query against its SQL counterpart, on the smallest tables."""
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from dayloom.catalog.oracles import ORACLES
from dayloom.catalog.queries import QUERIES
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 27
    assert df.count() > 0
