"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical
from inciscope.bindings import catalog

SF = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


def test_flagship(spark):
    assert entry.entry(spark).columns[:3] == ["district_code", "district_name", "incident_year"]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, found) == canonical(columns, result.fetchall())
