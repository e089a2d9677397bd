"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry
from orderloom.plans import catalog
from orderloom.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
_spec = importlib.util.spec_from_file_location(
    "compare_tool", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "compare.py"))
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)

QUERIES = catalog.queries()
ORACLES = catalog.oracles()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    a, ca = compare.rows_of(df.columns, df.collect())
    rel = con.execute(ORACLES[name])
    b, cb = compare.rows_of([d[0] for d in rel.description], rel.fetchall())
    assert ca == cb
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "release_id" in df.columns
