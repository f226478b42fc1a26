"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck
from tripflow import registry
from tripflow.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = registry.QUERIES
SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] == "match", r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
