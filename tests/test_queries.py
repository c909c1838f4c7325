"""Every registered query against its SQL twin, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_and_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    row = entry_point.entry(spark).first()
    assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == 1000
