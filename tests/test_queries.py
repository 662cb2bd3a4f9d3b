import pytest
from compare import compare, open_duckdb

import __spark_entry__ as entry
from headrace.catalogue import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name)) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "o_orderkey"
