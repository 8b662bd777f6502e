"""Registered queries against their DuckDB SQL on the smallest fixture (sf0.001)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")

import __spark_entry__ as entry  # noqa: E402
from dimforge.oracle_check import compare, duckdb_views  # noqa: E402


QUERIES = entry.QUERIES
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF, key, QUERIES[key], entry.oracle_sql()[key], con)
    assert r["status"] == "MATCH", r


def test_every_query_has_an_oracle():
    """The optional text operators' queries are held to their own tests."""
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) & set(QUERIES) == set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["category_name_english", "total_orders", "total_items", "total_revenue",
                          "avg_price", "avg_freight"]
    assert df.count() > 0
