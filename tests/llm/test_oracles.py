"""Queries of this subpackage that have a DuckDB twin, compared value by value."""

import pytest
from oracle_check import compare, duck

from zoneflow.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_duckdb(spark, name):
    r = compare(spark, name, catalog.QUERIES[name], catalog.SQL[name], SF, duck(SF))
    assert r["status"] == "ok", r
