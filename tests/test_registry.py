"""Every registered query against its SQL on the smallest tables, and what the plans look like."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from checks.compare import differences, duckdb_tables
from checks.registry import QUERIES

TABLES = "/root/testdata/sf0.001"
# Queries without rows on the smallest tables are held against their SQL on the next larger ones.
LARGER = "/root/testdata/sf0.01"
SPARSE = ["bunching", "silver_events", "headway_adherence", "operator_performance", "top_routes_by_delay", "top15_operators", "operator_performance_csv", "dq_unique_violations"]


@pytest.fixture(scope="module")
def duckdb():
    return duckdb_tables(TABLES)


def test_every_query_has_sql_and_the_other_way_round():
    assert QUERIES.keys() <= entry_module.oracle_sql().keys()
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duckdb, name):
    assert differences(QUERIES[name](spark, TABLES), duckdb, entry_module.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", SPARSE)
def test_sparse_queries_have_rows_and_equal_their_sql(spark, name):
    result = QUERIES[name](spark, LARGER)
    assert differences(result, duckdb_tables(LARGER), entry_module.oracle_sql()[name]) is None
    assert not result.isEmpty()


def test_flagship_query_has_rows(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 15


@pytest.mark.parametrize("name", ["silver_events", "staged_events", "operator_performance", "headway_adherence", "operator_history", "delay_trend_1min"])
def test_plans_stay_in_the_jvm_and_pair_up_nothing(spark, name):
    plan = QUERIES[name](spark, TABLES)._jdf.queryExecution().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
        assert unwanted not in plan
    assert "PushedFilters: [IsNotNull(event_type)" in plan
