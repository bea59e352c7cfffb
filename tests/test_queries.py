"""Every query of the workload against its SQL on the smallest tables, where a comparison of nothing fails."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from check import MAY_BE_EMPTY, compare, connect
from workload.registry import all_queries, all_sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_entry_runs(spark):
    assert entry_point.entry(spark).columns[0] == "entity_id"


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name], name in MAY_BE_EMPTY) == ""


@pytest.mark.parametrize("name", ["quality_report", "rule_hits"])
def test_the_reports_build_the_raw_rows_once(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
