"""Every registered query against its DuckDB statement, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tillworks.plans.registry import QUERIES
from tools.compare import compare, duck

STATEMENTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(STATEMENTS) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    run = entry.queries()[name]
    difference, _, _ = compare(spark, connection, SMALL, name, run, STATEMENTS[name])
    assert difference is None
    plan = run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() == 20
    assert rows.columns[0] == "ProductID"
