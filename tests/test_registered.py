"""Every registered query against its SQL counterpart, and the shape of some plans."""

from __future__ import annotations

import os

import pytest
from oracle_compare import difference, oracle_connection

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from candlewick.bindings import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def queries():
    """Without the optional ones, which have tests of their own."""
    return QUERIES


def test_every_query_has_a_counterpart():
    assert set(queries()) <= set(oracle_sql())
    assert set(queries()) | set(oracle_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_oracle(spark, oracle, name):
    assert difference(queries()[name](spark, SF_DIR), oracle, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(set(queries()) - {"dim_date"}))
def test_no_window_or_sort_gathers_all_rows_in_one_task(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" +-:") for line in plan.splitlines()]
    for at, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            # only partial aggregates (one row per task) may be gathered
            below = next(x for x in lines[at + 1 :] if not x.startswith(("Project", "InputAdapter")))
            assert "partial_" in below or "HashAggregate" in below or "ObjectHashAggregate" in below
        assert not line.startswith(("CartesianProduct", "BroadcastNestedLoopJoin"))
        assert "BatchEvalPython" not in line and "ArrowEvalPython" not in line
