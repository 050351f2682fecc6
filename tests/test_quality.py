from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick.operators import Check
from candlewick.plans.checks import CHECKS, EXTRA_CHECKS


def test_the_test_inventory():
    kinds = [c.kind for c in CHECKS]
    assert len(CHECKS) == 48 and len(EXTRA_CHECKS) == 1
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 31,
        "unique": 8,
        "unique_combination": 8,
        "single_current": 1,
    }


def test_each_check_finds_a_seeded_violation(spark):
    df = spark.createDataFrame(
        [(1, "a", True), (1, "a", True), (2, None, False), (None, "x", False), (None, "x", False)],
        "k int, v string, is_current boolean",
    )
    assert op.not_null(df, "k").count() == 2
    assert [tuple(r) for r in op.unique(df, "k").collect()] == [(1, 2)]
    assert sorted(map(tuple, op.unique_combination(df, ["k", "v"]).collect()), key=str) == [
        (1, "a", 2),
        (None, "x", 2),
    ]
    assert [tuple(r) for r in op.single_current(df, "k").collect()] == [(1, 2)]
    checks = [
        Check("m", "not_null", ("k",)),
        Check("m", "not_null", ("is_current",)),
        Check("m", "unique", ("k",)),
        Check("m", "unique_combination", ("k", "v")),
        Check("m", "single_current", ("k",)),
    ]
    got = {r.test_name: (r.violations, r.status) for r in op.report({"m": df}, checks).collect()}
    assert got == {
        "not_null_m_k": (2, "fail"),
        "not_null_m_is_current": (0, "pass"),
        "unique_m_k": (1, "fail"),
        "unique_combination_m_k_v": (2, "fail"),
        "single_current_m_k": (1, "fail"),
    }


def test_models_with_the_same_keys_of_the_same_rows_share_the_shuffle(spark, setting):
    setting(spark__sql__adaptive__enabled="false")
    rows = spark.range(8).selectExpr("nullif(id div 2, 3) AS k", "nullif(id, 5) AS v")
    checks = [Check(m, "not_null", (c,)) for m, c in (("whole", "k"), ("whole", "v"), ("keys", "k"))]
    checks += [Check(m, "unique_combination", ("k",)) for m in ("whole", "keys")]
    report = op.report({"whole": rows, "keys": rows.select("k")}, checks)
    assert {r.test_name: r.violations for r in report.collect()} == {
        "not_null_whole_k": 2,
        "not_null_whole_v": 1,
        "not_null_keys_k": 2,
        "unique_combination_whole_k": 4,
        "unique_combination_keys_k": 4,
    }
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_an_empty_table_passes(spark):
    empty = spark.createDataFrame([], "k int, v string")
    checks = [Check("m", "not_null", ("k",)), Check("m", "unique", ("k",))]
    assert [r.status for r in op.report({"m": empty}, checks).collect()] == ["pass", "pass"]


@pytest.mark.parametrize(
    ("limits", "status"),
    [
        ({}, "pass"),
        ({"warn_after_hours": 48}, "pass"),
        ({"warn_after_hours": 12}, "warn"),
        ({"warn_after_hours": 6, "error_after_hours": 12}, "error"),
    ],
)
def test_freshness(spark, limits, status):
    loaded = spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "_ingested_at timestamp")
    as_of = F.lit(datetime(2024, 1, 2))
    row = op.freshness({"t": loaded}, as_of=as_of, **limits).first()
    assert (row.table_name, row.last_loaded_at, row.status) == ("t", datetime(2024, 1, 1), status)
    never = op.freshness({"t": loaded.limit(0)}, as_of=as_of, **limits).first()
    assert never.last_loaded_at is None
