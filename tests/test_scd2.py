from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick.plans import gold

CHECK = ["a", "b"]
STATE = "k int, a string, b int, valid_from date, valid_to date"
D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def merge(spark, state, current, run):
    return op.scd2_merge(
        spark.createDataFrame(state, STATE),
        spark.createDataFrame(current, "k int, a string, b int"),
        "k",
        CHECK,
        F.lit(run),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(
    ("state", "current", "expected"),
    [
        pytest.param([], [(1, "x", 1)], [(1, "x", 1, D2, None)], id="new"),
        pytest.param([(1, "x", 1, D1, None)], [(1, "x", 1)], [(1, "x", 1, D1, None)], id="unchanged"),
        pytest.param(
            [(1, "x", 1, D1, None)],
            [(1, "y", 1)],
            [(1, "x", 1, D1, D2), (1, "y", 1, D2, None)],
            id="changed",
        ),
        pytest.param(
            [(1, None, 1, D1, None)],
            [(1, "x", 1)],
            [(1, None, 1, D1, D2), (1, "x", 1, D2, None)],
            id="null to value",
        ),
        pytest.param([(1, None, 1, D1, None)], [(1, None, 1)], [(1, None, 1, D1, None)], id="null stays"),
        pytest.param([(1, "x", 1, D1, None)], [], [(1, "x", 1, D1, None)], id="key gone stays open"),
        pytest.param([], [(None, "x", 1)], [], id="no key"),
        pytest.param(
            [(1, "x", 1, date(2023, 1, 1), D1), (1, "y", 1, D1, None)],
            [(1, "x", 1)],
            [
                (1, "x", 1, date(2023, 1, 1), D1),
                (1, "x", 1, D2, None),
                (1, "y", 1, D1, D2),
            ],
            id="back to an old value",
        ),
    ],
)
def test_merge(spark, state, current, expected):
    got = merge(spark, state, current, D2)
    assert got.columns == ["k", "a", "b", "valid_from", "valid_to"]
    assert rows(got) == sorted(expected, key=str)


def test_folding_merges_equals_one_pass_over_the_history(spark):
    rng = random.Random(3)
    snapshots = {}
    for n in range(6):
        day = D1 + timedelta(days=7 * n)
        snapshots[day] = [
            (k, rng.choice(["x", "y", None]), rng.choice([1, None]))
            for k in range(12)
            if rng.random() < 0.8
        ]
    state = spark.createDataFrame([], STATE)
    for day, current in snapshots.items():
        merged = merge_onto(spark, state, current, day)
        state = spark.createDataFrame(merged.collect(), STATE)
    everything = [(k, a, b, day) for day, current in snapshots.items() for k, a, b in current]
    versions = spark.createDataFrame(everything, "k int, a string, b int, at date")
    assert rows(state) == rows(op.scd2_history(versions, "k", CHECK, "at"))


def merge_onto(spark, state, current, run):
    return op.scd2_merge(
        state, spark.createDataFrame(current, "k int, a string, b int"), "k", CHECK, F.lit(run)
    )


def test_history_of_a_b_a_has_three_versions(spark):
    versions = spark.createDataFrame(
        [(1, "A", 1, D1), (1, "B", 1, D2), (1, "A", 1, D3)], "k int, a string, b int, at date"
    )
    got = op.scd2_history(versions, "k", CHECK, "at").orderBy("valid_from").collect()
    assert [(r.a, r.valid_from, r.valid_to) for r in got] == [("A", D1, D2), ("B", D2, D3), ("A", D3, None)]


def test_history_needs_one_shuffle(spark):
    versions = spark.createDataFrame([(1, "A", 1, D1)], "k int, a string, b int, at date").repartition(3)
    plan = op.scd2_history(versions, "k", CHECK, "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_closed_history_takes_no_part_in_the_merge_join(spark, tmp_path):
    path = str(tmp_path / "state")
    spark.createDataFrame([(1, "x", 1, D1, D2), (1, "y", 1, D2, None)], STATE).write.parquet(path)
    merged = op.scd2_merge(
        spark.read.parquet(path),
        spark.createDataFrame([(1, "y", 1)], "k int, a string, b int"),
        "k",
        CHECK,
        F.lit(D3),
    )
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(valid_to)" in plan and "PushedFilters: [IsNotNull(valid_to)" in plan


def test_dim_ticker_flags_the_open_version(spark):
    columns = "ticker string, name string, primary_exchange string, sic_code string, type string, active boolean, currency_name string, valid_from date, valid_to date"
    snapshot = spark.createDataFrame(
        [("T", "n", "x", "1", "CS", True, "usd", D1, D2), ("T", "m", "x", "1", "CS", True, "usd", D2, None)],
        columns,
    )
    dim = gold.dim_ticker(snapshot)
    assert dim.columns[-3:] == ["valid_from", "valid_to", "is_current"]
    assert {r.name: r.is_current for r in dim.collect()} == {"n": False, "m": True}
