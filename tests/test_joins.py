from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op

START = date(2020, 1, 1)


def day(n: int) -> date:
    return START + timedelta(days=n)


def versions(rng, tickers):
    rows = []
    for t in tickers:
        starts = sorted(rng.sample(range(0, 400), rng.randint(1, 6)))
        for i, s in enumerate(starts):
            end = day(starts[i + 1]) if i + 1 < len(starts) else None
            rows.append((t, f"{t}-{i}", day(s), end))
    return rows


@pytest.mark.parametrize("bucket_days", [1, 7, 64, 1000])
@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_join_equals_brute_force(spark, bucket_days, closed, how):
    rng = random.Random(bucket_days)
    dims = versions(rng, [None, *range(8)])
    facts = [(i, rng.choice([None, 1, 1, 1, *range(10)]), day(rng.randint(-50, 500))) for i in range(300)]
    facts += [(1000 + i, t, s) for i, (t, _, s, _) in enumerate(dims)]  # on every boundary
    expected = []
    for i, t, d in facts:
        found = [
            name
            for k, name, lo, hi in dims
            if t is not None and k == t and lo <= d and (hi is None or d < hi or (closed and d == hi))
        ]
        expected += [(i, name) for name in found or ([None] if how == "left" else [])]
    fact = spark.createDataFrame(facts, "id int, t int, d date")
    dim = spark.createDataFrame(dims, "t int, name string, valid_from date, valid_to date")
    got = op.asof_join(fact, dim, "t", "d", closed=closed, how=how, bucket_days=bucket_days)
    assert got.columns == ["id", "t", "d", "name", "valid_from", "valid_to"]
    assert sorted(((r.id, r.name) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_asof_join_with_timestamps_and_given_range(spark):
    dim = spark.sql(
        """SELECT 1 AS t, 'a' AS name, timestamp'2020-01-01 10:00:00' AS valid_from,
                  timestamp'2020-03-01 00:00:00' AS valid_to
           UNION ALL SELECT 1, 'b', timestamp'2020-03-01 00:00:00', CAST(NULL AS timestamp)"""
    )
    fact = spark.createDataFrame(
        [(1, day(0)), (1, day(1)), (1, date(2020, 3, 1)), (1, date(2021, 3, 1))], "t int, d date"
    )
    limits = (F.lit(day(0)), F.lit(date(2021, 3, 1)))
    got = op.asof_join(fact, dim, "t", "d", date_range=limits).orderBy("d")
    assert [(str(r.d), r.name) for r in got.collect()] == [
        ("2020-01-02", "a"),
        ("2020-03-01", "b"),
        ("2021-03-01", "b"),
    ]


def test_asof_join_of_no_facts(spark):
    fact = spark.createDataFrame([], "t int, d date")
    dim = spark.createDataFrame([(1, day(0), None)], "t int, valid_from date, valid_to date")
    assert op.asof_join(fact, dim, "t", "d").count() == 0


def test_asof_join_rejects_shared_columns_and_other_joins(spark):
    fact = spark.createDataFrame([(1, day(0), "x")], "t int, d date, name string")
    dim = spark.createDataFrame([(1, "y", day(0), None)], "t int, name string, valid_from date, valid_to date")
    with pytest.raises(ValueError, match="share"):
        op.asof_join(fact, dim, "t", "d")
    with pytest.raises(ValueError, match="inner or left"):
        op.asof_join(fact, dim, "t", "d", how="full")


def test_current_lookup_keeps_one_row_per_fact(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "t int, x int")
    dim = spark.createDataFrame([(1, "old", False), (1, "new", True), (2, "only", True)], "t int, name string, is_current boolean")
    assert sorted((r.t, r.name) for r in op.current_lookup(fact, dim, "t").collect()) == [(1, "new"), (2, "only")]
    assert op.current_lookup(fact, dim, "t", how="left").count() == 3


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_a_hot_key_is_split(spark, setting, how):
    """A third of the left rows share one key, and the left side comes from a dedup on other columns."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__shuffle__partitions="32",
    )
    n = 300_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("k"),
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    left = op.dedup_latest(rows, ["k", "id"], [F.col("text").desc()])
    right = op.dedup_latest(
        spark.range(10_000).select(F.col("id").alias("k"), F.lit("r").alias("r")), ["k"], [F.col("r").desc()]
    )
    joined = op.spread_join(left, right, ["k"], how)
    count = joined._jdf.queryExecution().toRdd().count()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
    matched = rows.filter("k < 10000").count()
    assert count == {"inner": matched, "left_semi": matched, "left": n, "left_anti": n - matched}[how]
