from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick.operators.incremental import exclude_identical, value_range


def test_no_target_returns_the_batch_unchanged(spark):
    batch = spark.range(3)
    assert op.exclude_existing(batch, None, ["id"]) is batch


def test_existing_keys_are_left_out_and_columns_keep_their_order(spark):
    batch = spark.createDataFrame([("x", 1, "a"), ("y", 2, "b"), ("z", 2, "c")], "v string, k int, j string")
    known = spark.createDataFrame([(1, "a"), (1, "a"), (2, "c"), (9, "b")], "k int, j string")
    fresh = op.exclude_existing(batch, known, ["k", "j"])
    assert fresh.columns == ["v", "k", "j"]
    assert [tuple(r) for r in fresh.collect()] == [("y", 2, "b")]


def test_duplicates_within_a_batch_stay(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    known = spark.createDataFrame([(2,)], "k int")
    fresh = op.exclude_existing(batch, known, ["k"])
    assert sorted(map(tuple, fresh.collect())) == [(1, "a"), (1, "b")]


def test_latest_wins_lets_only_newer_versions_pass(spark):
    batch = spark.createDataFrame([(1, 5), (1, 9), (2, 3), (3, 1)], "k int, _ingested_at int")
    known = spark.createDataFrame([(1, 5), (1, 7), (2, 3)], "k int, _ingested_at int")
    fresh = op.exclude_existing(batch, known, ["k"], policy="latest_wins")
    assert sorted(map(tuple, fresh.collect())) == [(1, 9), (3, 1)]
    with pytest.raises(ValueError, match="policy"):
        op.exclude_existing(batch, known, ["k"], policy="newest")


def test_a_missing_version_never_wins(spark):
    batch = spark.createDataFrame([(1, None), (2, None), (3, 4)], "k int, _ingested_at int")
    known = spark.createDataFrame([(1, 5), (2, None), (3, None)], "k int, _ingested_at int")
    fresh = op.exclude_existing(batch, known, ["k"], policy="latest_wins")
    assert [tuple(r) for r in fresh.collect()] == [(3, 4)]


def test_days_of_a_small_batch_take_in_whole_days(spark):
    rows = [("a", "2026-08-17 00:00:00"), ("b", "2026-08-17 23:59:59"), ("c", "2026-08-18 00:00:00")]
    known = spark.createDataFrame(rows, "k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    batch = spark.createDataFrame([("a", "2026-08-17 12:00:00"), ("b", "2026-08-17 12:00:00")], "k string, t string")
    batch = batch.withColumn("t", F.col("t").cast("timestamp"))
    day = {"d": F.col("t").cast("date")}
    fresh = op.exclude_existing(batch, known, ["k"], derived=day, key_range=value_range(batch, "t"))
    assert fresh.count() == 0


@pytest.mark.parametrize("policy", ["first_wins", "latest_wins"])
def test_a_small_batch_does_not_shuffle_the_stored_keys(spark, tmp_path, policy):
    path = str(tmp_path / "known")
    spark.range(50_000).select("id", F.lit(1).alias("_ingested_at")).write.parquet(path)
    known, batch = spark.read.parquet(path), spark.createDataFrame([(3, 1), (70_000, 1)], "id long, _ingested_at int")
    fresh = op.exclude_existing(batch, known, ["id"], policy=policy, small_batch=True)
    assert [r.id for r in fresh.collect()] == [70_000]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [id" in plan and "LeftSemi" in plan


def test_range_key_reads_only_the_range_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "known")
    spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("d")).write.parquet(path)
    known = spark.read.parquet(path)
    batch = spark.createDataFrame([(3, 990), (5, 990), (0, 1001), (1, -1)], "k long, d long")
    expected = [(0, 1001), (1, -1), (5, 990)]
    assert sorted(map(tuple, op.exclude_existing(batch, known, ["k", "d"]).collect())) == expected
    fresh = op.exclude_existing(batch, known, ["k", "d"], key_range=value_range(batch, "d"))
    assert sorted(map(tuple, fresh.collect())) == expected
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,-1), LessThanOrEqual(d,1001)" in plan


def test_null_keys_go_aside(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, j string")
    keyed, unkeyed = op.split_null_keys(df, ["k", "j"])
    assert [tuple(r) for r in keyed.collect()] == [(1, "a")]
    assert unkeyed.count() == 2


def test_identical_rows_match_on_nulls(spark):
    rows = [(None, "a", None), (None, "a", 1.5), (None, None, None)]
    df = spark.createDataFrame(rows, "k int, v string, x double")
    assert exclude_identical(df, None) is df
    assert exclude_identical(df, df).count() == 0
    assert exclude_identical(df, df.limit(0)).count() == 3
    other = spark.createDataFrame([(None, "a", 1.5)], df.schema)
    assert sorted(map(str, exclude_identical(df, other).collect())) == sorted(
        map(str, [r for r in df.collect() if r.x is None])
    )


def test_fingerprint_sees_changed_content_at_equal_counts(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "c")], "k int, v string")
    report = op.idempotency_report(op.fingerprint(one, "t"), op.fingerprint(two, "t")).first()
    assert (report.run_1, report.run_2, report.status) == (2, 2, "changed")
    same = op.idempotency_report(op.fingerprint(one, "t"), op.fingerprint(one.repartition(3), "t"))
    assert same.first().status == "ok"
    left = spark.createDataFrame([(None, "x")], "a string, b string")
    right = spark.createDataFrame([("x", None)], "a string, b string")
    moved = op.idempotency_report(op.fingerprint(left, "t"), op.fingerprint(right, "t"))
    assert moved.first().status == "changed"


def test_cast_rejects_counts_values_the_type_cannot_hold(spark):
    df = spark.createDataFrame([("2024-01-01", "1"), ("", "x"), (None, "2")], "d string, n string")
    counts = {r.column_name: r.rejected for r in op.cast_rejects(df, {"d": "date", "n": "int"}).collect()}
    assert counts == {"d": 1, "n": 1}


def test_a_batch_that_is_known_is_not_shuffled_whole(spark, tmp_path):
    from candlewick.operators import exclude_existing

    batch = spark.createDataFrame([(i // 2, f"{i}") for i in range(40)] + [(50, "n"), (50, "n"), (51, "m")], "k long, v string")
    have = spark.createDataFrame([(i,) for i in range(20)] * 2, "k long")

    def stored(df):
        df.write.parquet(str(tmp_path / "new"))
        return spark.read.schema(df.schema).parquet(str(tmp_path / "new"))

    fresh = exclude_existing(batch, have, ["k"], stored=stored)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, fresh.collect())) == [(50, "n"), (50, "n"), (51, "m")]
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
