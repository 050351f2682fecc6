from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from candlewick.functions import epoch_ms_to_date, guarded_ratio, relative_path, trend_label


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_epoch_day_does_not_follow_the_session_zone(spark, setting, zone):
    setting(spark__sql__session__timeZone=zone)
    df = spark.createDataFrame([(1692331200000,), (-1,), (0,), (None,)], "ms bigint")
    days = [str(r[0]) for r in df.select(epoch_ms_to_date(F.col("ms"))).collect()]
    assert days == ["2023-08-18", "1969-12-31", "1970-01-01", "None"]


@pytest.mark.parametrize("ms", [1692331200000 * 1000, 1692331200000 * 10**6, -(2**63), 2**63 - 1])
def test_a_time_in_another_unit_is_no_day(spark, ms):
    df = spark.createDataFrame([(ms,)], "ms bigint")
    assert df.select(epoch_ms_to_date(F.col("ms"))).first()[0] is None


def test_guarded_ratio_is_null_for_null_and_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()] == [
        0.5,
        None,
        None,
        None,
    ]


def test_trend_band_edges_are_sideways(spark):
    slow = 100.0
    rows = [(slow * 1.01, slow), (101.5, slow), (slow * 0.99, slow), (98.0, slow), (100.0, None)]
    df = spark.createDataFrame(rows, "fast double, slow double")
    labels = [r[0] for r in df.select(trend_label(F.col("fast"), F.col("slow"), 0.01)).collect()]
    assert labels == ["sideways", "uptrend", "sideways", "downtrend", None]


@pytest.mark.parametrize(
    ("path", "root", "expected"),
    [
        ("/lake/dev/raw_data/bars/date=2026-08-17/a.jsonl", "/lake/dev/raw_data", "bars/date=2026-08-17/a.jsonl"),
        ("/lake/dev/raw_data/x.jsonl", "/lake/dev/raw_data//", "x.jsonl"),
        ("dbfs:/lake/dev/raw_data/bars/a.jsonl", "/lake/dev/raw_data", "bars/a.jsonl"),
        ("/lake/dev/raw_data/bars/a.jsonl", "dbfs:/lake/dev/raw_data/", "bars/a.jsonl"),
        ("file:///lake/a.jsonl", "file:/lake", "a.jsonl"),
        ("s3a://bucket/lake/a.jsonl", "s3a://bucket/lake", "a.jsonl"),
        ("s3://other/lake/a.jsonl", "s3://mine/lake", None),
        ("s3://mine/lake/a.jsonl", "/lake", "a.jsonl"),
        ("file:/lake/a.jsonl", "file://host/lake", "a.jsonl"),
        ("/lake/dev/raw_data_old/a.jsonl", "/lake/dev/raw_data", None),
    ],
)
def test_relative_path(spark, path, root, expected):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(relative_path(F.col("p"), root)).first()[0] == expected
