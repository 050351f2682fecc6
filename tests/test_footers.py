from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from candlewick.sources import footers
from candlewick.sources.footers import bounds
from candlewick.sources.tables import append_table, replace_table

SCHEMA = "id long, day date, at timestamp, v double, s string"
ROWS = [
    (1, date(2024, 1, 5), datetime(2024, 1, 5, 10, 0, 0, 123456), 1.0, "a"),
    (2, None, None, None, None),
    (-7, date(1890, 2, 1), datetime(1890, 2, 1, 3), 2.0, "b"),
    (9, date(2190, 12, 31), datetime(2190, 12, 31, 23, 59, 59, 999999), 3.0, "c"),
]


def values(spark, found):
    return {c: tuple(spark.range(1).select(low, high).first()) for c, (low, high) in found.items()}


@pytest.fixture
def table(spark, db):
    for row in (ROWS[:2], ROWS[2:]):
        append_table(spark.createDataFrame(row, SCHEMA).repartition(1), f"{db}.t")
    return f"{db}.t"


EXPECTED = {"id": (-7, 9), "day": (date(1890, 2, 1), date(2190, 12, 31)), "at": (ROWS[2][2], ROWS[3][2])}


def test_bounds_come_from_footers(spark, table, monkeypatch):
    planned = footers._ends

    def ends(rows, columns):
        found = planned(rows, columns)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan" in plan and "PushedAggregation: [MIN(" in plan, plan
        return found

    monkeypatch.setattr(footers, "_ends", ends)
    assert values(spark, bounds(spark, table, ["id", "day", "at"])) == EXPECTED


def test_settings_are_as_before(spark, table):
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown", "spark.sql.parquet.outputTimestampType")
    before = [spark.conf.get(k) for k in keys]
    bounds(spark, table, ["id"])
    append_table(spark.createDataFrame(ROWS, SCHEMA), table)
    assert [spark.conf.get(k) for k in keys] == before


def test_files_without_statistics_are_scanned(spark, db, table, setting):
    append_table(spark.createDataFrame([ROWS[1]], SCHEMA).repartition(1), table)  # NULL throughout
    assert values(spark, bounds(spark, table, ["id", "day", "at"])) == EXPECTED
    setting(spark__sql__parquet__outputTimestampType="INT96")
    spark.createDataFrame(ROWS, SCHEMA).write.saveAsTable(f"{db}.old")
    assert values(spark, bounds(spark, f"{db}.old", ["at"])) == {"at": EXPECTED["at"]}


def test_empty_and_null_tables(spark, db):
    nothing = {"id": (None, None), "at": (None, None)}
    append_table(spark.createDataFrame([], SCHEMA), f"{db}.empty")
    assert values(spark, bounds(spark, f"{db}.empty", ["id", "at"])) == nothing
    append_table(spark.createDataFrame([ROWS[1]], SCHEMA).withColumn("id", F.lit(None).cast("long")), f"{db}.null")
    assert values(spark, bounds(spark, f"{db}.null", ["id", "at"])) == nothing


def test_partitions_and_buckets(spark, db):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS part", "date_add(date'2024-01-01', cast(id AS int)) AS day")
    replace_table(rows, f"{db}.p", part_by="part")
    replace_table(rows, f"{db}.b", bucket_by="part", buckets=2)
    for name in ("p", "b"):
        assert values(spark, bounds(spark, f"{db}.{name}", ["id", "day"])) == {
            "id": (0, 999),
            "day": (date(2024, 1, 1), date(2026, 9, 26)),
        }


def test_a_column_behind_a_nested_one(spark, db):
    rows = spark.range(100).selectExpr("struct(id + 1000 AS a, id + 2000 AS b) AS n", "id", "array(id + 5000) AS more")
    append_table(rows, f"{db}.n")
    assert values(spark, bounds(spark, f"{db}.n", ["id"])) == {"id": (0, 99)}


def test_kinds_that_footers_do_not_answer(spark, table):
    for column in ("v", "s"):
        with pytest.raises(ValueError, match="footer"):
            bounds(spark, table, [column])
    with pytest.raises(ValueError, match="no table"):
        bounds(spark, f"{table}_none", ["id"])
