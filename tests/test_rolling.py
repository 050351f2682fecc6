from __future__ import annotations

import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.operators import bar_metrics, day_spine
from candlewick.plans import gold
from candlewick.sources.tables import replace_table

START = date(2024, 1, 1)


def bars(spark, closes, volumes=None, ticker="T"):
    volumes = volumes or [100] * len(closes)
    rows = [
        (ticker, START + timedelta(days=3 * i), c, v)
        for i, (c, v) in enumerate(zip(closes, volumes, strict=True))
    ]
    return spark.createDataFrame(rows, "ticker string, trade_date date, close_price double, volume bigint")


def test_return_is_against_the_previous_row(spark):
    got = gold.fct_daily_returns(bars(spark, [100.0, 103.125, 0.0, 5.0, None, 7.0])).orderBy("trade_date")
    out = [(r.prev_close_price, r.daily_return, r.is_significant_move) for r in got.collect()]
    assert out[0] == (None, None, None)
    assert out[1] == (100.0, 0.03125, True)
    assert out[2] == (103.125, -1.0, True)
    assert out[3] == (0.0, None, None)
    assert out[4] == (5.0, None, None)
    assert out[5] == (None, None, None)


@pytest.mark.parametrize(
    ("close", "threshold", "flag"),
    [(102.9, 0.03, False), (103.1, 0.03, True), (97.1, 0.03, False), (96.9, 0.03, True), (103.125, 0.03125, True)],
)
def test_threshold_is_inclusive(spark, close, threshold, flag):
    got = gold.fct_daily_returns(bars(spark, [100.0, close]), threshold).orderBy("trade_date").collect()
    assert got[1].is_significant_move is flag


@pytest.mark.parametrize("n", [1, 5, 20, 51])
def test_partial_windows_average_what_exists(spark, n):
    closes = [100.0 + (i * 37) % 11 for i in range(n)]
    got = gold.fct_moving_averages(bars(spark, closes)).orderBy("trade_date").collect()
    last = got[-1]
    for size in (5, 20, 50):
        assert last[f"moving_avg_{size}d"] == pytest.approx(statistics.mean(closes[-size:]))
    if n == 1:
        assert last.volatility_20d is None
    else:
        assert last.volatility_20d == pytest.approx(statistics.stdev(closes[-20:]))
    assert all(r.trend == "sideways" for r in got[:5])


def test_all_trends_occur(spark):
    closes = [100.0] * 20 + [130.0] * 10 + [60.0] * 20
    trends = {r.trend for r in gold.fct_moving_averages(bars(spark, closes)).collect()}
    assert trends == {"uptrend", "downtrend", "sideways"}


def test_volume_baseline_leaves_the_current_row_out(spark):
    got = gold.fct_volume_anomalies(bars(spark, [1.0] * 4, [100, 100, 200, 0])).orderBy("trade_date").collect()
    assert [(r.avg_volume_20d, r.volume_ratio, r.is_volume_spike) for r in got] == [
        (None, None, None),
        (100.0, 1.0, False),
        (100.0, 2.0, True),
        (pytest.approx(400 / 3), 0.0, False),
    ]


def test_zero_baseline_gives_null(spark):
    got = gold.fct_volume_anomalies(bars(spark, [1.0] * 2, [0, 5])).orderBy("trade_date").collect()
    assert (got[1].avg_volume_20d, got[1].volume_ratio, got[1].is_volume_spike) == (0.0, None, None)


def test_all_metrics_take_one_shuffle_and_equal_the_separate_facts(spark):
    frame = bars(spark, [100.0 + (i * 37) % 11 for i in range(60)], [(i * 7) % 13 for i in range(60)])
    both = bar_metrics(frame.repartition(3))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    for fact in (gold.fct_daily_returns, gold.fct_moving_averages, gold.fct_volume_anomalies):
        one = fact(frame)
        assert one.exceptAll(both.select(*one.columns)).isEmpty()


def test_unused_columns_do_not_enter_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, [1.0]).withColumn("open_price", F.lit(1.0)).write.parquet(path)
    plan = (
        gold.fct_volume_anomalies(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    )
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line).split("ReadSchema")[1]
    assert "volume" in schema and "close_price" not in schema and "open_price" not in schema


def test_bucketed_bars_need_no_shuffle(spark, db):
    frame = bars(spark, [100.0 + i for i in range(30)])
    replace_table(frame, f"{db}.bars", bucket_by="ticker", buckets=4, sort_by=["trade_date"])
    stored = spark.table(f"{db}.bars")
    for fact in (gold.fct_daily_returns, gold.fct_moving_averages, gold.fct_volume_anomalies):
        plan = fact(stored)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    assert fact(stored).count() == 30


def test_spine_of_a_single_day(spark):
    one = spark.createDataFrame([(START,), (START,)], "d date")
    days = day_spine(one, "d").orderBy("date_day").collect()
    assert len(days) == 30
    assert days[-1].date_day == START + timedelta(days=29)
    assert (days[0].day_of_week, days[0].day_name, days[0].is_trading_day) == (2, "Monday", True)
    assert [d.day_name for d in days if d.is_weekend][:2] == ["Saturday", "Sunday"]
    assert {d.day_of_week for d in days if d.is_weekend} == {1, 7}


def test_spine_of_nothing(spark):
    assert day_spine(spark.createDataFrame([], "d date"), "d").count() == 0
