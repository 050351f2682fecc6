from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from datetime import UTC, date, datetime

import lake
import pytest
from pyspark.sql import functions as F

from candlewick.plans import bronze, build
from candlewick.sources import TABLES, promote, promotion
from candlewick.sources.landing import line_writer
from candlewick.streaming import stream_table


@pytest.fixture
def env(spark, tmp_path):
    """An environment with its own landing folder and databases."""

    def make(label):
        names = {layer: f"{label}_{layer}_{uuid.uuid4().hex[:8]}" for layer in ("bronze", "silver", "gold")}
        for name in names.values():
            spark.sql(f"CREATE DATABASE {name}")
        return build.Lake(str(tmp_path / label), ticker_buckets=4, **names)

    return make


def test_landing_to_facts_and_back_again(spark, env):
    lake_env = env("dev")
    lake.fill(lake_env.landing_root)
    bronze.load_bronze(spark, landing_root=lake_env.landing_root, schema=lake_env.bronze)
    build.build(spark, lake_env, datetime(2026, 8, 17, 12, tzinfo=UTC))
    gold = lake_env.gold
    counts = {m: spark.table(f"{gold}.{m}").count() for m in build.GOLD}
    assert counts == {
        "dim_ticker": 2,
        "dim_date": 60 + 29,
        "dim_publisher": 1,
        "dim_industry": 1,
        "fct_daily_bars": 120,
        "fct_ticker_daily_metrics": 2,
        "fct_splits": 2,
        "fct_dividends": 2,
        "fct_news_sentiment": 4,
        "fct_daily_returns": 120,
        "fct_moving_averages": 120,
        "fct_volume_anomalies": 120,
    }
    spikes = spark.table(f"{gold}.fct_volume_anomalies").filter("is_volume_spike")
    assert spikes.count() == 2
    assert spark.table(f"{gold}.fct_daily_returns").filter("is_significant_move").count() > 0
    report = {r.test_name: r.status for r in build.quality_report(spark, lake_env).collect()}
    assert len([n for n in report if not n.startswith("castable")]) == 49
    assert set(report.values()) == {"pass"}
    fresh = build.freshness_report(spark, lake_env).collect()
    assert len(fresh) == 6 and {r.status for r in fresh} == {"pass"}
    assert build.landing_rejects(spark, lake_env).filter("violations > 0").isEmpty()

    # a week later one company has a new name
    later = {"ingested": "2026-08-24T10:00:00+00:00"}
    root = lake_env.landing_root
    lake.write(root, "ticker_overview", "2026-08-24", [lake.overview("AAPL", "Apple")], **later)
    lake.write(root, "ticker_overview", "2026-08-24", [lake.overview("MSFT")], ticker="MSFT", **later)
    bronze.load_bronze(spark, landing_root=root, schema=lake_env.bronze)
    for _ in range(2):
        build.build(spark, lake_env, datetime(2026, 8, 24, 12, tzinfo=UTC))
    versions = spark.table(f"{gold}.dim_ticker").orderBy("ticker", "valid_from").collect()
    # The first version of both was named alike by the fixture; only AAPL has changed.
    assert [(r.ticker, r.name, str(r.valid_from), r.is_current) for r in versions] == [
        ("AAPL", "Apple Inc.", "2026-08-17 12:00:00", False),
        ("AAPL", "Apple", "2026-08-24 12:00:00", True),
        ("MSFT", "Apple Inc.", "2026-08-17 12:00:00", True),
    ]
    assert str(versions[0].valid_to) == "2026-08-24 12:00:00"


def test_a_failing_check_keeps_the_old_table(spark, env):
    lake_env = env("dev")
    lake.fill(lake_env.landing_root, days=3)
    bronze.load_bronze(spark, landing_root=lake_env.landing_root, schema=lake_env.bronze)
    build.build_silver(spark, lake_env)
    bad = spark.table(f"{lake_env.bronze}.daily_bars").limit(1).withColumn("close_price", F.lit(None).cast("double"))
    bad.withColumn("trade_date", F.lit(date(2030, 1, 1))).write.insertInto(f"{lake_env.bronze}.daily_bars")
    with pytest.raises(build.CheckFailed, match="not_null_stg_daily_bars_close_price: 1"):
        build.build_silver(spark, lake_env)
    assert spark.table(f"{lake_env.silver}.stg_daily_bars").count() == 6


def test_promotion_copies_each_file_once_and_loads_the_target(spark, env):
    dev, prod = env("dev"), env("prod")
    lake.fill(dev.landing_root, days=5)
    first = build.promote_and_load(spark, dev, prod)
    assert first["daily_bars"]["appended"] == 10
    ledger = spark.table(f"{prod.bronze}.promoted_files")
    assert ledger.count() == 10
    assert {p.split("/")[1] for (p,) in ledger.select("relative_path").collect()} == {"date=2026-08-17"}

    def lines():
        return spark.read.text(f"{prod.landing_root}/daily_bars").count()

    assert lines() == 10
    again = build.promote_and_load(spark, dev, prod)
    assert lines() == 10
    assert all(c == {"appended": 0, "quarantined": 0} for c in again.values())

    lake.write(dev.landing_root, "daily_bars", "2026-08-18", [lake.bar(date(2026, 8, 17))])
    assert build.promote_and_load(spark, dev, prod, since="2026-08-18")["daily_bars"]["appended"] == 1
    assert lines() == 11
    stored = spark.read.text(f"{prod.landing_root}/daily_bars").select("value", "date")
    source = spark.read.text(f"{dev.landing_root}/daily_bars").select("value", "date")
    assert stored.exceptAll(source).isEmpty() and source.exceptAll(stored).isEmpty()


def test_promotion_with_trailing_slash_and_scheme(spark, db, tmp_path):
    lake.write(tmp_path / "dev", "splits", "2026-08-17", [lake.split()])
    promote(spark, f"file:{tmp_path}/dev/", f"file:{tmp_path}/prod/", f"{db}.ledger", ["splits"])
    promote(spark, f"{tmp_path}/dev", f"{tmp_path}/prod", f"{db}.ledger", ["splits"])
    paths = [r.relative_path for r in spark.table(f"{db}.ledger").collect()]
    assert len(paths) == 1 and paths[0].startswith("splits/date=2026-08-17/")
    assert spark.read.text(f"{tmp_path}/prod/splits").count() == 1


def test_promotion_from_a_folder_with_unusual_characters(spark, db, tmp_path):
    dev, prod = tmp_path / "dév area+50%(1)", tmp_path / "prod [2]"
    lake.write(dev, "splits", "2026-08-17", [lake.split()])
    for _ in range(2):
        promote(spark, str(dev), str(prod), f"{db}.ledger", ["splits"])
    paths = [r.relative_path for r in spark.table(f"{db}.ledger").collect()]
    assert len(paths) == 1 and paths[0].startswith("splits/date=2026-08-17/")
    assert len([p for p in prod.rglob("part-*")]) == 1


@pytest.mark.parametrize("table", list(TABLES))
def test_the_stream_equals_the_batch_load(spark, db, tmp_path, table):
    lake.fill(tmp_path / "landing", days=3)
    root, target = str(tmp_path / "landing"), f"{db}.streamed"
    lake.write(root, "ticker_overview", "2026-08-17", [{}])

    def run():
        query = stream_table(
            spark,
            table,
            landing_root=root,
            target=target,
            checkpoint=str(tmp_path / "checkpoint"),
            max_files_per_batch=1,
        )
        assert query.awaitTermination(120)
        return query.lastProgress

    run()
    bronze.load_table(spark, table, landing_root=root, target=f"{db}.loaded")
    streamed = spark.table(target).drop("_source_file")
    loaded = spark.table(f"{db}.loaded").drop("_source_file")
    assert streamed.exceptAll(loaded).isEmpty() and loaded.exceptAll(streamed).isEmpty()
    before = streamed.count()
    run()
    assert spark.table(target).count() == before


def test_the_stream_reads_new_files_only(spark, db, tmp_path):
    root = str(tmp_path / "landing")
    lake.write(root, "splits", "2026-08-17", [lake.split("S1")])
    seen = []
    for event in ("S2", None):
        query = stream_table(
            spark, "splits", landing_root=root, target=f"{db}.s", checkpoint=str(tmp_path / "cp")
        )
        assert query.awaitTermination(120)
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
        if event:
            lake.write(root, "splits", "2026-08-24", [lake.split("S1"), lake.split(event)])
    assert spark.table(f"{db}.s").count() == 2
    assert seen[1] > 0


def test_the_facts_of_the_bars_need_no_shuffle_by_default(spark, db, tmp_path):
    lake.fill(tmp_path / "landing", days=3)
    place = build.Lake(str(tmp_path / "landing"), db, db, db)
    bronze.load_bronze(spark, landing_root=place.landing_root, schema=db)
    build.build(spark, place)
    for fact in ("fct_daily_returns", "fct_moving_averages", "fct_volume_anomalies"):
        computed = build.GOLD[fact].compute(spark.table(f"{db}.fct_daily_bars"))
        assert "Exchange" not in computed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("least", [0, 1 << 40])
def test_large_files_are_promoted_by_the_tasks_that_read_them(spark, db, tmp_path, monkeypatch, setting, least):
    setting(spark__sql__files__openCostInBytes=str(1 << 30))  # a task per file
    monkeypatch.setattr(promotion, "LARGE_FILE", {True: least, False: least})
    for i in range(3):
        lake.write(tmp_path / "dev", "splits", "2026-08-17", [lake.split(f"S{i}")])
    promote(spark, str(tmp_path / "dev"), str(tmp_path / "prod"), f"{db}.ledger", ["splits"])
    assert spark.read.text(f"{tmp_path}/prod/splits").count() == 3
    assert len(list((tmp_path / "prod").rglob("part-*.txt"))) == (1 if least else 3)


def test_landing_is_compressed_at_the_fastest_level(spark, tmp_path):
    values = [hashlib.md5(str(i).encode()).hexdigest() * 2 for i in range(5000)]
    rows = spark.createDataFrame([(v, date(2026, 8, 17)) for v in values], "value string, date date").coalesce(1)
    line_writer(rows, "gzip").text(str(tmp_path / "out"))
    (file,) = (tmp_path / "out").rglob("part-*.gz")
    text = gzip.decompress(file.read_bytes())
    assert sorted(text.decode().split()) == sorted(values)
    assert file.stat().st_size > len(zlib.compress(text)) * 1.01
