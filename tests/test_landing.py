from __future__ import annotations

import json
from datetime import UTC, date, datetime
from pathlib import Path

import lake
import pytest
from pyspark.sql import functions as F

from candlewick.plans import bronze, landing
from candlewick.sources import SOURCES, land, read_landing
from candlewick.sources.registry import WATCHLIST

AT = datetime(2026, 8, 17, 10, 0, 0, 123456, tzinfo=UTC)
END = date(2026, 8, 17)


def feed(spark, source, rows):
    """(ticker, record) rows as a vendor feed; a record may be None."""
    lines = [(ticker, record and json.dumps(record)) for ticker, record in rows]
    return spark.createDataFrame(lines, "ticker string, j string").select(
        "ticker", F.from_json("j", SOURCES[source].record).alias("record")
    )


def landed_lines(folder):
    return [line for path in Path(folder).glob("*.txt") for line in path.read_text().split("\n")[:-1]]


def test_envelope_file_layout_and_content(spark, tmp_path):
    rows = feed(spark, "splits", [("AAPL", lake.split("S1")), ("AAPL", lake.split("S2"))])
    folder = land(
        rows, "splits", str(tmp_path), ticker=F.col("ticker"), record=F.col("record"), ingested_at=AT, run_date=END
    )
    assert folder == f"{tmp_path}/splits/date=2026-08-17"
    lines = [json.loads(line) for line in landed_lines(folder)]
    assert {line["record"]["id"] for line in lines} == {"S1", "S2"}
    for line in lines:
        assert list(line) == ["record", "_ingested_at", "_request_metadata"]
        assert line["_ingested_at"] == "2026-08-17T10:00:00.123456+00:00"
        assert line["_request_metadata"] == {"endpoint": "/stocks/v1/splits", "ticker": "AAPL"}


def test_landing_never_changes_old_files(spark, tmp_path):
    rows = feed(spark, "splits", [("AAPL", lake.split("S1"))])
    options = {"ticker": F.col("ticker"), "record": F.col("record"), "run_date": END}
    folder = Path(land(rows, "splits", str(tmp_path), **options))
    before = {p: p.read_bytes() for p in folder.glob("*.txt")}
    land(rows, "splits", str(tmp_path), **options)
    assert all(p.read_bytes() == content for p, content in before.items())
    assert len(list(folder.glob("*.txt"))) == 2 * len(before)


def test_no_records_leave_one_blank_line(spark, tmp_path):
    rows = feed(spark, "splits", [("AAPL", lake.split("S1"))]).limit(0)
    folder = land(rows, "splits", str(tmp_path), ticker=F.col("ticker"), record=F.col("record"), run_date=END)
    assert [p.read_text() for p in Path(folder).glob("*.txt")] == ["\n"]
    assert read_landing(spark, str(tmp_path), "splits").count() == 0


def test_an_ingest_time_needs_a_zone(spark, tmp_path):
    rows = feed(spark, "splits", [("AAPL", lake.split("S1"))])
    with pytest.raises(ValueError, match="zone"):
        land(
            rows,
            "splits",
            str(tmp_path),
            ticker=F.col("ticker"),
            record=F.col("record"),
            ingested_at=datetime(2026, 8, 17),
        )


@pytest.mark.parametrize("source", list(SOURCES))
def test_written_records_read_back_equal(spark, tmp_path, source):
    records = {
        "daily_bars": lake.bar(date(2026, 8, 14), 10.1),
        "ticker_overview": lake.overview(),
        "splits": lake.split(),
        "dividends": lake.dividend(),
        "news": lake.article(),
    }
    rows = feed(spark, source, [("AAPL", records[source])])
    land(rows, source, str(tmp_path), ticker=F.col("ticker"), record=F.col("record"), ingested_at=AT)
    back = read_landing(spark, str(tmp_path), source).select("record", "_corrupt_record").first()
    assert back._corrupt_record is None
    assert back.record == rows.first().record


def test_daily_run_lands_recent_bars_and_capped_news_if_told_to(spark, tmp_path):
    bars = [("AAPL", lake.bar(date(2026, 8, d))) for d in range(1, 21)] + [("ZZZZ", lake.bar(END))]
    news = [
        ("AAPL", lake.article(f"N{i:02d}", published=f"2026-08-{10 + i // 2:02d}T00:00:00Z"))
        for i in range(14)
    ]
    frames = {"daily_bars": feed(spark, "daily_bars", bars), "news": feed(spark, "news", news)}
    folders = landing.land_daily(
        frames,
        str(tmp_path),
        end=END,
        days={"daily_bars": landing.DAILY_BAR_DAYS, "news": landing.NEWS_DAYS},
        per_ticker=landing.NEWS_PER_TICKER,
        ingested_at=AT,
        run_date=END,
    )
    assert list(folders) == ["daily_bars", "news"]
    rows = bronze.project(bronze.landed(spark, str(tmp_path), "daily_bars"), "daily_bars").collect()
    assert sorted(r.trade_date.day for r in rows) == [12, 13, 14, 15, 16, 17]
    assert {r.ticker for r in rows} == {"AAPL"}
    ids = read_landing(spark, str(tmp_path), "news").select("record.id").collect()
    # newest first; a tie on the time falls to the smaller id
    assert sorted(r.id for r in ids) == ["N08", "N10", "N11", "N12", "N13"]
    endpoint = read_landing(spark, str(tmp_path), "daily_bars").select("_request_metadata.endpoint").first()[0]
    assert endpoint == "/v2/aggs/ticker/AAPL/range/1/day/2026-08-12/2026-08-17"


def test_weekly_run_lands_snapshots_and_full_histories(spark, tmp_path):
    feeds = {
        "ticker_overview": feed(spark, "ticker_overview", [("AAPL", lake.overview()), ("KO", None)]),
        "splits": feed(spark, "splits", [("AAPL", lake.split("S1", day="1987-06-16")), ("AAPL", lake.split("S2"))]),
        "dividends": feed(spark, "dividends", [("KO", lake.dividend("D1", "KO"))]),
    }
    folders = landing.land_reference(feeds, str(tmp_path), end=END, ingested_at=AT)
    assert list(folders) == ["ticker_overview", "splits", "dividends"]
    overview = read_landing(spark, str(tmp_path), "ticker_overview")
    rows = {r._request_metadata.ticker: r.record.ticker for r in overview.collect()}
    assert rows == {"AAPL": "AAPL", "KO": None}
    assert read_landing(spark, str(tmp_path), "splits").count() == 2


def test_backfill_takes_a_year_of_bars_if_told_to(spark, tmp_path):
    days = [date(2025, 8, 16), date(2025, 8, 17), date(2026, 1, 1), END]
    frame = feed(spark, "daily_bars", [("BA", lake.bar(d)) for d in days])
    window = {"daily_bars": landing.BACKFILL_BAR_DAYS}
    for root, option, kept in (("all", None, days), ("year", window, days[1:])):
        path = str(tmp_path / root)
        landing.backfill({"daily_bars": frame}, "daily_bars", path, end=END, days=option)
        rows = bronze.project(bronze.landed(spark, path, "daily_bars"), "daily_bars")
        assert sorted(r.trade_date for r in rows.collect()) == kept


@pytest.mark.parametrize("days", [None, 7])
def test_landing_keeps_what_it_cannot_read(spark, tmp_path, days):
    articles = [lake.article("N1", published="2026-08-17T00:00:00Z"), lake.article("N2", published="soon")]
    rows = [("AAPL", a) for a in (*articles, {**lake.article("N3"), "published_utc": None})]
    landing.land_source(feed(spark, "news", rows), "news", str(tmp_path), end=END, days=days, per_ticker=5)
    ids = read_landing(spark, str(tmp_path), "news").select("record.id").collect()
    assert sorted(r.id for r in ids) == ["N1", "N2", "N3"]
    bars = [("AAPL", lake.bar(END)), ("AAPL", {**lake.bar(END), "t": None}), ("AAPL", {**lake.bar(END), "t": 10**18})]
    landing.land_source(feed(spark, "daily_bars", bars), "daily_bars", str(tmp_path), end=END, days=days)
    assert read_landing(spark, str(tmp_path), "daily_bars").count() == 3


def test_landing_keeps_every_reply(spark, tmp_path):
    replies = [("AAPL", lake.overview()), ("AAPL", {**lake.overview(), "name": "Apple"}), ("AAPL", None)]
    landing.land_source(feed(spark, "ticker_overview", replies), "ticker_overview", str(tmp_path), end=END)
    assert read_landing(spark, str(tmp_path), "ticker_overview").count() == 3


def test_watchlist_as_names_or_as_a_table(spark):
    assert len(WATCHLIST) == 10
    df = spark.createDataFrame([("AAPL", 1), ("ZZZZ", 2), (None, 3)], "ticker string, x int")
    assert [r.x for r in landing.on_watchlist(df).collect()] == [1]
    table = spark.createDataFrame([("ZZZZ",), ("ZZZZ",)], "ticker string")
    assert [r.x for r in landing.on_watchlist(df, table).collect()] == [2]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    schema = "ticker string, trade_date date, close_price double"
    spark.createDataFrame([("AAPL", END, 1.0)], schema).write.parquet(path)
    stored = spark.read.parquet(path)
    ranged = landing.bars_range(stored, date(2026, 1, 1), END, ["AAPL", "KO"])
    rolled = landing.rolling_window(stored, F.col("trade_date"), END, 5)
    for df, low in ((ranged, "2026-01-01"), (rolled, "2026-08-12")):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
        assert f"GreaterThanOrEqual(trade_date,{low})" in pushed
        assert "LessThanOrEqual(trade_date,2026-08-17)" in pushed
        assert ("In(ticker, [AAPL,KO])" in pushed) == (df is ranged)
        assert "Join" not in plan
        assert df.count() == 1


def test_compressed_lines_come_back_and_are_promoted_compressed(spark, db, tmp_path):
    from datetime import UTC, date, datetime

    from candlewick.plans import landing
    from candlewick.sources.landing import read_landing
    from candlewick.sources.promotion import promote

    feed = spark.createDataFrame([(f"T{i}", (f"s{i}", f"T{i}")) for i in range(30)], "ticker string, record struct<id:string,ticker:string>")
    dev, prod = str(tmp_path / "dev"), str(tmp_path / "prod")
    day = date(2024, 2, 1)
    options = {"end": day, "run_date": day, "ingested_at": datetime(2024, 2, 1, tzinfo=UTC)}
    landing.land_source(feed, "splits", dev, compression="gzip", **options)
    for _ in range(2):
        promote(spark, dev, prod, f"{db}.ledger", ["splits"], compression="gzip")
    for root in (dev, prod):
        assert {p.suffix for p in Path(root).rglob("part-*")} == {".gz"}
        assert {r[0] for r in read_landing(spark, root, "splits").select("record.id").collect()} == {f"s{i}" for i in range(30)}
        assert read_landing(spark, root, "splits").count() == 30
