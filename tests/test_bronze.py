from __future__ import annotations

from datetime import date

import lake
import pytest
from pyspark.sql import functions as F

from candlewick.operators.incremental import value_range
from candlewick.plans import bronze, silver
from candlewick.sources import TABLES, append_table, read_landing, recover_table, replace_table, table_or_none

DAY = date(2026, 8, 14)


def load(spark, db, root, table, **options):
    return bronze.load_table(spark, table, landing_root=str(root), target=f"{db}.{table}", **options)


def test_columns_and_types_of_every_table(spark, db, tmp_path):
    lake.fill(tmp_path, days=2)
    bronze.load_bronze(spark, landing_root=str(tmp_path), schema=db)
    types = {t: dict(spark.table(f"{db}.{t}").dtypes) for t in TABLES}
    assert types["daily_bars"] == {
        "ticker": "string",
        "trade_date": "date",
        "open_price": "double",
        "high_price": "double",
        "low_price": "double",
        "close_price": "double",
        "volume": "double",
        "vwap": "double",
        "transaction_count": "bigint",
        "_ingested_at": "timestamp",
        "_source_file": "string",
    }
    assert types["dividends"]["frequency"] == "bigint"
    assert types["news_articles"]["published_utc"] == "timestamp"
    row = spark.table(f"{db}.daily_bars").orderBy("ticker", "trade_date").first()
    assert (row.ticker, row.trade_date) == ("AAPL", date(2026, 6, 1))
    assert row._ingested_at.isoformat() == "2026-08-17T10:00:00"
    assert "/daily_bars/date=2026-08-17/" in row._source_file


def test_a_second_load_adds_nothing(spark, db, tmp_path):
    lake.fill(tmp_path)
    report = bronze.verify_incremental(spark, landing_root=str(tmp_path), schema=db).collect()
    assert {r.status for r in report} == {"ok"}
    assert {r.table_name: r.run_2 for r in report} == {
        "daily_bars": 120,
        "ticker_overview": 2,
        "splits": 2,
        "dividends": 2,
        "news_articles": 2,
        "news_sentiment": 4,
    }


def test_a_full_replay_in_a_new_folder_adds_nothing(spark, db, tmp_path):
    lake.write(tmp_path, "splits", "2026-08-17", [lake.split("S1"), lake.split("S2")])
    assert load(spark, db, tmp_path, "splits") == {"appended": 2, "quarantined": 0}
    lake.write(tmp_path, "splits", "2026-08-24", [lake.split("S1"), lake.split("S2"), lake.split("S3")])
    assert load(spark, db, tmp_path, "splits")["appended"] == 1
    assert load(spark, db, tmp_path, "splits", since=date(2026, 8, 24))["appended"] == 0


def test_a_recent_batch_reads_only_its_range_and_still_knows_all_keys(spark, db, tmp_path):
    lake.write(tmp_path, "daily_bars", "2026-08-17", [lake.bar(DAY), lake.bar(date(2020, 1, 1))])
    assert load(spark, db, tmp_path, "daily_bars")["appended"] == 2
    lake.write(tmp_path, "daily_bars", "2026-08-18", [lake.bar(DAY, 11.0), lake.bar(date(2026, 8, 17))])
    counts = load(spark, db, tmp_path, "daily_bars", since=date(2026, 8, 18))
    assert counts["appended"] == 1


@pytest.mark.parametrize(("policy", "close"), [("first_wins", 10.0), ("latest_wins", 11.0)])
def test_a_correction_in_a_later_batch(spark, db, tmp_path, policy, close):
    lake.write(tmp_path, "daily_bars", "2026-08-17", [lake.bar(DAY, 10.0)])
    load(spark, db, tmp_path, "daily_bars", policy=policy)
    corrected = {"ingested": "2026-08-18T10:00:00+00:00"}
    lake.write(tmp_path, "daily_bars", "2026-08-18", [lake.bar(DAY, 11.0)], **corrected)
    load(spark, db, tmp_path, "daily_bars", policy=policy)
    load(spark, db, tmp_path, "daily_bars", policy=policy)
    stored = spark.table(f"{db}.daily_bars")
    assert stored.count() == (1 if policy == "first_wins" else 2)
    assert silver.stg_daily_bars(stored).first().close_price == close


def test_a_correction_in_the_same_batch_wins_in_the_cleaned_table(spark, db, tmp_path):
    lake.write(tmp_path, "daily_bars", "2026-08-17", [lake.bar(DAY, 10.0)])
    lake.write(
        tmp_path, "daily_bars", "2026-08-18", [lake.bar(DAY, 11.0)], ingested="2026-08-18T10:00:00+00:00"
    )
    assert load(spark, db, tmp_path, "daily_bars")["appended"] == 2
    cleaned = silver.stg_daily_bars(spark.table(f"{db}.daily_bars")).collect()
    assert [r.close_price for r in cleaned] == [11.0]


def test_overview_keeps_one_row_per_ticker_and_day(spark, db, tmp_path):
    lake.write(tmp_path, "ticker_overview", "2026-08-17", [lake.overview()])
    assert load(spark, db, tmp_path, "ticker_overview")["appended"] == 1
    lake.write(
        tmp_path, "ticker_overview", "2026-08-17", [lake.overview(name="Apple")], ingested="2026-08-17T23:00:00+00:00"
    )
    assert load(spark, db, tmp_path, "ticker_overview")["appended"] == 0
    lake.write(tmp_path, "ticker_overview", "2026-08-24", [lake.overview()], ingested="2026-08-24T10:00:00+00:00")
    assert load(spark, db, tmp_path, "ticker_overview")["appended"] == 1
    assert "_ingested_day" not in spark.table(f"{db}.ticker_overview").columns


def test_rows_without_a_key_go_to_quarantine_once(spark, db, tmp_path):
    lake.write(tmp_path, "ticker_overview", "2026-08-17", [{}, lake.overview()])
    lake.write(tmp_path, "ticker_overview", "2026-08-17", [{}], ticker="MSFT")
    assert load(spark, db, tmp_path, "ticker_overview") == {"appended": 1, "quarantined": 2}
    assert load(spark, db, tmp_path, "ticker_overview") == {"appended": 0, "quarantined": 0}
    assert spark.table(f"{db}.ticker_overview").filter("ticker IS NULL").isEmpty()
    assert spark.table(f"{db}.ticker_overview__quarantine").count() == 2


def test_articles_without_an_id_are_all_kept_in_quarantine(spark, db, tmp_path):
    nameless = [{**lake.article(), "id": None, "title": t} for t in ("a", "b")]
    lake.write(tmp_path, "news", "2026-08-17", [*nameless, lake.article("N1")])
    assert load(spark, db, tmp_path, "news_articles") == {"appended": 1, "quarantined": 2}


def test_blank_files_and_blank_sources(spark, db, tmp_path):
    for source in ("splits", "dividends"):
        folder = tmp_path / source / "date=2026-08-17"
        folder.mkdir(parents=True)
        (folder / "blank.jsonl").write_text("\n")
    lake.write(tmp_path, "splits", "2026-08-17", [lake.split()])
    assert load(spark, db, tmp_path, "splits") == {"appended": 1, "quarantined": 0}
    assert load(spark, db, tmp_path, "dividends") == {"appended": 0, "quarantined": 0}
    assert spark.table(f"{db}.dividends").count() == 0


def test_a_broken_line_goes_to_quarantine(spark, db, tmp_path):
    path = lake.write(tmp_path, "splits", "2026-08-17", [lake.split()])
    path.write_text(path.read_text() + '{"record": {"id": "S9", "tic\n')
    envelopes = read_landing(spark, str(tmp_path), "splits").select("record", "_corrupt_record").collect()
    assert [r._corrupt_record is None for r in envelopes].count(False) == 1
    assert load(spark, db, tmp_path, "splits") == {"appended": 1, "quarantined": 1}


@pytest.mark.parametrize(
    ("insights", "mentions"),
    [(None, 0), ((), 0), ((("AAPL", "positive"), ("QQQ", "neutral")), 2)],
)
def test_mentions_per_article(spark, db, tmp_path, insights, mentions):
    lake.write(tmp_path, "news", "2026-08-17", [lake.article("N1", insights)])
    assert load(spark, db, tmp_path, "news_sentiment")["appended"] == mentions
    assert load(spark, db, tmp_path, "news_articles")["appended"] == 1


def test_an_article_landed_for_two_tickers_is_stored_once(spark, db, tmp_path):
    for ticker in ("AAPL", "MSFT"):
        lake.write(tmp_path, "news", "2026-08-17", [lake.article("N1")], ticker=ticker)
    assert load(spark, db, tmp_path, "news_articles")["appended"] == 1
    assert load(spark, db, tmp_path, "news_sentiment")["appended"] == 1


def test_bad_dates_become_null_and_are_counted(spark, db, tmp_path):
    lake.write(tmp_path, "ticker_overview", "2026-08-17", [lake.overview(list_date="")])
    lake.write(tmp_path, "dividends", "2026-08-17", [lake.dividend(pay_date="soon")])
    load(spark, db, tmp_path, "ticker_overview")
    load(spark, db, tmp_path, "dividends")
    stored = spark.table(f"{db}.ticker_overview")
    assert silver.stg_ticker_overview(stored).first().list_date is None
    rejected = {r.column_name: r.rejected for r in silver.rejected_values(stored, "stg_ticker_overview").collect()}
    assert rejected["list_date"] == 1 and sum(rejected.values()) == 1
    envelopes = bronze.landed(spark, str(tmp_path), "dividends")
    landed = {r.column_name: r.rejected for r in bronze.rejected_values(envelopes, "dividends").collect()}
    assert landed == {"ex_dividend_date": 0, "declaration_date": 0, "record_date": 0, "pay_date": 1}


def test_values_of_another_type_are_counted(spark, db, tmp_path):
    bars = [lake.bar(DAY), {**lake.bar(DAY), "c": "n/a"}, {**lake.bar(DAY), "n": 5.5}, {**lake.bar(DAY), "vw": None}]
    lake.write(tmp_path, "daily_bars", "2026-08-17", bars)
    envelopes = bronze.landed(spark, str(tmp_path), "daily_bars")
    counts = {r.column_name: r.rejected for r in bronze.mismatched_values(envelopes, "daily_bars").collect()}
    assert counts == {**dict.fromkeys(("t", "o", "h", "l", "v", "vw"), 0), "c": 1, "n": 1}
    assert load(spark, db, tmp_path, "daily_bars")["quarantined"] == 0


def test_fractional_volume_is_cut(spark, db, tmp_path):
    lake.write(tmp_path, "daily_bars", "2026-08-17", [lake.bar(DAY, volume=1234.9)])
    load(spark, db, tmp_path, "daily_bars")
    assert silver.stg_daily_bars(spark.table(f"{db}.daily_bars")).first().volume == 1234


def test_bars_keep_their_day_in_any_session_zone(spark, db, tmp_path, setting):
    setting(spark__sql__session__timeZone="America/Los_Angeles")
    lake.write(tmp_path, "daily_bars", "2026-08-17", [lake.bar(date(2023, 8, 18))])
    load(spark, db, tmp_path, "daily_bars")
    assert spark.table(f"{db}.daily_bars").first().trade_date == date(2023, 8, 18)


def test_reload_replaces_all_tables(spark, db, tmp_path):
    lake.fill(tmp_path, days=3)
    bronze.load_bronze(spark, landing_root=str(tmp_path), schema=db)
    spark.table(f"{db}.splits").withColumn("split_id", F.lit("stale")).write.insertInto(f"{db}.splits")
    counts = bronze.reload_bronze(spark, landing_root=str(tmp_path), schema=db)
    assert counts == {
        "daily_bars": 6,
        "ticker_overview": 2,
        "splits": 2,
        "dividends": 2,
        "news_articles": 2,
        "news_sentiment": 4,
    }
    assert spark.table(f"{db}.splits").filter("split_id = 'stale'").isEmpty()
    again = bronze.load_bronze(spark, landing_root=str(tmp_path), schema=db)
    assert all(c == {"appended": 0, "quarantined": 0} for c in again.values())


def test_append_is_by_name_and_refuses_other_columns(spark, db):
    append_table(spark.sql("SELECT 1 AS a, 'x' AS b"), f"{db}.t")
    append_table(spark.sql("SELECT 'y' AS b, 2 AS a"), f"{db}.t")
    assert sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="batch"):
        append_table(spark.sql("SELECT 3 AS a"), f"{db}.t")


def test_replacing_a_table_from_itself(spark, db):
    append_table(spark.range(3).toDF("a"), f"{db}.t")
    replace_table(spark.table(f"{db}.t").filter("a > 0"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 2
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_a_failed_validation_leaves_the_old_table(spark, db):
    append_table(spark.range(3).toDF("a"), f"{db}.t")

    def refuse(_staged):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError, match="no"):
        replace_table(spark.range(9).toDF("a"), f"{db}.t", validate=refuse)
    assert spark.table(f"{db}.t").count() == 3


@pytest.mark.parametrize("by_reading", [False, True])
def test_recovery_after_a_stop_between_the_renames(spark, db, by_reading):
    append_table(spark.range(3).toDF("a"), f"{db}.t")
    append_table(spark.range(5).toDF("a"), f"{db}.t__staged")
    spark.sql(f"ALTER TABLE {db}.t RENAME TO {db}.t__old")
    found = table_or_none(spark, f"{db}.t") if by_reading else recover_table(spark, f"{db}.t")
    assert found is None or found.count() == 3
    assert spark.table(f"{db}.t").count() == 3
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


@pytest.mark.parametrize("policy", ["first_wins", "latest_wins"])
def test_loads_with_unreadable_times_add_nothing_the_second_time(spark, db, tmp_path, policy):
    lake.write(tmp_path, "ticker_overview", "2026-08-17", [lake.overview()], ingested="yesterday")
    bars = [lake.bar(date(2026, 8, 17)), {**lake.bar(date(2026, 8, 17)), "t": 10**18}]
    lake.write(tmp_path, "daily_bars", "2026-08-17", bars, ingested="yesterday")
    for run in range(3):
        for table, quarantined in (("ticker_overview", 1), ("daily_bars", 1)):
            counts = bronze.load_table(
                spark, table, landing_root=str(tmp_path), target=f"{db}.{table}", policy=policy
            )
            assert counts == {
                "appended": int(run == 0 and table == "daily_bars"),
                "quarantined": quarantined if run == 0 else 0,
            }


@pytest.mark.parametrize("table", list(TABLES))
def test_a_small_batch_meets_only_part_of_the_stored_rows(spark, db, tmp_path, table):
    lake.fill(tmp_path, days=3)
    since = date(2026, 8, 17)
    options = {"landing_root": str(tmp_path), "target": f"{db}.{table}"}
    bronze.load_table(spark, table, **options)
    assert bronze.load_table(spark, table, since=since, **options)["appended"] == 0
    rows = bronze.project(bronze.landed(spark, str(tmp_path), table, since), table)
    spec = TABLES[table]
    known = spark.table(f"{db}.{table}")
    range_of = value_range(rows, spec.range_key) if spec.range_key else None
    fresh = bronze.new_rows(rows, known, table, key_range=range_of, small_batch=not spec.range_key)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    if spec.range_key:
        assert f"GreaterThanOrEqual({spec.range_key}" in plan
    else:
        assert "LeftSemi" in plan
