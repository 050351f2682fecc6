"""Tables that are kept up to date: partition swaps, upserts, facts computed where a change reaches, spliced history."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick.operators.halo import REACHED, reached_bars, refreshed, replaced
from candlewick.plans import build, gold, incremental, silver
from candlewick.sources import tables
from candlewick.sources.tables import append_table, replace_table, swap_partitions, table_or_none

DAY = date(2024, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files_of(spark, name):
    return {p.split("_part=")[1] for p in spark.table(name).inputFiles()}


def parts_of(files):
    return {int(f.split("/")[0]) for f in files}


# ---- swap ----------------------------------------------------------------------------------------


@pytest.fixture
def parted(spark, db):
    content = spark.range(40).selectExpr("id", "0L AS v", "cast(id % 4 AS int) AS _part")
    replace_table(content, f"{db}.t", part_by="_part")
    return f"{db}.t"


def test_a_swap_writes_only_the_partitions_it_brings(spark, parted):
    before = files_of(spark, parted)
    content = spark.table(parted).where("_part IN (1, 2)").withColumn("v", F.lit(1).cast("long"))
    swap_partitions(content, parted, "_part")
    after = files_of(spark, parted)
    assert parts_of(before - after) == {1, 2} and parts_of(before & after) == {0, 3}
    assert rows(spark.table(parted).groupBy("_part", "v").count()) == [(0, 0, 10), (1, 1, 10), (2, 1, 10), (3, 0, 10)]


def test_a_failed_check_changes_nothing(spark, parted):
    before = files_of(spark, parted)

    def refuse(staged):
        raise ValueError("no")

    with pytest.raises(ValueError):
        swap_partitions(spark.table(parted).where("_part = 1"), parted, "_part", validate=refuse)
    assert files_of(spark, parted) == before
    swap_partitions(spark.table(parted).where("_part = 2"), parted, "_part")
    assert spark.table(parted).count() == 40


def test_a_swap_that_stopped_is_finished_by_the_next_access(spark, parted, monkeypatch):
    content = spark.table(parted).where("_part = 1").withColumn("v", F.lit(7).cast("long"))
    with monkeypatch.context() as stopped:
        decided = []
        stopped.setattr(tables, "finish_swap", lambda s, n: decided.append(n))
        swap_partitions(content, parted, "_part")
    assert decided and spark.table(parted).where("v = 7").count() == 0
    assert table_or_none(spark, parted).where("v = 7").count() == 10
    assert spark.table(parted).count() == 40 and not spark.catalog.tableExists(f"{parted}__swap")


# ---- facts ---------------------------------------------------------------------------------------

BARS = "ticker string, trade_date date, close_price double, volume long"


def bars_of(rng, n_days):
    return {
        (t, DAY + timedelta(d)): (rng.choice([None, rng.randint(1, 99) * 1.0]), rng.choice([None, rng.randint(0, 99)]))
        for t in ("A", "B", "C", None)
        for d in rng.sample(range(n_days * 2), n_days)
    }


def frame(spark, bars):
    return spark.createDataFrame([(*k, *v) for k, v in bars.items()], BARS)


def metrics(bars, keep=("ticker", "trade_date", "close_price")):
    return op.bar_metrics(bars, keep=list(keep))


@pytest.mark.parametrize("seed", range(3))
def test_late_corrected_and_removed_bars_give_the_facts_of_a_rebuild(spark, seed):
    rng = random.Random(seed)
    old = bars_of(rng, 150)
    new, changes = dict(old), []
    for _ in range(4):
        key = ("B" if rng.random() < 0.5 else "C", DAY + timedelta(rng.randrange(300)))
        changes.append(key)
        if rng.random() < 0.3:
            new.pop(key, None)
        else:
            new[key] = (rng.randint(1, 99) * 1.0, rng.randint(0, 99))
    points = spark.createDataFrame([*changes, (None, DAY), ("Z", DAY)], "ticker string, trade_date date")
    facts = metrics(frame(spark, old))
    got = refreshed(facts, frame(spark, new), points, metrics, ["ticker", "trade_date", "close_price"])

    def plain(df):
        return rows(df.select(*[F.round(c, 9) if t == "double" else c for c, t in df.dtypes]))

    assert plain(got) == plain(metrics(frame(spark, new)))


def test_only_bars_that_a_change_reaches_are_computed(spark):
    bars = {(t, DAY + timedelta(d)): (1.0 + d, d) for t in ("A", "B") for d in range(300)}
    change = spark.createDataFrame([("A", DAY + timedelta(100))], "ticker string, trade_date date")
    near = reached_bars(frame(spark, bars), change)
    days = {r.trade_date: r[REACHED] for r in near.collect()}
    assert near.select("ticker").distinct().collect() == [("A",)]
    assert min(days) == DAY + timedelta(50) and max(days) == DAY + timedelta(150)
    assert {d for d, reached in days.items() if reached} == {DAY + timedelta(d) for d in range(100, 151)}
    plan = metrics(reached_bars(frame(spark, bars), change))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[ticker#\d+ ASC NULLS FIRST, trade_date", plan)) == 1  # one for all windows


# ---- history -------------------------------------------------------------------------------------

SNAPSHOTS = "ticker string, a string, b int, at date"


def test_snapshots_in_any_order_give_the_history_of_sorted_ones(spark):
    rng = random.Random(4)
    every = [
        (t, rng.choice([None, "x", "y"]), rng.choice([1, 1, 2]), DAY + timedelta(d))
        for t in ("A", "B", "C")
        for d in rng.sample(range(30), 12)
    ]
    wanted = rows(op.scd2_history(spark.createDataFrame(every, SNAPSHOTS), "ticker", ["a", "b"], "at"))
    for _ in range(3):
        rng.shuffle(every)
        state = spark.createDataFrame([], "ticker string, a string, b int, valid_from date, valid_to date, seen_at array<date>")
        cuts = sorted(rng.sample(range(1, len(every)), 4))
        loads = [every[i:j] for i, j in zip([0, *cuts], [*cuts, len(every)], strict=True)]
        for load in [*loads, loads[0]]:  # the first comes twice
            fresh = spark.createDataFrame([*load, (None, "x", 1, DAY), ("A", "x", 1, None)], SNAPSHOTS)
            spliced = op.scd2_splice(state, fresh, "ticker", ["a", "b"], "at")
            state = spark.createDataFrame(spliced.collect(), state.schema)
        assert rows(state.drop("seen_at")) == wanted
        assert state.select(F.explode("seen_at")).count() == len(every)


def test_a_snapshot_splits_a_version_joins_neighbours_and_corrects(spark):
    def at(d):
        return DAY + timedelta(d)

    schema = "ticker string, a string, b int, valid_from date, valid_to date, seen_at array<date>"
    state = spark.createDataFrame([("A", "x", 1, at(0), at(20), [at(0), at(10)]), ("A", "y", 1, at(20), None, [at(20)]), ("B", "x", 1, at(0), None, [at(0)])], schema)

    def after(load, **more):
        found = op.scd2_splice(state, spark.createDataFrame(load, SNAPSHOTS), "ticker", ["a", "b"], "at", **more)
        return [(r.a, (r.valid_from - DAY).days, r.valid_to and (r.valid_to - DAY).days) for r in found.where("ticker = 'A'").orderBy("valid_from").collect()]

    assert after([("A", "z", 1, at(5))]) == [("x", 0, 5), ("z", 5, 10), ("x", 10, 20), ("y", 20, None)]
    assert after([("A", "y", 1, at(15))]) == [("x", 0, 15), ("y", 15, None)]
    assert after([("A", "x", 1, at(-5))]) == [("x", -5, 20), ("y", 20, None)]
    assert after([("A", "x", 1, at(20))]) == [("x", 0, 20), ("y", 20, None)]  # the greater values stand
    assert after([("A", "x", 1, at(20))], replace=True) == [("x", 0, None)]
    assert after([]) == [("x", 0, 20), ("y", 20, None)]


# ---- all together --------------------------------------------------------------------------------

BRONZE_BARS = (
    "ticker string, trade_date date, open_price double, high_price double, low_price double, close_price double, "
    "volume double, vwap double, transaction_count long, _ingested_at timestamp, _source_file string"
)


def bronze_bars(spark, rng, load, tickers, days):
    at = datetime(2024, 6, load)
    found = [
        (t, DAY + timedelta(d), 1.0, 2.0, 1.0, rng.randint(1, 50) * 1.0, rng.randint(0, 9) * 1.0, 1.0, load, at, f"f{load}")
        for t in tickers
        for d in days
    ]
    return spark.createDataFrame(found, BRONZE_BARS)


def test_loads_one_after_another_give_the_tables_of_a_rebuild(spark, db):
    rng = random.Random(9)
    lake = build.Lake("", db, db, db)
    loads = [
        bronze_bars(spark, rng, 1, ["A", "B", "C", "D"], range(0, 120)),
        bronze_bars(spark, rng, 2, ["B"], [5, 60, 119, 130]),
    ]
    before = None
    for load in loads:
        append_table(load, f"{db}.daily_bars")
        changes, touched = incremental.refresh_silver(spark, lake, "stg_daily_bars", 8)
        written = incremental.refresh_facts(spark, lake, changes, 32)  # the number of a made table stands
        if before is not None:
            for name, old in before.items():
                new = files_of(spark, f"{db}.{name}")
                assert parts_of(old - new) == set(touched) and old & new
                assert written.get(name, touched) == touched and len(touched) == 1
        before = {t: files_of(spark, f"{db}.{t}") for t in ("stg_daily_bars", "fct_daily_returns", "fct_moving_averages", "fct_volume_anomalies")}
    assert incremental.refresh_silver(spark, lake, "stg_daily_bars") == (None, [])
    staged = silver.stg_daily_bars(spark.table(f"{db}.daily_bars"))
    bars = gold.fct_daily_bars(staged)
    for name, wanted in {
        "stg_daily_bars": staged,
        "fct_daily_returns": gold.fct_daily_returns(bars),
        "fct_moving_averages": gold.fct_moving_averages(bars),
        "fct_volume_anomalies": gold.fct_volume_anomalies(bars),
    }.items():
        found = spark.table(f"{db}.{name}").select(*wanted.columns)
        assert rows(found.select(*[F.round(c, 9) if t == "double" else c for c, t in found.dtypes])) == rows(
            wanted.select(*[F.round(c, 9) if t == "double" else c for c, t in wanted.dtypes])
        )


def test_a_partition_that_loses_all_its_bars_is_emptied(spark, db):
    lake = build.Lake("", db, db, db)
    bars = bronze_bars(spark, random.Random(1), 1, ["A", "B", "C", "D"], range(5))
    append_table(bars, f"{db}.daily_bars")
    changes, _ = incremental.refresh_silver(spark, lake, "stg_daily_bars", 64)
    incremental.refresh_facts(spark, lake, changes)
    gone = spark.table(f"{db}.stg_daily_bars").where("ticker = 'A'").select("ticker", "trade_date").collect()
    left = spark.table(f"{db}.stg_daily_bars").where("ticker <> 'A'")
    incremental._create(left, f"{db}.stg_daily_bars", 64)
    incremental.refresh_facts(spark, lake, spark.createDataFrame(gone, "ticker string, trade_date date"))
    assert {r.ticker for r in spark.table(f"{db}.fct_daily_returns").collect()} == {"B", "C", "D"}


def test_a_swap_moves_the_files_it_has_written(spark, parted, monkeypatch):
    real, staged = tables.finish_swap, []

    def seen(s, name):
        if s.catalog.tableExists(f"{name}__swap"):
            staged.extend(p.rsplit("/", 1)[1] for p in s.table(f"{name}__swap").inputFiles())
        real(s, name)

    monkeypatch.setattr(tables, "finish_swap", seen)
    swap_partitions(spark.table(parted).where("_part IN (1, 2)").withColumn("v", F.col("v") + 1), parted, "_part")
    after = {p.rsplit("/", 1)[1] for p in spark.table(parted).inputFiles()}
    assert staged and set(staged) <= after
    assert rows(spark.table(parted).groupBy("_part", "v").count()) == [(0, 0, 10), (1, 1, 10), (2, 1, 10), (3, 0, 10)]


def test_no_frame_of_the_reached_bars_runs_from_each_row_to_the_end(spark):
    bars = {("A", DAY + timedelta(d)): (1.0, 1) for d in range(20)}
    change = spark.createDataFrame([("A", DAY)], "ticker string, trade_date date")
    plan = reached_bars(frame(spark, bars), change)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "currentrow$(), unboundedfollowing$()" not in plan


def test_changes_are_read_once_for_all_three_facts(spark, db, monkeypatch):
    computed = []
    real = incremental.rolling.bar_metrics
    monkeypatch.setattr(incremental.rolling, "bar_metrics", lambda *a, **k: computed.append(1) or real(*a, **k))
    lake = build.Lake("", db, db, db)
    bars = frame(spark, {("A", DAY + timedelta(d)): (float(d), d) for d in range(80)})
    replace_table(bars.withColumn("_part", F.lit(0)), f"{db}.stg_daily_bars", part_by="_part")
    spark.sql(f"ALTER TABLE {db}.stg_daily_bars SET TBLPROPERTIES ('parts' = '1')")
    for _ in range(2):
        incremental.refresh_facts(spark, lake, bars.limit(3), 1)
    assert len(computed) == 2


# ---- in buckets -------------------------------------------------------------------------------------

FACTS = ("fct_daily_returns", "fct_moving_averages", "fct_volume_anomalies")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def versions(spark, rng, load, tickers="ABCDEF"):
    """Bars with several versions of a key, some of the same time, and values that are missing."""
    found = [
        (rng.choice(tickers), DAY + timedelta(rng.randrange(70)), *[rng.choice([None, 1.0, 2.0]) for _ in range(3)], 3.0)
        + (rng.choice([None, 1.0, 2.0]), 1.0, load, rng.choice([None, datetime(2024, 6, rng.randint(1, 3))]), rng.choice("xy"))
        for _ in range(300)
    ]
    return spark.createDataFrame(found, BRONZE_BARS)


@pytest.mark.parametrize("older_layout", [False, True])
def test_versions_and_facts_in_buckets_are_those_of_a_rebuild(spark, db, older_layout):
    rng = random.Random(5)
    lake = build.Lake("", db, db, db)
    for load in range(2):
        append_table(versions(spark, rng, load), f"{db}.daily_bars")
        incremental.refresh_facts(spark, lake, incremental.refresh_silver(spark, lake, "stg_daily_bars", 3)[0])
        if older_layout and not load:
            for name in ("stg_daily_bars", *FACTS):
                incremental._create(spark.table(f"{db}.{name}"), f"{db}.{name}", 3)
    staged = silver.stg_daily_bars(spark.table(f"{db}.daily_bars"))
    bars = gold.fct_daily_bars(staged)
    for name, wanted in {"stg_daily_bars": staged, **{name: getattr(gold, name)(bars) for name in FACTS}}.items():
        found = spark.table(f"{db}.{name}").select(*wanted.columns)
        plain = [[F.round(c, 9) if t == "double" else c for c, t in df.dtypes] for df in (found, wanted)]
        assert rows(found.select(*plain[0])) == rows(wanted.select(*plain[1]))
    assert not [t.name for t in spark.catalog.listTables(db) if t.name.startswith("facts__")]


def test_what_lies_in_the_same_buckets_meets_without_a_shuffle(spark, db, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    lake = build.Lake("", db, db, db)
    append_table(versions(spark, random.Random(6), 1), f"{db}.daily_bars")
    changes, _ = incremental.refresh_silver(spark, lake, "stg_daily_bars", 3)
    incremental.refresh_facts(spark, lake, changes)
    returns, averages, volumes = (spark.table(f"{db}.{name}").drop("_part") for name in FACTS)
    key = ["ticker", "trade_date"]
    with tables.meeting_in_buckets(spark):
        both = op.spread_join(returns, averages.drop("close_price"), key, "inner", in_place=True)
        assert shuffles(op.spread_join(both, volumes, key, "inner", in_place=True)) == 0
        assert shuffles(replaced(returns, returns.where("daily_return > 0"), averages, in_place=True)) == 0
    assert shuffles(spark.table(f"{db}.stg_daily_bars").groupBy(*key).count()) == 0
    stored = spark.table(f"{db}.stg_daily_bars")
    batch = op.dedup_latest(changes, key, silver.newest_first()).withColumn("_part", F.lit(0))
    with tables.setting(spark, "spark.sql.shuffle.partitions", str(incremental.BUCKETS)):
        assert shuffles(incremental._newer(stored, batch, "stg_daily_bars")) == 1  # of the batch


def test_the_shuffles_of_a_write_go_with_it(spark, db):
    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = kept()
    append_table(spark.range(1000).repartition(3, "id"), f"{db}.t")
    assert kept() <= before
