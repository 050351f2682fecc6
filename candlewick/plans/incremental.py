"""Cleaned tables, facts and ticker history kept up to date by what a load has added, instead of built anew.

Tables kept this way are stored in hash partitions of their key (``_part``). A refresh writes only the partitions that a
new row falls into; the files of all others stay as they are. Each table has a ledger of the input files that went into
it, written after the swap: a stop in between repeats a refresh, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import Check, dedup_latest, report, rolling, scd2_splice
from candlewick.operators.halo import REACHED, reached_bars, replaced
from candlewick.plans import gold, silver
from candlewick.plans.build import STAGING_INPUT, CheckFailed, Lake
from candlewick.plans.checks import CHECKS
from candlewick.sources.registry import AUDIT
from candlewick.sources.tables import (
    append_table,
    buckets_of,
    meeting_in_buckets,
    replace_table,
    setting,
    swap_partitions,
    table_or_none,
)

PART = "_part"
SEEN = "seen_at"
HISTORY = "dim_ticker_history"
#: Bars and what is computed from them lie by ticker, so that a ticker's series is in one partition.
PART_KEYS = {"stg_daily_bars": ("ticker",)}
_METRICS = {
    "fct_daily_returns": (rolling.RETURN_COLUMNS, "close_price"),
    "fct_moving_averages": (rolling.AVERAGE_COLUMNS, "close_price"),
    "fct_volume_anomalies": (rolling.VOLUME_COLUMNS, "volume"),
}


#: Buckets of the tables: of a cleaned table by its key, which is unique, and of the facts over bars, and the bars they
#: are computed from, by ticker, which has a bar a day at most, so that no bucket is hot. What is computed from these, joined
#: with them or replaced in them needs no shuffle.
BUCKETS = 32
_BY_TICKER = {"bucket_by": "ticker", "buckets": BUCKETS, "sort_by": ("trade_date",)}


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias(PART)


def _parts(spark: SparkSession, name: str, wanted: int) -> int:
    """The number of partitions a table was made with, which a later argument does not change."""
    rows = table_or_none(spark, name)
    return wanted if rows is None else int(spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'parts'").first()["value"])


def _create(df: DataFrame, name: str, parts: int, validate: Callable[[DataFrame], None] | None = None, **layout) -> None:
    replace_table(df, name, validate=validate, part_by=PART, **layout)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('parts' = '{parts}')")


def _touched(df: DataFrame) -> list[int]:
    """One number per partition that occurs, at most as many as the table has."""
    return [r[0] for r in df.select(PART).distinct().collect()]


def _must_pass(checks: Sequence[Check], model: str) -> Callable[[DataFrame], None]:
    """The model's tests over the staged partitions. Equal keys share a partition, so what is unique there is unique."""
    wanted = [c for c in checks if c.model == model]

    def validate(staged: DataFrame) -> None:
        failed = report({model: staged}, wanted).filter("status = 'fail'").collect() if wanted else []
        if failed:
            raise CheckFailed(", ".join(f"{r.test_name}: {r.violations}" for r in failed))

    return validate


def new_files(spark: SparkSession, source: str, ledger: str) -> list[str]:
    """The data files of a table that the ledger does not list; Spark's own listing of the table holds them too."""
    known = table_or_none(spark, ledger)
    have = set() if known is None else {r.file for r in known.collect()}
    return [f for f in spark.table(source).inputFiles() if f not in have]


def _note(spark: SparkSession, files: Sequence[str], ledger: str) -> None:
    append_table(spark.createDataFrame([(f,) for f in files], "file string"), ledger)


def upsert(rows: DataFrame, name: str, model: str, parts: int) -> list[int]:
    """Bring the typed rows of a batch into their table, newest per key; returns the partitions that were written.

    The newest version of a key in the batch is found by one shuffle, before which a task chooses among its own, and which
    deals the keys to the buckets of the table. The stored row meets it there, so the table is not shuffled.
    """
    spark, spec = rows.sparkSession, silver.STAGING[model]
    parts = _parts(spark, name, parts)
    part = _part(PART_KEYS.get(model, spec.keys), parts)
    touched = _touched(rows.select(part))
    stored = table_or_none(spark, name)
    check = _must_pass(CHECKS, model)
    batch = dedup_latest(rows, spec.keys, silver.newest_first(), silver.payload_order(model)).select("*", part)
    with setting(spark, "spark.sql.shuffle.partitions", str(BUCKETS)):
        if stored is None:
            _create(batch, name, parts, check, dealt=True, bucket_by=spec.keys, buckets=BUCKETS)
        elif touched:
            content = _newer(stored.filter(F.col(PART).isin(touched)), batch, model)
            swap_partitions(content, name, PART, validate=check, dealt=True)
    return touched


def _newer(stored: DataFrame, batch: DataFrame, model: str) -> DataFrame:
    """Per key the newer of two rows, in the order of :func:`silver.stage`. Both sides have a key once."""
    keys = silver.STAGING[model].keys
    rest = [c for c in stored.columns if c not in keys]
    old, new = (side.select(*keys, F.struct(*rest).alias(name)) for side, name in ((stored, "_old"), (batch, "_new")))
    order = [*AUDIT, *[c for c in silver.STAGING[model].columns if c not in keys]]
    rank = {side: F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("_old", "_new")}  # NULL is the least
    taken = F.col("_old").isNull() | (F.col("_new").isNotNull() & (rank["_new"] > rank["_old"]))
    best = F.when(taken, F.col("_new")).otherwise(F.col("_old"))
    both = old.join(new, [*keys], "full_outer").select(*keys, best.alias("_best"))
    return both.select(*keys, "_best.*").select(*stored.columns)


def refresh_silver(spark: SparkSession, lake: Lake, model: str, parts: int = 64) -> tuple[DataFrame | None, list[int]]:
    """Take in the files that its typed table has gained; returns (the rows of these files in the types of the cleaned
    table, every version of a key, or None, the partitions written). The rows are read from the files again whenever they
    are used."""
    source, target = f"{lake.bronze}.{STAGING_INPUT[model]}", f"{lake.silver}.{model}"
    ledger = f"{target}__inputs"
    files = new_files(spark, source, ledger)
    if not files:
        return None, []
    batch = silver.typed(spark.read.schema(spark.table(source).schema).parquet(*files), model)
    touched = upsert(batch, target, model, parts)
    _note(spark, files, ledger)
    return batch, touched


def refresh_facts(spark: SparkSession, lake: Lake, changes: DataFrame, parts: int = 64) -> dict[str, list[int]]:
    """Bring the three facts over bars up to date with the cleaned bars after ``changes`` (ticker, trade_date; a key may
    come many times): of each changed ticker only rows that a change reaches are computed, and only partitions with a
    changed ticker written. The changes, and the bars that the metrics of all three facts look at, are found once and
    stored in buckets by ticker, beside the facts, which lie in the same ones; these tables go afterwards."""
    bars_name = f"{lake.silver}.stg_daily_bars"
    parts = _parts(spark, bars_name, parts)
    bars = table_or_none(spark, bars_name).select(PART, "ticker", "trade_date", "close_price", "volume")
    helpers = {name: f"{lake.gold}.facts__{name}" for name in ("changes", "bars", "reached")}

    def staged(rows: DataFrame, name: str, dealt: bool = False) -> DataFrame:
        replace_table(rows, helpers[name], dealt=dealt, **_BY_TICKER)
        return spark.table(helpers[name])

    names = {model: f"{lake.gold}.{model}" for model in _METRICS}
    stored = {model: table_or_none(spark, name) for model, name in names.items()}
    keep = [PART, "ticker", "trade_date", "close_price", "volume"]

    def columns(models: Sequence[str]) -> list[str]:
        return [c for model in models for c in _METRICS[model][0]]

    def of(model: str, rows: DataFrame) -> DataFrame:
        own, value = _METRICS[model]
        return rows.select(PART, "ticker", "trade_date", value, *own)

    written = {}
    try:
        missing = [model for model in _METRICS if stored[model] is None]
        if missing:
            every = rolling.bar_metrics(staged(bars, "bars"), columns(missing), keep=keep)
            for model in missing:
                _create(of(model, every), names[model], parts, dealt=True, **_BY_TICKER)
                written[model] = list(range(parts))
        known = [model for model in _METRICS if stored[model] is not None]
        touched = []
        if known:
            points = changes.select("ticker", "trade_date").repartition(BUCKETS, "ticker").distinct()
            points = staged(points.select("*", _part(["ticker"], parts)), "changes", dealt=True)
            touched = _touched(points)
        if touched:
            own = bars.filter(F.col(PART).isin(touched))
            few = points.count() < own.count() / 16
            near = staged(reached_bars(own, points, few=few, tasks=BUCKETS), "reached", dealt=True)
            anew = rolling.bar_metrics(near, columns(known), keep=[*keep, REACHED]).filter(REACHED).drop(REACHED)
            some_empty = own.select(PART).distinct().count() < len(touched)
        for model in known:
            if not touched:
                written[model] = []
                continue
            name, facts = names[model], stored[model]
            content = replaced(facts.filter(F.col(PART).isin(touched)), of(model, anew), points, in_place=True)
            with meeting_in_buckets(spark):
                emptied = set(touched) - set(_touched(content)) if some_empty else set()
                if emptied:  # a swap cannot leave a partition without rows
                    others = facts.filter(~F.col(PART).isin(touched))
                    _create(others.unionByName(content), name, parts, **_BY_TICKER)
                else:
                    swap_partitions(content, name, PART, dealt=buckets_of(spark, name) is not None)
            written[model] = touched
    finally:
        for helper in helpers.values():
            spark.sql(f"DROP TABLE IF EXISTS {helper}")
    return written


def splice_history(spark: SparkSession, lake: Lake, snapshots: DataFrame, parts: int = 64) -> list[int]:
    """Bring ticker snapshots of any age (ticker, tracked attributes, ``snapshot_date``; one per ticker and day) into the
    ticker history; only partitions with a ticker of the batch are read and written. A snapshot replaces an earlier one
    of its day. Returns these partitions."""
    name = f"{lake.gold}.{HISTORY}"
    parts = _parts(spark, name, parts)
    columns = ("ticker", *gold.TRACKED)
    batch = snapshots.filter("ticker IS NOT NULL AND snapshot_date IS NOT NULL").select(*columns, "snapshot_date")
    touched = _touched(batch.select(_part(["ticker"], parts)))
    stored = table_or_none(spark, name)
    if stored is None:
        day = F.col("snapshot_date")
        ends = [day.alias("valid_from"), day.alias("valid_to"), F.array(day).alias(SEEN)]
        state = batch.select(*columns, *ends).limit(0)
    else:
        state = stored.filter(F.col(PART).isin(touched)).drop(PART)
    history = scd2_splice(state, batch, "ticker", gold.TRACKED, "snapshot_date", SEEN, replace=True)
    spliced = history.select("*", _part(["ticker"], parts))
    if stored is None:
        _create(spliced, name, parts)
    elif touched:
        swap_partitions(spliced, name, PART)
    return touched


def refresh(spark: SparkSession, lake: Lake, parts: int = 64) -> dict[str, list[int]]:
    """Bring the six cleaned tables, the facts over bars and the ticker history up to date with the typed tables.

    The ledgers of the bars and the overview are noted before the tables that follow from them are written; these
    therefore have ledgers of their own, by which a stopped refresh finds what they still lack.
    """
    written = {model: refresh_silver(spark, lake, model, parts)[1] for model in STAGING_INPUT}
    for model, follow in (("stg_daily_bars", "facts"), ("stg_ticker_overview", HISTORY)):
        source = f"{lake.bronze}.{STAGING_INPUT[model]}"
        ledger = f"{lake.gold}.{follow}__inputs"
        files = new_files(spark, source, ledger)
        if not files:
            continue
        batch = silver.typed(spark.read.schema(spark.table(source).schema).parquet(*files), model)
        if model == "stg_daily_bars":
            written |= refresh_facts(spark, lake, batch, parts)
        else:
            # The cleaned row of a key and day may be of another load than this one.
            days = batch.select("ticker", "snapshot_date").distinct()
            cleaned = table_or_none(spark, f"{lake.silver}.{model}").drop(PART)
            written[HISTORY] = splice_history(spark, lake, cleaned.join(days, ["ticker", "snapshot_date"], "left_semi"), parts)
        _note(spark, files, ledger)
    return written
