"""Typed tables to cleaned tables, ticker history, dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import Check, days_of, freshness_status, report, scd2_merge, single_current
from candlewick.plans import bronze, gold, silver
from candlewick.plans.checks import CHECKS, EXTRA_CHECKS
from candlewick.sources.footers import bounds
from candlewick.sources.promotion import promote
from candlewick.sources.registry import SOURCES, TABLES
from candlewick.sources.tables import replace_table, table_or_none

SNAPSHOT = "dim_ticker_snapshot"
# Tables whose readers partition by ticker; stored in buckets when a bucket count is given.
BY_TICKER = {"fct_daily_bars": "trade_date"}

STAGING_INPUT = {
    "stg_daily_bars": "daily_bars",
    "stg_ticker_overview": "ticker_overview",
    "stg_splits": "splits",
    "stg_dividends": "dividends",
    "stg_news_articles": "news_articles",
    "stg_news_sentiment": "news_sentiment",
}


class CheckFailed(RuntimeError):
    """A data test found violations; the table it was meant for has not been replaced."""


@dataclass(frozen=True)
class Lake:
    """Where an environment keeps its landing files and tables.

    The bars table is stored in ``ticker_buckets`` buckets by ticker (default: as many as Spark has
    shuffle partitions), so that the bars are shuffled once and the three facts built from them not at
    all (each sorts its buckets, whose files Spark does not take for sorted); about one bucket per 200 MB of bars.
    Lines promoted to it are written with ``landing_compression``, such as ``gzip`` (default: plain text).
    """

    landing_root: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    ticker_buckets: int | None = None
    landing_compression: str | None = None


@dataclass(frozen=True)
class Model:
    """A gold table: the tables it reads (silver or earlier gold ones) and how it is computed."""

    inputs: tuple[str, ...]
    compute: Callable[..., DataFrame]


GOLD: Mapping[str, Model] = {
    "dim_ticker": Model((SNAPSHOT,), gold.dim_ticker),
    "dim_date": Model(("stg_daily_bars",), gold.dim_date),
    "dim_publisher": Model(("stg_news_articles",), gold.dim_publisher),
    "dim_industry": Model(("stg_ticker_overview",), gold.dim_industry),
    "fct_daily_bars": Model(("stg_daily_bars",), gold.fct_daily_bars),
    "fct_ticker_daily_metrics": Model(("stg_ticker_overview",), gold.fct_ticker_daily_metrics),
    "fct_splits": Model(("stg_splits",), gold.fct_splits),
    "fct_dividends": Model(("stg_dividends",), gold.fct_dividends),
    "fct_news_sentiment": Model(
        ("stg_news_sentiment", "stg_news_articles"), gold.fct_news_sentiment
    ),
    "fct_daily_returns": Model(("fct_daily_bars",), gold.fct_daily_returns),
    "fct_moving_averages": Model(("fct_daily_bars",), gold.fct_moving_averages),
    "fct_volume_anomalies": Model(("fct_daily_bars",), gold.fct_volume_anomalies),
}


def _require(checks: Sequence[Check], model: str) -> Callable[[DataFrame], None]:
    """Run a model's tests on its staged content; the report is one row per test."""
    wanted = [c for c in checks if c.model == model]

    def validate(staged: DataFrame) -> None:
        failed = report({model: staged}, wanted).filter("status = 'fail'").collect()
        if failed:
            raise CheckFailed(", ".join(f"{r.test_name}: {r.violations}" for r in failed))

    return validate


def _table(spark: SparkSession, lake: Lake, model: str) -> DataFrame:
    return spark.table(f"{lake.silver if model in STAGING_INPUT else lake.gold}.{model}")


def build_silver(spark: SparkSession, lake: Lake) -> None:
    for model, source in STAGING_INPUT.items():
        staged = silver.stage(spark.table(f"{lake.bronze}.{source}"), model)
        replace_table(staged, f"{lake.silver}.{model}", validate=_require(CHECKS, model))


def update_snapshot(spark: SparkSession, lake: Lake, run_ts: datetime | None = None) -> None:
    """One SCD2 run: compare the newest overview of each ticker with the open versions.

    Versions start at the run time. The merged history is written beside the old one and takes its
    place only if no ticker has two open versions.
    """
    name = f"{lake.gold}.{SNAPSHOT}"
    current = gold.ticker_current_state(_table(spark, lake, "stg_ticker_overview"))
    state = table_or_none(spark, name)
    if state is None:
        never = F.lit(None).cast("timestamp")
        state = current.select(
            "*", never.alias("valid_from"), never.alias("valid_to")
        ).limit(0)
    stamp = F.lit(run_ts or datetime.now(UTC))
    merged = scd2_merge(state, current, "ticker", gold.TRACKED, stamp)

    def validate(staged: DataFrame) -> None:
        open_versions = staged.withColumn("is_current", F.col("valid_to").isNull())
        if not single_current(open_versions, "ticker").isEmpty():
            raise CheckFailed(f"{name}: more than one open version of a ticker")

    replace_table(merged, name, validate=validate)


def date_dimension(spark: SparkSession, bars: str, buffer_days: int = 30) -> DataFrame:
    """The date dimension over a stored table of bars, whose first and last day stand in the file footers."""
    low, high = bounds(spark, bars, ["trade_date"])["trade_date"]
    return days_of(spark.range(1).select(low.alias("lo"), high.alias("hi")), buffer_days)


def build_gold(spark: SparkSession, lake: Lake) -> None:
    for model, spec in GOLD.items():
        if model == "dim_date":
            content = date_dimension(spark, f"{lake.silver}.{spec.inputs[0]}")
        else:
            content = spec.compute(*[_table(spark, lake, name) for name in spec.inputs])
        layout = {}
        if model in BY_TICKER:
            layout = {
                "bucket_by": "ticker",
                "buckets": lake.ticker_buckets,
                "sort_by": [BY_TICKER[model]],
            }
        replace_table(
            content, f"{lake.gold}.{model}", validate=_require(CHECKS + EXTRA_CHECKS, model), **layout
        )


def build(spark: SparkSession, lake: Lake, run_ts: datetime | None = None) -> None:
    build_silver(spark, lake)
    update_snapshot(spark, lake, run_ts)
    build_gold(spark, lake)


def quality_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """All data tests over the built tables, and the values each cleaned table had to reject."""
    models = {name: _table(spark, lake, name) for name in (*STAGING_INPUT, *GOLD)}
    result = report(models, CHECKS + EXTRA_CHECKS)
    for model, source in STAGING_INPUT.items():
        if silver.STAGING[model].casts:
            rejects = silver.rejected_values(spark.table(f"{lake.bronze}.{source}"), model)
            result = result.unionByName(_reject_rows(rejects, model))
    return result


def landing_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """Values that were rejected earlier: texts of Landing that are no date or timestamp, and values that are
    not of the type their field has."""
    result = None
    for table, spec in TABLES.items():
        if spec.text_casts:
            envelopes = bronze.read_landing(spark, lake.landing_root, spec.source)
            part = _reject_rows(bronze.rejected_values(envelopes, table), table)
            result = part if result is None else result.unionByName(part)
    for source in SOURCES:
        envelopes = bronze.read_landing(spark, lake.landing_root, source)
        part = _reject_rows(bronze.mismatched_values(envelopes, source), source)
        result = part if result is None else result.unionByName(part)
    return result


def _reject_rows(rejects: DataFrame, model: str) -> DataFrame:
    return rejects.select(
        F.concat(F.lit(f"castable_{model}_"), "column_name").alias("test_name"),
        F.lit(model).alias("model"),
        F.col("rejected").alias("violations"),
        F.when(F.col("rejected") == 0, "pass").otherwise("warn").alias("status"),
    )


def freshness_report(spark: SparkSession, lake: Lake, **limits) -> DataFrame:
    """When each typed table was last loaded, from the footers of its files."""
    ends = {t: bounds(spark, f"{lake.bronze}.{t}", ["_ingested_at"])["_ingested_at"] for t in TABLES}
    rows = [F.struct(F.lit(t).alias("table_name"), high.alias("last_loaded_at")) for t, (_, high) in ends.items()]
    return freshness_status(spark.range(1).select(F.inline(F.array(*rows))), **limits)


def promote_and_load(
    spark: SparkSession, source: Lake, target: Lake, *, since: str | None = None
) -> dict[str, dict[str, int]]:
    """Bring new landing files over, then load the target's typed tables from its own Landing; with ``since``
    both steps leave out older folders."""
    promote(
        spark,
        source.landing_root,
        target.landing_root,
        f"{target.bronze}.promoted_files",
        SOURCES,
        since=since,
        compression=target.landing_compression,
    )
    first = date.fromisoformat(since) if since else None
    return bronze.load_bronze(
        spark, landing_root=target.landing_root, schema=target.bronze, since=first
    )
