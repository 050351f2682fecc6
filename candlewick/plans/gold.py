"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators import (
    bar_metrics,
    current_state,
    day_spine,
    dedup_latest,
    spread_join,
)
from candlewick.operators import rolling
from candlewick.plans.silver import STAGING

# The attributes whose change opens a new ticker version, and their output order.
TRACKED = ("name", "primary_exchange", "sic_code", "type", "active", "currency_name")


def ticker_current_state(overview: DataFrame) -> DataFrame:
    """Newest overview of each ticker, reduced to the tracked attributes. The cleaned overview has one
    row per ticker and day, so no tie is left and untracked columns need not be read."""
    newest = [F.col(c).desc_nulls_last() for c in ("snapshot_date", "_ingested_at")]
    return current_state(overview, "ticker", newest, TRACKED, tiebreak=[])


def dim_ticker(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "ticker", *TRACKED, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def dim_date(bars: DataFrame, date_col: str = "trade_date", buffer_days: int = 30) -> DataFrame:
    return day_spine(bars, date_col, buffer_days)


def _latest_attributes(
    df: DataFrame, key: str, columns: list[str], order: list[str], tiebreak: list[Column]
) -> DataFrame:
    newest = [F.col(c).desc_nulls_last() for c in order]
    known = df.filter(F.col(key).isNotNull())
    return dedup_latest(known, [key], newest, tiebreak).select(key, *columns)


def dim_publisher(articles: DataFrame) -> DataFrame:
    """Newest attributes of each named publisher; equal times fall to the smallest article id."""
    columns = [f"publisher_{p}" for p in ("homepage_url", "logo_url", "favicon_url")]
    return _latest_attributes(
        articles, "publisher_name", columns, ["published_utc"], [F.col("article_id").asc()]
    )


def dim_industry(overview: DataFrame) -> DataFrame:
    """Newest description of each industry code; many tickers share a code and a day, so the newest
    ingest and then the smallest ticker decide."""
    return _latest_attributes(
        overview,
        "sic_code",
        ["sic_description"],
        ["snapshot_date", "_ingested_at"],
        [F.col("ticker").asc()],
    )


def _projection(model: str):
    columns = tuple(STAGING[model].columns)

    def project(staged: DataFrame) -> DataFrame:
        return staged.select(*columns)

    return project


fct_daily_bars = _projection("stg_daily_bars")
fct_splits = _projection("stg_splits")
fct_dividends = _projection("stg_dividends")


def fct_ticker_daily_metrics(overview: DataFrame) -> DataFrame:
    return overview.select(
        "ticker",
        "snapshot_date",
        "market_cap",
        "share_class_shares_outstanding",
        "weighted_shares_outstanding",
    )


def fct_news_sentiment(sentiment: DataFrame, articles: DataFrame) -> DataFrame:
    """Each sentiment with its article's metadata; sentiment without an article is dropped."""
    metadata = articles.select("article_id", "title", "published_utc", "publisher_name")
    mentions = sentiment.select("article_id", "ticker", "sentiment", "sentiment_reasoning")
    return spread_join(mentions, metadata, ["article_id"], "inner").select(
        "article_id",
        "ticker",
        "title",
        "published_utc",
        F.col("published_utc").cast("date").alias("published_date"),
        "publisher_name",
        "sentiment",
        "sentiment_reasoning",
    )


def fct_daily_returns(bars: DataFrame, threshold: float = rolling.MOVE_THRESHOLD) -> DataFrame:
    keep = ("ticker", "trade_date", "close_price")
    return bar_metrics(bars, rolling.RETURN_COLUMNS, keep=keep, threshold=threshold)


def fct_moving_averages(bars: DataFrame, band: float = rolling.TREND_BAND) -> DataFrame:
    keep = ("ticker", "trade_date", "close_price")
    return bar_metrics(bars, rolling.AVERAGE_COLUMNS, keep=keep, band=band)


def fct_volume_anomalies(
    bars: DataFrame, window: int = rolling.VOLUME_WINDOW, factor: float = rolling.SPIKE_FACTOR
) -> DataFrame:
    keep = ("ticker", "trade_date", "volume")
    return bar_metrics(bars, rolling.VOLUME_COLUMNS, keep=keep, window=window, factor=factor)
