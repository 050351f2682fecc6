"""Cleaned tables: typed columns and one row per key, the newest ingest."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators import cast_rejects, dedup_latest
from candlewick.sources.registry import AUDIT


@dataclass(frozen=True)
class Staging:
    """Column types in output order (None: as stored) and the key of the newest-wins choice."""

    columns: Mapping[str, str | None]
    keys: tuple[str, ...]
    derived: Callable[[], dict[str, Column]] = dict

    @property
    def casts(self) -> dict[str, str]:
        return {name: kind for name, kind in self.columns.items() if kind}


def _as_is(*names: str) -> dict[str, None]:
    return dict.fromkeys(names)


def _snapshot_day() -> dict[str, Column]:
    return {"snapshot_date": F.col("_ingested_at").cast("date")}


STAGING: Mapping[str, Staging] = {
    "stg_daily_bars": Staging(
        {
            **_as_is("ticker"),
            "trade_date": "date",
            "open_price": "double",
            "high_price": "double",
            "low_price": "double",
            "close_price": "double",
            "volume": "bigint",
            "vwap": "double",
            "transaction_count": "bigint",
        },
        ("ticker", "trade_date"),
    ),
    "stg_ticker_overview": Staging(
        {
            **_as_is("ticker", "name", "market", "primary_exchange", "type"),
            "active": "boolean",
            **_as_is("currency_name", "sic_code", "sic_description"),
            "market_cap": "double",
            "share_class_shares_outstanding": "bigint",
            "weighted_shares_outstanding": "bigint",
            "total_employees": "bigint",
            "list_date": "date",
        },
        ("ticker", "snapshot_date"),
        _snapshot_day,
    ),
    "stg_splits": Staging(
        {
            **_as_is("split_id", "ticker"),
            "execution_date": "date",
            "split_from": "double",
            "split_to": "double",
            **_as_is("adjustment_type"),
            "historical_adjustment_factor": "double",
        },
        ("split_id",),
    ),
    "stg_dividends": Staging(
        {
            **_as_is("dividend_id", "ticker"),
            "ex_dividend_date": "date",
            "declaration_date": "date",
            "record_date": "date",
            "pay_date": "date",
            "cash_amount": "double",
            **_as_is("currency", "frequency", "distribution_type"),
            "historical_adjustment_factor": "double",
        },
        ("dividend_id",),
    ),
    "stg_news_articles": Staging(
        _as_is(
            "article_id",
            "title",
            "description",
            "article_url",
            "published_utc",
            "publisher_name",
            "publisher_homepage_url",
            "publisher_logo_url",
            "publisher_favicon_url",
        ),
        ("article_id",),
    ),
    "stg_news_sentiment": Staging(
        _as_is("article_id", "ticker", "sentiment", "sentiment_reasoning"),
        ("article_id", "ticker"),
    ),
}


def typed(bronze: DataFrame, model: str) -> DataFrame:
    """The columns of a cleaned table; all rows."""
    spec = STAGING[model]
    return bronze.select(
        *[
            (F.col(name).try_cast(kind) if kind else F.col(name)).alias(name)
            for name, kind in spec.columns.items()
        ],
        *[expr.alias(name) for name, expr in spec.derived().items()],
        *AUDIT,
    )


def stage(bronze: DataFrame, model: str) -> DataFrame:
    """Cast, then keep the newest row of each key.

    A value that does not fit its type becomes NULL and is counted by :func:`rejected_values`. A double
    cast to bigint is cut, not rounded. Equal ingest times fall to the source file, then to the
    remaining columns in output order, so the survivor never depends on partitioning.
    """
    return dedup_latest(typed(bronze, model), STAGING[model].keys, newest_first(), tiebreak=payload_order(model))


def newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in AUDIT]


def payload_order(model: str) -> list[Column]:
    spec = STAGING[model]
    return [F.col(c).desc_nulls_last() for c in spec.columns if c not in spec.keys]


def rejected_values(bronze: DataFrame, model: str) -> DataFrame:
    return cast_rejects(bronze, STAGING[model].casts)


def stg_daily_bars(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_daily_bars")


def stg_ticker_overview(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_ticker_overview")


def stg_splits(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_splits")


def stg_dividends(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_dividends")


def stg_news_articles(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_news_articles")


def stg_news_sentiment(bronze: DataFrame) -> DataFrame:
    return stage(bronze, "stg_news_sentiment")


MODELS: Sequence[str] = tuple(STAGING)
