"""What each landing source looks like and which typed tables it feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import epoch_ms_to_date

# --- Fixed values: vendor field names and types, source names, endpoints, watchlist. ---

RECORD_DDL = {
    "daily_bars": "t bigint, o double, h double, l double, c double, v double, vw double, n bigint",
    "ticker_overview": (
        "ticker string, name string, market string, primary_exchange string, type string, "
        "active boolean, currency_name string, sic_code string, sic_description string, "
        "market_cap double, share_class_shares_outstanding bigint, "
        "weighted_shares_outstanding bigint, total_employees bigint, list_date string"
    ),
    "splits": (
        "id string, ticker string, execution_date string, split_from double, split_to double, "
        "adjustment_type string, historical_adjustment_factor double"
    ),
    "dividends": (
        "id string, ticker string, ex_dividend_date string, declaration_date string, "
        "record_date string, pay_date string, cash_amount double, currency string, "
        "frequency bigint, distribution_type string, historical_adjustment_factor double"
    ),
    "news": (
        "id string, title string, description string, article_url string, published_utc string, "
        "publisher struct<name: string, homepage_url: string, logo_url: string, favicon_url: string>, "
        "insights array<struct<ticker: string, sentiment: string, sentiment_reasoning: string>>"
    ),
}

ENDPOINTS = {
    "daily_bars": "/v2/aggs/ticker/{ticker}/range/1/day/{start}/{end}",
    "ticker_overview": "/v3/reference/tickers/{ticker}",
    "splits": "/stocks/v1/splits",
    "dividends": "/stocks/v1/dividends",
    "news": "/v2/reference/news",
}

WATCHLIST = ("AAPL", "MSFT", "AMZN", "JPM", "JNJ", "TSLA", "XOM", "KO", "DIS", "BA")

# --- End of fixed values. ---

CORRUPT = "_corrupt_record"
AUDIT = ("_ingested_at", "_source_file")


@dataclass(frozen=True)
class Source:
    name: str

    @property
    def record(self) -> T.StructType:
        return T.StructType.fromDDL(RECORD_DDL[self.name])

    @property
    def endpoint(self) -> str:
        return ENDPOINTS[self.name]

    @property
    def envelope(self) -> T.StructType:
        """Schema of one landed line."""
        request = T.StructType.fromDDL("endpoint string, ticker string")
        return (
            T.StructType()
            .add("record", self.record)
            .add("_ingested_at", T.StringType())
            .add("_request_metadata", request)
            .add(CORRUPT, T.StringType())
        )


SOURCES: Mapping[str, Source] = {name: Source(name) for name in RECORD_DDL}


def _same(*names: str) -> dict[str, Column]:
    return {name: F.col(f"record.{name}") for name in names}


def _day(field_name: str) -> Column:
    return F.col(f"record.{field_name}").try_cast("date")


def _bars() -> dict[str, Column]:
    return {
        "ticker": F.col("_request_metadata.ticker"),
        "trade_date": epoch_ms_to_date(F.col("record.t")),
        "open_price": F.col("record.o"),
        "high_price": F.col("record.h"),
        "low_price": F.col("record.l"),
        "close_price": F.col("record.c"),
        "volume": F.col("record.v"),
        "vwap": F.col("record.vw"),
        "transaction_count": F.col("record.n"),
    }


def _overview() -> dict[str, Column]:
    return _same(*SOURCES["ticker_overview"].record.names)


def _splits() -> dict[str, Column]:
    return {
        "split_id": F.col("record.id"),
        **_same("ticker"),
        "execution_date": _day("execution_date"),
        **_same("split_from", "split_to", "adjustment_type", "historical_adjustment_factor"),
    }


def _dividends() -> dict[str, Column]:
    dates = ("ex_dividend_date", "declaration_date", "record_date", "pay_date")
    return {
        "dividend_id": F.col("record.id"),
        **_same("ticker"),
        **{name: _day(name) for name in dates},
        **_same(
            "cash_amount",
            "currency",
            "frequency",
            "distribution_type",
            "historical_adjustment_factor",
        ),
    }


def _articles() -> dict[str, Column]:
    parts = ("name", "homepage_url", "logo_url", "favicon_url")
    return {
        "article_id": F.col("record.id"),
        **_same("title", "description", "article_url"),
        "published_utc": F.col("record.published_utc").try_cast("timestamp"),
        **{f"publisher_{p}": F.col(f"record.publisher.{p}") for p in parts},
    }


def _sentiment() -> dict[str, Column]:
    fields = ("ticker", "sentiment", "sentiment_reasoning")
    return {
        "article_id": F.col("record.id"),
        **{name: F.col(f"_element.{name}") for name in fields},
    }


def _ingested_day() -> dict[str, Column]:
    return {"_ingested_day": F.col("_ingested_at").cast("date")}


def _no_derived() -> dict[str, Column]:
    return {}


@dataclass(frozen=True)
class BronzeTable:
    """A typed table: its landing source, columns, natural key and batch rules.

    ``explode`` names an array: one row per element, none for a NULL or empty array.
    ``unique_in_batch`` is set where a batch itself is made unique; the other tables keep every
    version that a batch brings and leave the choice to the cleaned layer.
    ``text_casts`` lists text fields whose cast happens here, for the rejected-value count.
    ``range_key`` is a column that grows with time and is a key or gives one, by which a small batch limits
    its lookup.
    """

    name: str
    source: str
    columns: Callable[[], dict[str, Column]]
    keys: tuple[str, ...]
    derived_keys: Callable[[], dict[str, Column]] = field(default=_no_derived)
    unique_in_batch: bool = False
    explode: str | None = None
    text_casts: Mapping[str, str] = field(default_factory=dict)
    range_key: str | None = None


TABLES: Mapping[str, BronzeTable] = {
    t.name: t
    for t in (
        BronzeTable(
            "daily_bars", "daily_bars", _bars, ("ticker", "trade_date"), range_key="trade_date"
        ),
        BronzeTable(
            "ticker_overview",
            "ticker_overview",
            _overview,
            ("ticker",),
            derived_keys=_ingested_day,
            range_key="_ingested_at",
        ),
        BronzeTable(
            "splits", "splits", _splits, ("split_id",), text_casts={"execution_date": "date"}
        ),
        BronzeTable(
            "dividends",
            "dividends",
            _dividends,
            ("dividend_id",),
            text_casts={
                "ex_dividend_date": "date",
                "declaration_date": "date",
                "record_date": "date",
                "pay_date": "date",
            },
        ),
        BronzeTable(
            "news_articles",
            "news",
            _articles,
            ("article_id",),
            unique_in_batch=True,
            text_casts={"published_utc": "timestamp"},
        ),
        BronzeTable(
            "news_sentiment",
            "news",
            _sentiment,
            ("article_id", "ticker"),
            unique_in_batch=True,
            explode="record.insights",
        ),
    )
}
