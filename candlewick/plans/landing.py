"""Which records a run lands. The feed is a DataFrame per source: the request's ``ticker`` and the vendor
``record``, as they would arrive from the vendor."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import epoch_ms_to_date
from candlewick.operators import event_sequence, spread_join, top_k_recent
from candlewick.sources.landing import land
from candlewick.sources.registry import SOURCES, WATCHLIST

# Days of bars that a daily run and a backfill ask for, news window and cap, cadence groups.
DAILY_BAR_DAYS = 5
BACKFILL_BAR_DAYS = 365
NEWS_DAYS = 7
NEWS_PER_TICKER = 5
DAILY_SOURCES = ("daily_bars", "news")
REFERENCE_SOURCES = ("ticker_overview", "splits", "dividends")


def on_watchlist(df: DataFrame, tickers: DataFrame | Iterable[str] = WATCHLIST) -> DataFrame:
    """Rows of watched tickers. Names become a filter that reaches the scan; a table of tickers may be
    of any size, is joined, and Spark decides on a broadcast by its size."""
    if isinstance(tickers, DataFrame):
        return spread_join(df, tickers, ["ticker"], "left_semi")
    return df.filter(F.col("ticker").isin(*tickers))


def date_window(df: DataFrame, day: Column, start: date | Column, end: date | Column) -> DataFrame:
    """Rows whose day lies between ``start`` and ``end``, both included."""
    return df.filter(day.between(F.lit(start), F.lit(end)))


def rolling_window(df: DataFrame, day: Column, end: date | Column, days: int) -> DataFrame:
    """Rows of ``end`` and the ``days`` days before it. ``end`` is a date or a date column, such as a
    scalar subquery; it is never taken from the clock here."""
    last = F.lit(end)
    return date_window(df, day, F.date_sub(last, days), last)


def bars_range(
    df: DataFrame,
    start: date | Column,
    end: date | Column,
    tickers: DataFrame | Iterable[str] | None = None,
) -> DataFrame:
    """The bars of some tickers (default: all) in a date range."""
    bars = date_window(df, F.col("trade_date"), start, end)
    return bars if tickers is None else on_watchlist(bars, tickers)


def recent_news(
    df: DataFrame,
    published: Column,
    article_id: Column,
    end: date | Column,
    *,
    key: str = "ticker",
    days: int = NEWS_DAYS,
    limit: int = NEWS_PER_TICKER,
) -> DataFrame:
    """The newest articles of each ticker published since ``end - days``, at most ``limit`` in total."""
    recent = df.filter(published >= F.date_sub(F.lit(end), days))
    return top_k_recent(recent, [key], [published.desc(), article_id.asc()], limit)


def event_history(
    df: DataFrame, date_col: str, id_col: str, *, id_block: Column | None = None
) -> DataFrame:
    """The full event history of each ticker, numbered from the newest event."""
    return event_sequence(df, "ticker", date_col, id_col, id_block=id_block)


def _readable(feed: DataFrame, time: Column, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a cut by time to the records whose time can be read; the others pass, for the load to set aside."""
    return keep(feed.filter(time.isNotNull())).unionByName(feed.filter(time.isNull()))


def land_source(
    feed: DataFrame,
    source: str,
    root: str,
    *,
    end: date | Column,
    days: int | None = None,
    per_ticker: int | None = None,
    ingested_at: datetime | None = None,
    run_date: date | None = None,
    compression: str | None = None,
) -> str:
    """Append what a feed brings of one source to Landing, every record of it.

    Landing keeps what arrived: it neither chooses between replies nor judges what it cannot read. Only where
    the caller states it are bars and news cut, to the ``days`` before ``end`` and news to the newest
    ``per_ticker`` articles of a ticker; a record whose time cannot be read is never cut. A reply without
    a record is landed as an empty one.
    """
    ticker, record = F.col("ticker"), F.col("record")
    if source == "daily_bars" and days is not None:
        day = epoch_ms_to_date(F.col("record.t"))
        feed = _readable(feed, day, lambda rows: rolling_window(rows, day, end, days))
    elif source == "news":
        published = F.col("record.published_utc").try_cast("timestamp")
        newest = [published.desc(), F.col("record.id").asc()]
        if days is not None:
            feed = _readable(feed, published, lambda rows: rows.filter(published >= F.date_sub(F.lit(end), days)))
        if per_ticker is not None:
            feed = _readable(feed, published, lambda rows: top_k_recent(rows, ["ticker"], newest, per_ticker))
    last = F.lit(end)
    asked = DAILY_BAR_DAYS if days is None else days
    endpoint = F.lit(SOURCES[source].endpoint)
    for slot, value in (
        ("{ticker}", ticker),
        ("{start}", F.date_sub(last, asked).cast("string")),
        ("{end}", last.cast("string")),
    ):
        endpoint = F.replace(endpoint, F.lit(slot), value)
    return land(
        feed,
        source,
        root,
        ticker=ticker,
        record=F.coalesce(record, F.from_json(F.lit("{}"), feed.schema["record"].dataType)),
        endpoint=endpoint,
        ingested_at=ingested_at,
        run_date=run_date,
        compression=compression,
    )


def land_sources(
    feeds: Mapping[str, DataFrame],
    sources: Iterable[str],
    root: str,
    *,
    end: date | Column | None = None,
    days: Mapping[str, int] | None = None,
    per_ticker: int | None = None,
    ingested_at: datetime | None = None,
    run_date: date | None = None,
    tickers: DataFrame | Iterable[str] = WATCHLIST,
    compression: str | None = None,
) -> dict[str, str]:
    """Land some sources for the watched tickers; the first error stops the run.

    ``days`` holds a window by source, for those that are to have one.
    """
    last = datetime.now(UTC).date() if end is None else end
    return {
        source: land_source(
            on_watchlist(feeds[source], tickers),
            source,
            root,
            end=last,
            days=(days or {}).get(source),
            per_ticker=per_ticker,
            ingested_at=ingested_at,
            run_date=run_date,
            compression=compression,
        )
        for source in sources
    }


def land_daily(feeds: Mapping[str, DataFrame], root: str, **options) -> dict[str, str]:
    """The daily run: bars and news. The usual request asks for DAILY_BAR_DAYS of bars and, of NEWS_DAYS,
    NEWS_PER_TICKER articles; a feed that holds more is cut only if ``days`` and ``per_ticker`` say so."""
    return land_sources(feeds, DAILY_SOURCES, root, **options)


def land_reference(feeds: Mapping[str, DataFrame], root: str, **options) -> dict[str, str]:
    """The weekly run: overview, splits, dividends."""
    return land_sources(feeds, REFERENCE_SOURCES, root, **options)


def backfill(feeds: Mapping[str, DataFrame], source: str, root: str, **options) -> dict[str, str]:
    """One source for all watched tickers. The usual request for bars asks for BACKFILL_BAR_DAYS."""
    return land_sources(feeds, (source,), root, **options)
