"""The data tests of the cleaned tables and the facts."""

from __future__ import annotations

from candlewick.operators.quality import COMBINATION, NOT_NULL, SINGLE_CURRENT, UNIQUE, Check

# Which columns carry which test.
REQUIRED = {
    "stg_daily_bars": ("ticker", "trade_date", "close_price"),
    "stg_ticker_overview": ("ticker", "snapshot_date"),
    "stg_splits": ("split_id", "ticker"),
    "stg_dividends": ("dividend_id", "ticker"),
    "stg_news_articles": ("article_id",),
    "stg_news_sentiment": ("article_id", "ticker"),
    "dim_ticker": ("ticker", "valid_from"),
    "dim_date": ("date_day",),
    "dim_publisher": ("publisher_name",),
    "dim_industry": ("sic_code",),
    "fct_daily_bars": ("ticker", "trade_date"),
    "fct_daily_returns": ("ticker", "trade_date"),
    "fct_moving_averages": ("ticker", "trade_date"),
    "fct_volume_anomalies": ("ticker", "trade_date"),
    "fct_ticker_daily_metrics": ("ticker", "snapshot_date"),
    "fct_splits": ("split_id",),
    "fct_dividends": ("dividend_id",),
    "fct_news_sentiment": ("article_id", "ticker"),
}
UNIQUE_COLUMN = {
    "stg_splits": "split_id",
    "stg_dividends": "dividend_id",
    "stg_news_articles": "article_id",
    "dim_date": "date_day",
    "dim_publisher": "publisher_name",
    "dim_industry": "sic_code",
    "fct_splits": "split_id",
    "fct_dividends": "dividend_id",
}
UNIQUE_COLUMNS = {
    "stg_daily_bars": ("ticker", "trade_date"),
    "stg_ticker_overview": ("ticker", "snapshot_date"),
    "stg_news_sentiment": ("article_id", "ticker"),
    "fct_daily_bars": ("ticker", "trade_date"),
    "fct_daily_returns": ("ticker", "trade_date"),
    "fct_volume_anomalies": ("ticker", "trade_date"),
    "fct_ticker_daily_metrics": ("ticker", "snapshot_date"),
    "fct_news_sentiment": ("article_id", "ticker"),
}

CHECKS: tuple[Check, ...] = (
    *(Check(model, NOT_NULL, (c,)) for model, columns in REQUIRED.items() for c in columns),
    *(Check(model, UNIQUE, (c,)) for model, c in UNIQUE_COLUMN.items()),
    *(Check(model, COMBINATION, columns) for model, columns in UNIQUE_COLUMNS.items()),
    Check("dim_ticker", SINGLE_CURRENT, ("ticker",)),
)

# The one fact with this grain that the list above leaves untested.
EXTRA_CHECKS: tuple[Check, ...] = (
    Check("fct_moving_averages", COMBINATION, ("ticker", "trade_date")),
)
