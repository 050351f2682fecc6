"""The registered queries in plain SQL, written on their own and run by another engine."""

from __future__ import annotations

BARS = """
bronze_bars AS (
  SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
         l_extendedprice * (1 - l_discount) AS open_price,
         l_extendedprice AS high_price,
         l_extendedprice * (1 - l_discount) AS low_price,
         l_extendedprice AS close_price,
         CAST(trunc(l_quantity) AS BIGINT) AS volume,
         l_extendedprice / l_quantity AS vwap,
         CAST(l_linenumber AS BIGINT) AS transaction_count,
         to_timestamp(l_orderkey) AT TIME ZONE 'UTC' AS _ingested_at,
         CAST(l_partkey AS VARCHAR) AS _source_file
  FROM lineitem),
stg_daily_bars AS (
  SELECT * FROM bronze_bars
  QUALIFY row_number() OVER (
    PARTITION BY ticker, trade_date
    ORDER BY _ingested_at DESC, _source_file DESC, open_price DESC, high_price DESC, low_price DESC,
             close_price DESC, volume DESC, vwap DESC, transaction_count DESC) = 1)"""

OVERVIEW = """
bronze_overview AS (
  SELECT o_custkey AS ticker, 'Company ' || o_custkey AS name, 'stocks' AS market,
         o_orderpriority AS primary_exchange, o_orderstatus AS type,
         o_orderstatus <> 'F' AS active, 'usd' AS currency_name,
         CASE WHEN o_orderpriority <> '5-LOW' THEN substr(o_orderpriority, 1, 1) END AS sic_code,
         o_orderpriority || ' ' || o_orderstatus AS sic_description,
         o_totalprice AS market_cap,
         CAST(trunc(o_totalprice) AS BIGINT) AS share_class_shares_outstanding,
         CAST(trunc(o_totalprice * 2) AS BIGINT) AS weighted_shares_outstanding,
         o_orderkey AS total_employees,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS list_date,
         CAST(o_orderdate AS DATE) AS snapshot_date, o_orderdate AS _ingested_at,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _source_file
  FROM orders),
stg_ticker_overview AS (
  SELECT * FROM bronze_overview
  QUALIFY row_number() OVER (
    PARTITION BY ticker, snapshot_date ORDER BY _ingested_at DESC, _source_file DESC) = 1)"""

SPLITS = """
bronze_splits AS (
  SELECT o_custkey || '-' || strftime(o_orderdate, '%Y%m') AS split_id, o_custkey AS ticker,
         CAST(o_orderdate AS DATE) AS execution_date, CAST(1 AS DOUBLE) AS split_from,
         CAST(o_orderkey % 7 AS DOUBLE) AS split_to, o_orderpriority AS adjustment_type,
         o_totalprice / 4 AS historical_adjustment_factor, o_orderkey * 3 AS version,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _source_file
  FROM orders),
stg_splits AS (
  SELECT * FROM bronze_splits
  QUALIFY row_number() OVER (PARTITION BY split_id ORDER BY version DESC) = 1)"""

DIVIDENDS = """
bronze_dividends AS (
  SELECT o_custkey || '-' || strftime(o_orderdate, '%Y%m') AS dividend_id, o_custkey AS ticker,
         CAST(o_orderdate AS DATE) AS ex_dividend_date,
         CAST(o_orderdate AS DATE) - 30 AS declaration_date,
         CAST(o_orderdate AS DATE) + 1 AS record_date,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 14 END AS pay_date,
         o_totalprice AS cash_amount, 'USD' AS currency, CAST(4 AS BIGINT) AS frequency,
         o_orderpriority AS distribution_type, CAST(1 AS DOUBLE) AS historical_adjustment_factor,
         o_orderkey * 5 AS version, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _source_file
  FROM orders),
stg_dividends AS (
  SELECT * FROM bronze_dividends
  QUALIFY row_number() OVER (PARTITION BY dividend_id ORDER BY version DESC) = 1)"""

# article_id is the order key, which is unique: cleaning keeps every article.
ARTICLES = """
stg_news_articles AS (
  SELECT o_orderkey AS article_id, 'Order ' || o_orderkey AS title, o_orderstatus AS description,
         'https://example.org/' || o_orderkey AS article_url, o_orderdate AS published_utc,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS publisher_name,
         'https://example.org/p/' || o_custkey AS publisher_homepage_url,
         o_custkey || '.png' AS publisher_logo_url, o_custkey || '.ico' AS publisher_favicon_url,
         to_timestamp(o_orderkey) AT TIME ZONE 'UTC' AS _ingested_at,
         lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS _source_file
  FROM orders)"""

SENTIMENT = """
bronze_sentiment AS (
  SELECT l_orderkey AS article_id, l_partkey AS ticker, l_returnflag AS sentiment,
         l_returnflag || ' ' || l_linestatus AS sentiment_reasoning,
         to_timestamp(l_linenumber) AT TIME ZONE 'UTC' AS _ingested_at,
         lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS _source_file
  FROM lineitem),
stg_news_sentiment AS (
  SELECT * FROM bronze_sentiment
  QUALIFY row_number() OVER (
    PARTITION BY article_id, ticker
    ORDER BY _ingested_at DESC, _source_file DESC, sentiment DESC, sentiment_reasoning DESC) = 1)"""

NEWS = """
fct_news_sentiment AS (
  SELECT s.article_id, s.ticker, a.title, a.published_utc,
         CAST(a.published_utc AS DATE) AS published_date, a.publisher_name, s.sentiment,
         s.sentiment_reasoning
  FROM stg_news_sentiment s JOIN stg_news_articles a ON s.article_id = a.article_id)"""


def history(source: str, name: str = "history") -> str:
    """Versions of the tracked attributes over the dated rows of ``source``."""
    return f"""
{name}_marked AS (
  SELECT ticker, name, primary_exchange, sic_code, type, active, currency_name, snapshot_date,
         row_number() OVER w = 1
         OR lag(name) OVER w IS DISTINCT FROM name
         OR lag(primary_exchange) OVER w IS DISTINCT FROM primary_exchange
         OR lag(sic_code) OVER w IS DISTINCT FROM sic_code
         OR lag(type) OVER w IS DISTINCT FROM type
         OR lag(active) OVER w IS DISTINCT FROM active
         OR lag(currency_name) OVER w IS DISTINCT FROM currency_name AS starts
  FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY snapshot_date)),
{name} AS (
  SELECT ticker, name, primary_exchange, sic_code, type, active, currency_name,
         snapshot_date AS valid_from,
         lead(snapshot_date) OVER (PARTITION BY ticker ORDER BY snapshot_date) AS valid_to
  FROM {name}_marked WHERE starts)"""


RETURNS = """
with_prev AS (
  SELECT *, lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close_price
  FROM stg_daily_bars),
with_return AS (
  SELECT *, CASE WHEN prev_close_price IS NOT NULL AND prev_close_price <> 0
                 THEN (close_price - prev_close_price) / prev_close_price END AS r
  FROM with_prev)"""

AVERAGES = """
with_averages AS (
  SELECT *,
         avg(close_price) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma5,
         avg(close_price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20,
         avg(close_price) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS ma50,
         stddev_samp(close_price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS vol20
  FROM stg_daily_bars WINDOW w AS (PARTITION BY ticker ORDER BY trade_date))"""

VOLUMES = """
with_volume AS (
  SELECT *, avg(volume) OVER (PARTITION BY ticker ORDER BY trade_date
                              ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS base
  FROM stg_daily_bars)"""

TREND = """CASE WHEN ma20 IS NULL THEN NULL WHEN ma5 > ma20 * 1.01 THEN 'uptrend'
            WHEN ma5 < ma20 * 0.99 THEN 'downtrend' ELSE 'sideways' END"""

BAR_COLUMNS = """ticker, CAST(trade_date AS VARCHAR) AS trade_date, open_price, high_price, low_price,
       close_price, volume, vwap, transaction_count"""
STAMP = "strftime(_ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at, _source_file"
VERSION_COLUMNS = """ticker, name, primary_exchange, sic_code, type, active, currency_name,
       CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to"""
DIVIDEND_COLUMNS = """dividend_id, ticker, CAST(ex_dividend_date AS VARCHAR) AS ex_dividend_date,
       CAST(declaration_date AS VARCHAR) AS declaration_date,
       CAST(record_date AS VARCHAR) AS record_date, CAST(pay_date AS VARCHAR) AS pay_date,
       cash_amount, currency, frequency, distribution_type, historical_adjustment_factor"""
SPLIT_COLUMNS = """split_id, ticker, CAST(execution_date AS VARCHAR) AS execution_date, split_from,
       split_to, adjustment_type, historical_adjustment_factor"""

MENTIONS = """
mentions AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS article_id, 'P' || l_partkey AS ticker,
         l_returnflag AS sentiment, l_linenumber || '/' || l_suppkey AS sentiment_reasoning,
         l_linenumber, l_partkey
  FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus <> 'F'
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'S' || l_suppkey, l_linestatus,
         l_linenumber || '/' || l_partkey, l_linenumber, l_partkey
  FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus <> 'F')"""

FACTS = """
facts AS (
  SELECT o_orderkey AS fact_id, o_custkey AS ticker, CAST(o_orderdate AS DATE) AS trade_date
  FROM orders)"""

ASOF_COLUMNS = """f.fact_id, f.ticker, CAST(f.trade_date AS VARCHAR) AS trade_date, h.type,
       h.primary_exchange, CAST(h.valid_from AS VARCHAR) AS valid_from,
       CAST(h.valid_to AS VARCHAR) AS valid_to"""


def asof(end: str, kind: str = "JOIN", source: str = "stg_ticker_overview", extra: str = "") -> str:
    return f"""WITH {OVERVIEW}{extra}, {history(source)}, {FACTS}
SELECT {ASOF_COLUMNS}
FROM facts f {kind} history h
  ON f.ticker = h.ticker AND f.trade_date >= h.valid_from
     AND (h.valid_to IS NULL OR f.trade_date {end} h.valid_to)"""


def append(stored_keys: str) -> str:
    return f"""WITH {BARS},
stamped AS (SELECT * REPLACE (CASE WHEN transaction_count % 3 <> 2 THEN _ingested_at END AS _ingested_at)
            FROM bronze_bars),
stored AS (SELECT * FROM stamped WHERE transaction_count <= 3),
fresh AS (SELECT * FROM stamped b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE {stored_keys}))
SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, open_price, high_price, low_price,
       close_price, CAST(volume AS DOUBLE) AS volume, vwap, transaction_count, {STAMP}
FROM (SELECT * FROM stored UNION ALL SELECT * FROM fresh)"""


def null_test(model: str, column: str) -> str:
    return f"""SELECT 'not_null_{model}_{column}' AS test_name, '{model}' AS model,
  (SELECT count(*) FROM {model} WHERE {column} IS NULL) AS violations"""


def repeat_test(kind: str, model: str, columns: str, where: str = "true") -> str:
    label = columns.replace(", ", "_")
    return f"""SELECT '{kind}_{model}_{label}' AS test_name, '{model}' AS model,
  (SELECT count(*) FROM (SELECT {columns} FROM {model} WHERE {where}
                         GROUP BY {columns} HAVING count(*) > 1)) AS violations"""


def report(ctes: list[str], tests: list[str]) -> str:
    return f"""WITH {", ".join(ctes)},
tests AS ({" UNION ALL ".join(tests)})
SELECT test_name, model, violations,
       CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status
FROM tests"""


def unique_test(model: str, column: str) -> str:
    return repeat_test("unique", model, column, f"{column} IS NOT NULL")


def combo_test(model: str, columns: str) -> str:
    return repeat_test("unique_combination", model, columns)


SILVER_TESTS = [
    null_test("stg_daily_bars", "ticker"),
    null_test("stg_daily_bars", "trade_date"),
    null_test("stg_daily_bars", "close_price"),
    null_test("stg_ticker_overview", "ticker"),
    null_test("stg_ticker_overview", "snapshot_date"),
    null_test("stg_splits", "split_id"),
    null_test("stg_splits", "ticker"),
    null_test("stg_dividends", "dividend_id"),
    null_test("stg_dividends", "ticker"),
    null_test("stg_news_articles", "article_id"),
    null_test("stg_news_sentiment", "article_id"),
    null_test("stg_news_sentiment", "ticker"),
    unique_test("stg_splits", "split_id"),
    unique_test("stg_dividends", "dividend_id"),
    unique_test("stg_news_articles", "article_id"),
    combo_test("stg_daily_bars", "ticker, trade_date"),
    combo_test("stg_ticker_overview", "ticker, snapshot_date"),
    combo_test("stg_news_sentiment", "article_id, ticker"),
]

GOLD_TESTS = [
    null_test("dim_ticker", "ticker"),
    null_test("dim_ticker", "valid_from"),
    null_test("dim_date", "date_day"),
    null_test("dim_publisher", "publisher_name"),
    null_test("dim_industry", "sic_code"),
    null_test("fct_daily_bars", "ticker"),
    null_test("fct_daily_bars", "trade_date"),
    null_test("fct_daily_returns", "ticker"),
    null_test("fct_daily_returns", "trade_date"),
    null_test("fct_moving_averages", "ticker"),
    null_test("fct_moving_averages", "trade_date"),
    null_test("fct_volume_anomalies", "ticker"),
    null_test("fct_volume_anomalies", "trade_date"),
    null_test("fct_ticker_daily_metrics", "ticker"),
    null_test("fct_ticker_daily_metrics", "snapshot_date"),
    null_test("fct_splits", "split_id"),
    null_test("fct_dividends", "dividend_id"),
    null_test("fct_news_sentiment", "article_id"),
    null_test("fct_news_sentiment", "ticker"),
    unique_test("dim_date", "date_day"),
    unique_test("dim_publisher", "publisher_name"),
    unique_test("dim_industry", "sic_code"),
    unique_test("fct_splits", "split_id"),
    unique_test("fct_dividends", "dividend_id"),
    combo_test("fct_daily_bars", "ticker, trade_date"),
    combo_test("fct_daily_returns", "ticker, trade_date"),
    combo_test("fct_moving_averages", "ticker, trade_date"),
    combo_test("fct_volume_anomalies", "ticker, trade_date"),
    combo_test("fct_ticker_daily_metrics", "ticker, snapshot_date"),
    combo_test("fct_news_sentiment", "article_id, ticker"),
    repeat_test("single_current", "dim_ticker", "ticker", "valid_to IS NULL"),
]

GOLD_VIEWS = """
dim_ticker AS (SELECT * FROM history),
dim_date AS (
  SELECT unnest(range(min(trade_date), max(trade_date) + 30, INTERVAL 1 DAY)) AS date_day
  FROM stg_daily_bars),
dim_publisher AS (
  SELECT DISTINCT publisher_name FROM stg_news_articles WHERE publisher_name IS NOT NULL),
dim_industry AS (SELECT DISTINCT sic_code FROM stg_ticker_overview WHERE sic_code IS NOT NULL),
fct_daily_bars AS (SELECT * FROM stg_daily_bars),
fct_daily_returns AS (SELECT * FROM with_return),
fct_moving_averages AS (SELECT * FROM with_averages),
fct_volume_anomalies AS (SELECT * FROM with_volume),
fct_ticker_daily_metrics AS (SELECT * FROM stg_ticker_overview),
fct_splits AS (SELECT * FROM stg_splits),
fct_dividends AS (SELECT * FROM stg_dividends)"""


def loads(name: str, total: str, status: str = "ok") -> str:
    """A second load of the same rows must add none."""
    return f"""SELECT '{name}' AS table_name, ({total}) AS run_1, ({total}) AS run_2, '{status}' AS status"""


def latest(name: str, expression: str, table: str) -> str:
    return f"SELECT '{name}' AS table_name, (SELECT max({expression}) FROM {table}) AS t"


LANDED_DIVIDENDS = """SELECT CAST(o_orderkey AS VARCHAR) AS dividend_id, CAST(o_custkey AS VARCHAR) AS ticker,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ex_dividend_date,
       CAST(CAST(o_orderdate AS DATE) - 30 AS VARCHAR) AS declaration_date,
       CASE WHEN o_orderstatus <> 'P'
            THEN CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) END AS record_date,
       CAST(CAST(o_orderdate AS DATE) + 14 AS VARCHAR) AS pay_date,
       o_totalprice AS cash_amount, 'USD' AS currency, CAST(4 AS BIGINT) AS frequency,
       o_orderpriority AS distribution_type, '2024-02-01 06:00:00' AS _ingested_at
FROM orders"""

ORACLES: dict[str, str] = {
    "landing_envelope": """
SELECT '{"record":{"id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
       || '"},"_ingested_at":"2024-02-01T06:00:00+00:00","_request_metadata":{"endpoint":"/events",'
       || '"ticker":"' || user_id || '"}}' AS value
FROM events""",
    "land_daily_bars": """
SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
       CASE WHEN l_linenumber < 6 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS trade_date,
       l_extendedprice AS open_price, l_extendedprice AS high_price, l_extendedprice AS low_price,
       l_extendedprice AS close_price, l_quantity AS volume, l_extendedprice AS vwap,
       CAST(l_linenumber AS BIGINT) AS transaction_count, '2024-02-01 06:00:00' AS _ingested_at
FROM lineitem""",
    "land_ticker_overview": """
SELECT CAST(c_custkey AS VARCHAR) AS request_ticker, '/v3/reference/tickers/' || c_custkey AS endpoint,
       CASE WHEN known THEN CAST(c_custkey AS VARCHAR) END AS ticker,
       CASE WHEN known THEN c_name END AS name,
       CASE WHEN known THEN c_mktsegment END AS type,
       CASE WHEN known THEN c_acctbal > 0 END AS active,
       CASE WHEN known THEN c_acctbal END AS market_cap,
       CASE WHEN known THEN CAST(c_nationkey AS BIGINT) END AS total_employees
FROM (SELECT *, c_mktsegment <> 'MACHINERY' AS known FROM customer
      UNION ALL SELECT *, c_mktsegment <> 'MACHINERY' FROM customer WHERE c_nationkey = 0)""",
    "land_splits": """
SELECT CAST(o_orderkey AS VARCHAR) AS split_id, CAST(o_custkey AS VARCHAR) AS ticker,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS execution_date, CAST(1 AS DOUBLE) AS split_from,
       o_totalprice AS split_to, o_orderpriority AS adjustment_type,
       '2024-02-01 06:00:00' AS _ingested_at
FROM orders""",
    "land_dividends": LANDED_DIVIDENDS,
    "land_news": """
SELECT CAST(o_orderkey AS VARCHAR) AS article_id, CAST(o_custkey AS VARCHAR) AS ticker,
       o_orderstatus AS sentiment, 'Order ' || o_orderkey AS title,
       CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
            THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS published_utc,
       o_orderpriority AS publisher_name
FROM orders""",
    "rolling_window": """
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT CAST(max(ts) AS DATE) - 5 FROM events)
                           AND (SELECT CAST(max(ts) AS DATE) FROM events)""",
    "recent_topk": """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
WHERE ts >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 5""",
    "event_history": """
SELECT o_custkey AS ticker, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS event_date,
       o_orderkey AS event_id, o_totalprice AS amount,
       row_number() OVER (PARTITION BY o_custkey
                          ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS event_seq
FROM orders""",
    "bars_range": """
SELECT l_suppkey AS ticker, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trade_date,
       l_extendedprice AS close_price, l_quantity AS volume
FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "watchlist_semi": """
SELECT l_suppkey AS ticker, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trade_date,
       l_extendedprice AS close_price, l_quantity AS volume
FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    "json_scan": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "json_scan_landed": """
SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS split_id,
       CASE WHEN event_id % 10 <> 0 THEN value END AS split_from, event_id % 10 = 0 AS broken
FROM events""",
    "nested_project": LANDED_DIVIDENDS,
    "epoch_ms_date": """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       CAST(CAST(TIMESTAMP '1970-01-01' - (ts - TIMESTAMP '1970-01-01') AS DATE) AS VARCHAR) AS mirrored,
       CAST(NULL AS VARCHAR) AS from_micros, CAST(NULL AS VARCHAR) AS from_nanos
FROM events""",
    "metadata_attach": """
SELECT CAST(event_id AS VARCHAR) AS split_id, CAST(user_id AS VARCHAR) AS ticker,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_date, '2024-02-01 06:00:00' AS _ingested_at,
       'splits/date=2024-02-01' AS folder
FROM events""",
    "explode_nested": f"""WITH {MENTIONS}
SELECT article_id, ticker, sentiment, sentiment_reasoning FROM mentions""",
    "batch_dedup": f"""WITH {MENTIONS}
SELECT article_id, ticker, sentiment, sentiment_reasoning,
       strftime(to_timestamp(l_linenumber) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS _ingested_at,
       lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS _source_file
FROM mentions
QUALIFY row_number() OVER (
  PARTITION BY article_id, ticker
  ORDER BY l_linenumber DESC, sentiment DESC, sentiment_reasoning DESC,
           lpad(CAST(l_partkey AS VARCHAR), 12, '0') DESC) = 1""",
    "anti_new_keys": """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM events
WHERE ts >= DATE '2024-01-11'
  AND event_id NOT IN (SELECT event_id FROM events WHERE ts < DATE '2024-01-16')""",
    "incremental_append": append("s.ticker = b.ticker AND s.trade_date = b.trade_date"),
    "incremental_append_latest": append(
        "s.ticker = b.ticker AND s.trade_date = b.trade_date "
        "AND (b._ingested_at IS NULL OR s._ingested_at >= b._ingested_at)"
    ),
    "null_key_quarantine": """
SELECT CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'append' END AS target,
       CASE WHEN event_type <> 'error' THEN event_id END AS event_key, user_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value
FROM events
WHERE ts >= DATE '2024-01-11' AND (event_type = 'error' OR ts >= DATE '2024-01-16')""",
    "anti_derived_day": """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'quarantine' ELSE 'append' END AS target,
       o_custkey AS ticker, o_orderstatus AS type, o_totalprice AS market_cap, o_orderkey AS total_employees,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS _ingested_at
FROM orders
WHERE o_orderstatus = 'P' OR (o_custkey, CAST(o_orderdate AS DATE)) NOT IN (
  SELECT (o_custkey, CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F')""",
    "idempotency_check": " UNION ALL ".join(
        [
            loads("daily_bars", "SELECT count(*) FROM lineitem"),
            loads("ticker_overview", "SELECT count(*) FROM orders"),
            loads("splits", "SELECT count(*) FROM orders"),
            loads("dividends", "SELECT count(*) FROM orders"),
            loads("news_articles", "SELECT count(DISTINCT o_orderkey) FROM orders"),
            loads("news_sentiment", "SELECT count(DISTINCT (l_orderkey, l_partkey)) FROM lineitem"),
            loads("events", "SELECT count(*) FROM events", "changed"),
        ]
    ),
    "dedup_latest": """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "stg_daily_bars": f"WITH {BARS} SELECT {BAR_COLUMNS}, {STAMP} FROM stg_daily_bars",
    "stg_ticker_overview": f"""WITH {OVERVIEW}
SELECT ticker, name, market, primary_exchange, type, active, currency_name, sic_code,
       sic_description, market_cap, share_class_shares_outstanding, weighted_shares_outstanding,
       total_employees, CAST(list_date AS VARCHAR) AS list_date,
       CAST(snapshot_date AS VARCHAR) AS snapshot_date, {STAMP}
FROM stg_ticker_overview""",
    "stg_splits": f"""WITH {SPLITS}
SELECT {SPLIT_COLUMNS},
       strftime(to_timestamp(version) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS _ingested_at,
       _source_file
FROM stg_splits""",
    "stg_dividends": f"""WITH {DIVIDENDS}
SELECT {DIVIDEND_COLUMNS},
       strftime(to_timestamp(version) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS _ingested_at,
       _source_file
FROM stg_dividends""",
    "stg_news_articles_repeated": """
SELECT CAST(o_custkey AS VARCHAR) AS article_id, 'Order ' || o_orderkey AS title,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS published_utc,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS publisher_name
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "stg_news_articles": f"""WITH {ARTICLES}
SELECT article_id, title, description, article_url,
       strftime(published_utc, '%Y-%m-%d %H:%M:%S') AS published_utc, publisher_name,
       publisher_homepage_url, publisher_logo_url, publisher_favicon_url, {STAMP}
FROM stg_news_articles""",
    "stg_news_sentiment": f"""WITH {SENTIMENT}
SELECT article_id, ticker, sentiment, sentiment_reasoning, {STAMP} FROM stg_news_sentiment""",
    "current_state": f"""WITH {OVERVIEW}
SELECT ticker, name, primary_exchange, sic_code, type, active, currency_name
FROM stg_ticker_overview
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) = 1""",
    "scd2_merge": f"""WITH {OVERVIEW},
early AS (SELECT * FROM stg_ticker_overview WHERE snapshot_date < DATE '1998-01-01'),
{history("early", "state")},
cur AS (
  SELECT * FROM stg_ticker_overview
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) = 1),
opened AS (SELECT * FROM state WHERE valid_to IS NULL),
changed AS (
  SELECT o.ticker FROM opened o JOIN cur c ON o.ticker = c.ticker
  WHERE (o.name, o.primary_exchange, o.sic_code, o.type, o.active, o.currency_name)
        IS DISTINCT FROM
        (c.name, c.primary_exchange, c.sic_code, c.type, c.active, c.currency_name)),
merged AS (
  SELECT * FROM state WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT * REPLACE (CASE WHEN ticker IN (SELECT ticker FROM changed)
                         THEN DATE '2002-01-01' END AS valid_to)
  FROM opened
  UNION ALL
  SELECT ticker, name, primary_exchange, sic_code, type, active, currency_name,
         DATE '2002-01-01', NULL
  FROM cur
  WHERE ticker IN (SELECT ticker FROM changed)
     OR ticker NOT IN (SELECT ticker FROM opened))
SELECT {VERSION_COLUMNS} FROM merged""",
    "scd2_history": f"WITH {OVERVIEW}, {history('stg_ticker_overview')} SELECT {VERSION_COLUMNS} FROM history",
    "dim_ticker": f"""WITH {OVERVIEW}, {history("stg_ticker_overview")}
SELECT {VERSION_COLUMNS}, valid_to IS NULL AS is_current FROM history""",
    "current_lookup": f"""WITH {OVERVIEW}, {history("stg_ticker_overview")}, {FACTS}
SELECT {ASOF_COLUMNS}
FROM facts f JOIN history h ON f.ticker = h.ticker AND h.valid_to IS NULL""",
    "asof_join": asof("<"),
    "asof_join_closed": asof("<="),
    "asof_join_left": asof(
        "<",
        "LEFT JOIN",
        "late",
        ", late AS (SELECT * FROM stg_ticker_overview WHERE snapshot_date >= DATE '1998-01-01')",
    ),
    "dim_date": """
WITH days AS (
  SELECT CAST(unnest(range(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) + 30,
                           INTERVAL 1 DAY)) AS DATE) AS d
  FROM lineitem)
SELECT CAST(d AS VARCHAR) AS date_day, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
       dayname(d) AS day_name, CAST(month(d) AS BIGINT) AS month,
       CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year,
       dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_trading_day
FROM days""",
    "dim_publisher": f"""WITH {ARTICLES}
SELECT publisher_name, publisher_homepage_url, publisher_logo_url, publisher_favicon_url
FROM stg_news_articles WHERE publisher_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY publisher_name
                           ORDER BY published_utc DESC, article_id) = 1""",
    "dim_industry": """
SELECT p_type AS sic_code, p_brand AS sic_description FROM part WHERE p_type IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY p_type
                           ORDER BY p_size DESC, p_partkey % 3 DESC, p_partkey) = 1""",
    "fct_daily_bars": f"WITH {BARS} SELECT {BAR_COLUMNS} FROM stg_daily_bars",
    "fct_ticker_daily_metrics": f"""WITH {OVERVIEW}
SELECT ticker, CAST(snapshot_date AS VARCHAR) AS snapshot_date, market_cap,
       share_class_shares_outstanding, weighted_shares_outstanding
FROM stg_ticker_overview""",
    "fct_splits": f"WITH {SPLITS} SELECT {SPLIT_COLUMNS} FROM stg_splits",
    "fct_dividends": f"WITH {DIVIDENDS} SELECT {DIVIDEND_COLUMNS} FROM stg_dividends",
    "fct_news_sentiment": f"""WITH {ARTICLES}, {SENTIMENT}, {NEWS}
SELECT * REPLACE (strftime(published_utc, '%Y-%m-%d %H:%M:%S') AS published_utc,
                  CAST(published_date AS VARCHAR) AS published_date)
FROM fct_news_sentiment""",
    "fct_daily_returns": f"""WITH {BARS}, {RETURNS}
SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, close_price, prev_close_price,
       round(r, 6) AS daily_return,
       CASE WHEN r IS NOT NULL THEN abs(r) >= 0.03 END AS is_significant_move
FROM with_return""",
    "fct_moving_averages": f"""WITH {BARS}, {AVERAGES}
SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, close_price,
       round(ma5, 8) AS moving_avg_5d, round(ma20, 8) AS moving_avg_20d,
       round(ma50, 8) AS moving_avg_50d, round(vol20, 4) AS volatility_20d, {TREND} AS trend
FROM with_averages""",
    "fct_volume_anomalies": f"""WITH {BARS}, {VOLUMES}
SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, volume, round(base, 8) AS avg_volume_20d,
       CASE WHEN base IS NOT NULL AND base <> 0 THEN round(volume / base, 6) END AS volume_ratio,
       CASE WHEN base IS NOT NULL AND base <> 0 THEN volume >= 2 * base END AS is_volume_spike
FROM with_volume""",
    "bar_metrics": f"""WITH {BARS}, {RETURNS}, {AVERAGES}, {VOLUMES}
SELECT r.ticker, CAST(r.trade_date AS VARCHAR) AS trade_date, r.close_price, r.volume,
       prev_close_price, round(r, 6) AS daily_return,
       CASE WHEN r IS NOT NULL THEN abs(r) >= 0.03 END AS is_significant_move,
       round(ma5, 8) AS moving_avg_5d, round(ma20, 8) AS moving_avg_20d,
       round(ma50, 8) AS moving_avg_50d, round(vol20, 4) AS volatility_20d, {TREND} AS trend,
       round(base, 8) AS avg_volume_20d,
       CASE WHEN base IS NOT NULL AND base <> 0 THEN round(r.volume / base, 6) END AS volume_ratio,
       CASE WHEN base IS NOT NULL AND base <> 0 THEN r.volume >= 2 * base END AS is_volume_spike
FROM with_return r
JOIN with_averages a ON r.ticker = a.ticker AND r.trade_date = a.trade_date
JOIN with_volume v ON r.ticker = v.ticker AND r.trade_date = v.trade_date""",
    "dq_not_null": f"""WITH {OVERVIEW}
SELECT ticker, CAST(snapshot_date AS VARCHAR) AS snapshot_date, type
FROM stg_ticker_overview WHERE list_date IS NULL""",
    "dq_unique": """
SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey HAVING count(*) > 1""",
    "dq_unique_combo": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_scd2_single_current": f"""WITH {OVERVIEW}, {history("stg_ticker_overview")}
SELECT ticker, count(*) AS current_version_count FROM history
WHERE valid_from >= DATE '2001-01-01' GROUP BY ticker HAVING count(*) > 1""",
    "dq_freshness": f"""
WITH loaded AS ({
        " UNION ALL ".join(
            [
                latest("daily_bars", "to_timestamp(l_orderkey) AT TIME ZONE 'UTC'", "lineitem"),
                latest("ticker_overview", "o_orderdate", "orders"),
                latest("splits", "to_timestamp(o_orderkey * 3) AT TIME ZONE 'UTC'", "orders"),
                latest("dividends", "to_timestamp(o_orderkey * 5) AT TIME ZONE 'UTC'", "orders"),
                latest("news_articles", "to_timestamp(o_orderkey) AT TIME ZONE 'UTC'", "orders"),
                latest("news_sentiment", "to_timestamp(l_linenumber) AT TIME ZONE 'UTC'", "lineitem"),
            ]
        )
    })
SELECT table_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS last_loaded_at,
       CASE WHEN t IS NULL OR t < TIMESTAMP '2001-09-01' - INTERVAL 87600 HOUR THEN 'error'
            WHEN t < TIMESTAMP '2001-09-01' - INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status
FROM loaded""",
    "dq_report": report(
        [
            BARS,
            OVERVIEW,
            SPLITS,
            DIVIDENDS,
            ARTICLES,
            SENTIMENT,
            NEWS,
            history("stg_ticker_overview"),
            RETURNS,
            AVERAGES,
            VOLUMES,
            GOLD_VIEWS,
        ],
        SILVER_TESTS + GOLD_TESTS,
    ),
    "dq_report_raw": report(
        [
            BARS.replace("stg_daily_bars", "clean_bars"),
            OVERVIEW.replace("stg_ticker_overview", "clean_overview"),
            SPLITS.replace("stg_splits", "clean_splits"),
            DIVIDENDS.replace("stg_dividends", "clean_dividends"),
            ARTICLES,
            SENTIMENT.replace("stg_news_sentiment", "clean_sentiment"),
            "stg_daily_bars AS (SELECT * FROM bronze_bars)",
            "stg_ticker_overview AS (SELECT * FROM bronze_overview)",
            "stg_splits AS (SELECT * FROM bronze_splits)",
            "stg_dividends AS (SELECT * FROM bronze_dividends)",
            "stg_news_sentiment AS (SELECT * FROM bronze_sentiment)",
        ],
        SILVER_TESTS,
    ),
    "cast_rejects": """
SELECT unnest(['active', 'market_cap', 'share_class_shares_outstanding',
               'weighted_shares_outstanding', 'total_employees', 'list_date']) AS column_name,
       unnest([0, 0, 0, 0, 0, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')]) AS rejected""",
    "promote_and_load": """
SELECT 'daily_bars' AS table_name, count(*) AS loaded, CAST(0 AS BIGINT) AS set_aside, CAST(0 AS BIGINT) AS loaded_again,
       CAST(0 AS BIGINT) AS set_aside_again, count(*) AS reloaded FROM lineitem
UNION ALL SELECT 'ticker_overview', count(*) FILTER (c_mktsegment <> 'MACHINERY'),
       count(*) FILTER (c_mktsegment = 'MACHINERY'), 0, 0, count(*) FILTER (c_mktsegment <> 'MACHINERY') FROM customer
UNION ALL SELECT t, count(*), 0, 0, 0, count(*)
FROM orders, (SELECT unnest(['splits', 'dividends', 'news_articles', 'news_sentiment']) AS t) GROUP BY t""",
    "promote_new_files": """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       'events/date=' || CAST(ts AS DATE) || '/' || user_id || '.jsonl' AS relative_path
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-16'""",
    "relative_path": """
SELECT event_id, p AS scheme_path, p AS scheme_root, p AS other_scheme, CAST(NULL AS VARCHAR) AS wrong_root
FROM (SELECT event_id, 'events/date=' || CAST(ts AS DATE) || '/' || user_id || '.jsonl' AS p
      FROM events)""",
}
ORACLES["indexed_append"] = """
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01'"""
ORACLES["event_history_hot"] = """
SELECT event_type, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month, CAST(event_id AS VARCHAR) AS event_id,
       row_number() OVER (PARTITION BY event_type
                          ORDER BY date_trunc('month', ts) DESC, CAST(event_id AS VARCHAR)) AS event_seq
FROM events"""
ORACLES["schema_drift"] = """
WITH o AS (
  SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderstatus = 'F') AS f,
         count(*) FILTER (o_orderstatus NOT IN ('P', 'F')) AS r FROM orders),
kinds AS (
  SELECT 'id' AS path, 'bigint' AS declared, 'BIGINT' AS landed, n AS n_values, 0 AS n_lost FROM o
  UNION ALL SELECT 'price', 'double', 'BIGINT', n - p, 0 FROM o
  UNION ALL SELECT 'price', 'double', 'STRING', p, p FROM o
  UNION ALL SELECT 'clerk', NULL, 'STRING', n, 0 FROM o
  UNION ALL SELECT 'publisher', 'struct<name:string,rank:bigint>', 'OBJECT', n, 0 FROM o
  UNION ALL SELECT 'publisher.name', 'string', 'STRING', n, 0 FROM o
  UNION ALL SELECT 'publisher.rank', 'bigint', 'BIGINT', n - f, 0 FROM o
  UNION ALL SELECT 'publisher.rank', 'bigint', 'STRING', f, f FROM o
  UNION ALL SELECT 'publisher.verified', NULL, 'BOOLEAN', n, 0 FROM o
  UNION ALL SELECT 'insights', 'array<struct<ticker:string,score:double>>', 'ARRAY', n - f, 0 FROM o
  UNION ALL SELECT 'insights', 'array<struct<ticker:string,score:double>>', 'OBJECT', f, f FROM o
  UNION ALL SELECT 'insights[]', 'struct<ticker:string,score:double>', 'OBJECT', 2 * p + r, 0 FROM o
  UNION ALL SELECT 'insights[].ticker', 'string', 'STRING', 2 * p + r, 0 FROM o
  UNION ALL SELECT 'insights[].score', 'double', 'BIGINT', 2 * p, 0 FROM o
  UNION ALL SELECT 'insights[].score', 'double', 'STRING', r, r FROM o)
SELECT path, declared, landed, n_values, CAST(n_lost AS BIGINT) AS n_lost,
       CASE WHEN n_lost > 0 THEN 'lost' WHEN declared IS NULL THEN 'unknown' ELSE 'ok' END AS status
FROM kinds WHERE n_values > 0"""
# Tables that are kept up to date must equal those that are built anew.
ORACLES["silver_upsert"] = ORACLES["stg_daily_bars"]
ORACLES["facts_halo"] = ORACLES["bar_metrics"]
ORACLES["scd2_late_snapshots"] = ORACLES["scd2_history"]
ORACLES["freshness_footers"] = ORACLES["dq_freshness"]
ORACLES["dim_date_footers"] = ORACLES["dim_date"]
ORACLES["asof_join_footers"] = ORACLES["asof_join"]
ORACLES["dq_kept_counts"] = """
WITH kept AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_linenumber = 7 THEN 1 ELSE l_suppkey END AS l_suppkey,
         CASE WHEN l_linenumber = 7 THEN DATE '1999-01-01'
              WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS l_shipdate
  FROM lineitem WHERE NOT coalesce(l_linestatus = 'F' AND l_quantity < 10, FALSE)),
tests AS (
  SELECT 'not_null_lines_l_shipdate' AS test_name, count(*) AS violations FROM kept WHERE l_shipdate IS NULL
  UNION ALL
  SELECT 'unique_lines_l_orderkey', count(*) FROM (
    SELECT l_orderkey FROM kept WHERE l_orderkey IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
  UNION ALL
  SELECT 'unique_combination_lines_l_partkey_l_suppkey_l_shipdate', count(*) FROM (
    SELECT l_partkey, l_suppkey, l_shipdate FROM kept GROUP BY ALL HAVING count(*) > 1))
SELECT test_name, 'lines' AS model, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status
FROM tests"""
