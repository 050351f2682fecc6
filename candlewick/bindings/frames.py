"""Generic test tables under the names and types of the market-data layers.

line items stand for price bars (supplier = ticker) and for sentiment; orders for company snapshots
(customer = ticker), splits, dividends and articles; events for landed records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INGESTED = "2024-02-01T06:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def padded(column: str, width: int = 12) -> Column:
    return F.lpad(text(column), width, "0")


def bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    low = price * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        low.alias("open_price"),
        price.alias("high_price"),
        low.alias("low_price"),
        price.alias("close_price"),
        F.col("l_quantity").alias("volume"),
        (price / F.col("l_quantity")).alias("vwap"),
        F.col("l_linenumber").cast("long").alias("transaction_count"),
        F.timestamp_seconds("l_orderkey").alias("_ingested_at"),
        text("l_partkey").alias("_source_file"),
    )


def bronze_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invalid list date ('') stands on the pending orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ticker"),
        F.concat(F.lit("Company "), text("o_custkey")).alias("name"),
        F.lit("stocks").alias("market"),
        F.col("o_orderpriority").alias("primary_exchange"),
        F.col("o_orderstatus").alias("type"),
        F.when(F.col("o_orderstatus") == "F", "false").otherwise("true").alias("active"),
        F.lit("usd").alias("currency_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.substring("o_orderpriority", 1, 1)).alias(
            "sic_code"
        ),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("sic_description"),
        F.col("o_totalprice").alias("market_cap"),
        F.col("o_totalprice").alias("share_class_shares_outstanding"),
        (F.col("o_totalprice") * 2).alias("weighted_shares_outstanding"),
        F.col("o_orderkey").alias("total_employees"),
        F.when(F.col("o_orderstatus") == "P", "")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("list_date"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        padded("o_orderkey").alias("_source_file"),
    )


def _event_id() -> Column:
    """One id per customer and month, so that ids repeat."""
    return F.concat_ws("-", "o_custkey", F.date_format("o_orderdate", "yyyyMM"))


def bronze_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _event_id().alias("split_id"),
        F.col("o_custkey").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("execution_date"),
        F.lit(1).alias("split_from"),
        F.pmod("o_orderkey", F.lit(7)).alias("split_to"),
        F.col("o_orderpriority").alias("adjustment_type"),
        (F.col("o_totalprice") / 4).alias("historical_adjustment_factor"),
        F.timestamp_seconds(F.col("o_orderkey") * 3).alias("_ingested_at"),
        padded("o_orderkey").alias("_source_file"),
    )


def bronze_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        _event_id().alias("dividend_id"),
        F.col("o_custkey").alias("ticker"),
        day.alias("ex_dividend_date"),
        F.date_sub(day, 30).alias("declaration_date"),
        F.date_add(day, 1).alias("record_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(day, 14)).alias("pay_date"),
        F.col("o_totalprice").alias("cash_amount"),
        F.lit("USD").alias("currency"),
        F.lit(4).cast("long").alias("frequency"),
        F.col("o_orderpriority").alias("distribution_type"),
        F.lit(1.0).alias("historical_adjustment_factor"),
        F.timestamp_seconds(F.col("o_orderkey") * 5).alias("_ingested_at"),
        padded("o_orderkey").alias("_source_file"),
    )


def bronze_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as articles; the priority names the publisher, none on pending orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("article_id"),
        F.concat(F.lit("Order "), text("o_orderkey")).alias("title"),
        F.col("o_orderstatus").alias("description"),
        F.concat(F.lit("https://example.org/"), text("o_orderkey")).alias("article_url"),
        F.col("o_orderdate").cast("timestamp").alias("published_utc"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("publisher_name"),
        F.concat(F.lit("https://example.org/p/"), text("o_custkey")).alias("publisher_homepage_url"),
        F.concat(text("o_custkey"), F.lit(".png")).alias("publisher_logo_url"),
        F.concat(text("o_custkey"), F.lit(".ico")).alias("publisher_favicon_url"),
        F.timestamp_seconds("o_orderkey").alias("_ingested_at"),
        padded("o_custkey").alias("_source_file"),
    )


def bronze_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("article_id"),
        F.col("l_partkey").alias("ticker"),
        F.col("l_returnflag").alias("sentiment"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("sentiment_reasoning"),
        F.timestamp_seconds(F.col("l_linenumber").cast("long")).alias("_ingested_at"),
        padded("l_suppkey").alias("_source_file"),
    )


def _envelope(record: Column, ticker: Column, ingested: Column, file: Column) -> list[Column]:
    return [
        record.alias("record"),
        ingested.alias("_ingested_at"),
        F.struct(F.lit("/feed").alias("endpoint"), ticker.alias("ticker")).alias(
            "_request_metadata"
        ),
        file.alias("_source_file"),
    ]


def news_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per line item, with its mentions in the row: none (NULL) for returns, an empty list
    for the other filled ones, else the part and the supplier."""
    mention = F.array(
        F.struct(
            F.concat(F.lit("P"), text("l_partkey")).alias("ticker"),
            F.col("l_returnflag").alias("sentiment"),
            F.concat_ws("/", "l_linenumber", "l_suppkey").alias("sentiment_reasoning"),
        ),
        F.struct(
            F.concat(F.lit("S"), text("l_suppkey")).alias("ticker"),
            F.col("l_linestatus").alias("sentiment"),
            F.concat_ws("/", "l_linenumber", "l_partkey").alias("sentiment_reasoning"),
        ),
    )
    insights = F.when(
        F.col("l_returnflag") != "R",
        F.when(F.col("l_linestatus") == "F", F.slice(mention, 1, 0)).otherwise(mention),
    )
    record = F.struct(text("l_orderkey").alias("id"), insights.alias("insights"))
    ingested = F.date_format(F.timestamp_seconds(F.col("l_linenumber").cast("long")), _ISO)
    return table(spark, sf_dir, "lineitem").select(
        *_envelope(record, text("l_suppkey"), ingested, padded("l_partkey"))
    )


_ISO = "yyyy-MM-dd'T'HH:mm:ssXXX"


def dividend_records() -> Column:
    day = F.col("o_orderdate").cast("date")
    return F.struct(
        text("o_orderkey").alias("id"),
        text("o_custkey").alias("ticker"),
        day.cast("string").alias("ex_dividend_date"),
        F.date_sub(day, 30).cast("string").alias("declaration_date"),
        F.when(F.col("o_orderstatus") == "P", "")
        .otherwise(F.date_add(day, 1).cast("string"))
        .alias("record_date"),
        F.date_add(day, 14).cast("string").alias("pay_date"),
        F.col("o_totalprice").alias("cash_amount"),
        F.lit("USD").alias("currency"),
        F.lit(4).alias("frequency"),
        F.col("o_orderpriority").alias("distribution_type"),
    )


def bar_records(day: str = "l_shipdate") -> Column:
    """A bar as the vendor sends it: midnight UTC in epoch milliseconds and one-letter fields."""
    ms = F.unix_date(F.col(day).cast("date")).cast("long") * 86_400_000
    price = F.col("l_extendedprice")
    return F.struct(
        ms.alias("t"),
        price.alias("o"),
        price.alias("h"),
        price.alias("l"),
        price.alias("c"),
        F.col("l_quantity").alias("v"),
        price.alias("vw"),
        F.col("l_linenumber").cast("long").alias("n"),
    )


def article_records() -> Column:
    publisher = F.struct(
        F.col("o_orderpriority").alias("name"),
        F.lit("https://example.org").alias("homepage_url"),
        F.lit("logo.png").alias("logo_url"),
        F.lit("icon.ico").alias("favicon_url"),
    )
    mention = F.struct(
        text("o_custkey").alias("ticker"),
        F.col("o_orderstatus").alias("sentiment"),
        F.lit("stated").alias("sentiment_reasoning"),
    )
    return F.struct(
        text("o_orderkey").alias("id"),
        F.concat(F.lit("Order "), text("o_orderkey")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_utc"),
        publisher.alias("publisher"),
        F.array(mention).alias("insights"),
    )


def overview_records() -> Column:
    return F.struct(
        text("c_custkey").alias("ticker"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("type"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.col("c_acctbal").alias("market_cap"),
        F.col("c_nationkey").cast("long").alias("total_employees"),
    )
