"""A third of all rows on one key: results stay whole and no task gets the key's rows at once."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from candlewick import operators as op
from candlewick.plans import gold, silver

ROWS = 120_000


def hot(other: int):
    """Key 7 on every third row, else one of ``other`` keys."""
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(other)))


def exchanged_rows(df) -> dict[str, int]:
    """Rows written by each shuffle of the executed plan, by its partitioning."""
    df._jdf.queryExecution().toRdd().count()
    found = {}

    def walk(node):
        if node.nodeName() == "Exchange":
            label = node.simpleString(10_000).split("hashpartitioning(")[-1].split(")")[0]
            found[label] = node.metrics().apply("shuffleRecordsWritten").value()
        for name in ("plan", "inputPlan"):
            if node.getClass().getSimpleName().endswith("QueryStageExec") and name == "plan":
                walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def test_dedup_of_a_hot_key_sends_one_row_per_task(spark):
    """All hot rows are versions of one bar."""
    rows = spark.range(0, ROWS, 1, 8).select(
        hot(1_000_000).alias("ticker"), F.lit(date(2024, 1, 1)).alias("trade_date"), "id"
    )
    latest = op.dedup_latest(rows, ["ticker", "trade_date"], [F.col("id").desc()])
    shuffled = exchanged_rows(latest)
    # every task sends its cold rows and one row of the hot key
    cold = rows.filter("ticker != 7").count()
    assert len(shuffled) == 1
    assert next(iter(shuffled.values())) <= cold + 8 < ROWS * 0.7
    row = latest.filter("ticker = 7").collect()
    assert [r.id for r in row] == [ROWS - 3]


def test_known_hot_keys_are_made_unique_before_the_shuffle(spark, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    stored = spark.range(0, ROWS, 1, 8).select(hot(50).alias("k"))
    batch = spark.range(0, 1000, 1, 2).select(F.col("id").alias("k"))
    fresh = op.exclude_existing(batch, stored, ["k"])
    assert sorted(r.k for r in fresh.collect()) == list(range(50, 1000))
    assert all(n <= 1000 for n in exchanged_rows(fresh).values())


def test_asof_join_cuts_a_hot_ticker_by_time(spark, setting):
    """Neither side brings a hot ticker to the join as one group."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    fact = spark.range(0, ROWS, 1, 8).select(
        hot(500).alias("ticker"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 1500).cast("int")).alias("d")
    )
    dim = spark.range(500).select(F.col("id").alias("ticker")).select(
        "ticker", F.explode(F.sequence(F.lit(0), F.lit(1400), F.lit(100))).alias("n")
    ).select(
        "ticker",
        F.date_add(F.lit(date(2020, 1, 1)), "n").alias("valid_from"),
        F.when(F.col("n") < 1400, F.date_add(F.lit(date(2020, 1, 1)), F.col("n") + 100)).alias("valid_to"),
    )
    joined = op.asof_join(fact, dim, "ticker", "d")
    assert joined.count() == ROWS
    keys = [k for k in exchanged_rows(joined) if "ticker" in k]
    assert keys and all("bucket" in k for k in keys)
    assert joined.filter("d < valid_from OR d >= valid_to").isEmpty()


def test_quality_counts_are_aggregated_before_the_shuffle(spark):
    rows = spark.range(0, ROWS, 1, 8).select(hot(50).alias("k"))
    checks = [op.Check("m", "not_null", ("k",)), op.Check("m", "unique", ("k",))]
    result = op.report({"m": rows}, checks)
    assert {r.test_name: r.violations for r in result.collect()} == {"not_null_m_k": 0, "unique_m_k": 50}
    assert all(n <= 8 * 60 for n in exchanged_rows(result).values())


def test_event_sequence_of_a_hot_key_on_one_date(spark):
    rows = spark.range(0, ROWS, 1, 8).select(
        hot(1000).alias("k"), F.lit(date(2024, 1, 1)).alias("d"), F.col("id").alias("e")
    )
    numbered = op.event_sequence(rows, "k", "d", "e", id_block=F.floor(F.col("e") / 5000))
    of_hot = numbered.filter("k = 7").orderBy("e").select("event_seq", "e").collect()
    assert [r.event_seq for r in of_hot] == list(range(1, len(of_hot) + 1))
    assert len(of_hot) == rows.filter("k = 7").count() and numbered.count() == ROWS


def test_news_fact_with_a_hot_article_is_whole(spark, setting):
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__shuffle__partitions="16",
    )
    sentiment = spark.range(0, ROWS, 1, 8).select(
        hot(20_000).alias("article_id"),
        F.col("id").alias("ticker"),
        F.lit("neutral").alias("sentiment"),
        F.sha2(F.col("id").cast("string"), 256).alias("sentiment_reasoning"),
        F.timestamp_seconds("id").alias("_ingested_at"),
        F.lit("f").alias("_source_file"),
    )
    names = silver.STAGING["stg_news_articles"].columns
    articles = spark.range(20_000).select(
        F.col("id").alias("article_id"),
        *[
            (F.timestamp_seconds("id") if c == "published_utc" else F.lit("x")).alias(c)
            for c in names
            if c != "article_id"
        ],
        F.timestamp_seconds("id").alias("_ingested_at"),
        F.lit("f").alias("_source_file"),
    )
    fact = gold.fct_news_sentiment(
        silver.stg_news_sentiment(sentiment), silver.stg_news_articles(articles)
    )
    assert fact._jdf.queryExecution().toRdd().count() == ROWS
    final = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
