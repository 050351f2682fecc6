"""Landing: append-only NDJSON, one envelope per line, under ``<root>/<source>/date=<day>/``."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.registry import SOURCES, Source


def envelope_lines(
    records: DataFrame, record: Column, ticker: Column, endpoint: Column, ingested_at: datetime
) -> DataFrame:
    """One JSON line per row: the record, the batch's ingest time and the request it answers.

    ``ingested_at`` is one value for the whole batch, written as ISO 8601 with its offset.
    """
    if ingested_at.tzinfo is None:
        raise ValueError("ingested_at needs a time zone")
    envelope = F.struct(
        record.alias("record"),
        F.lit(ingested_at.isoformat()).alias("_ingested_at"),
        F.struct(endpoint.alias("endpoint"), ticker.alias("ticker")).alias("_request_metadata"),
    )
    return records.select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def source_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


#: Lines of a compressed file, which one task has to read whole.
LINES_PER_FILE = 200_000


def line_writer(lines: DataFrame, compression: str | None) -> DataFrameWriter:
    """The writer of landing files by day: plain, or compressed and of ``LINES_PER_FILE`` lines at most. Readers tell
    by the file name. Gzip at its fastest takes a quarter of the time for a quarter more room."""
    writer = lines.write.partitionBy("date")
    if compression is None:
        return writer
    writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    return writer.option("maxRecordsPerFile", LINES_PER_FILE)


def land(
    records: DataFrame,
    source: str | Source,
    root: str,
    *,
    ticker: Column,
    record: Column,
    endpoint: Column | None = None,
    ingested_at: datetime | None = None,
    run_date: date | None = None,
    compression: str | None = None,
) -> str:
    """Append the records as new files of the run date (default: today, UTC) and return the folder.

    A batch without records leaves a file with one blank line, as evidence that the request was made.
    """
    spec = SOURCES[source] if isinstance(source, str) else source
    now = datetime.now(UTC)
    day = run_date or now.date()
    lines = envelope_lines(
        records,
        record,
        ticker,
        F.lit(spec.endpoint) if endpoint is None else endpoint,
        ingested_at or now,
    )
    path = source_path(root, spec.name)

    def append(content: DataFrame) -> None:
        line_writer(content.withColumn("date", F.lit(day)), compression).mode("append").text(path)

    written = Observation()
    append(lines.observe(written, F.count(F.lit(1)).alias("rows")))
    if not written.get.get("rows", 0):
        append(records.sparkSession.range(1).select(F.lit("").alias("value")))
    return f"{path}/date={day.isoformat()}"


def read_landing(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The envelopes of a source with a fixed schema: no inference pass, and blank files are fine.

    A line that is not valid JSON comes back with ``_corrupt_record`` set and NULL fields.
    ``date`` is the landing day, from the folder name; filters on it prune folders.
    """
    spec = SOURCES[source]
    return spark.read.schema(spec.envelope).json(source_path(root, source))


def read_landing_stream(
    spark: SparkSession, root: str, source: str, *, max_files_per_batch: int | None = None
) -> DataFrame:
    """The same as a stream: a checkpointed query reads every file once."""
    reader = spark.readStream.schema(SOURCES[source].envelope)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(source_path(root, source))
