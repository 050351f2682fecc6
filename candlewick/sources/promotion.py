"""Promotion: bring the landing files of one environment into another, each file once."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import relative_path
from candlewick.operators.joins import spread_join
from candlewick.sources.landing import line_writer, source_path
from candlewick.sources.registry import SOURCES
from candlewick.sources.tables import append_table, table_or_none


def promoted_lines(lines: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Lines, or files, whose ``relative_path`` the ledger does not list."""
    if ledger is None:
        return lines
    return spread_join(lines, ledger, ["relative_path"], "left_anti")


# Fixed value: the ASCII characters a path keeps unescaped in a URI, besides letters and digits.
_URI_PATH = "/:@&=+$,;_-!.~'()*"


def _escaped(root: str) -> str:
    """``root`` as it appears in ``_metadata.file_path``, which is a URI (a blank is ``%20``)."""
    return "".join(quote(c, safe=_URI_PATH) if c.isascii() else c for c in root)


def _landed(spark: SparkSession, root: str, source: str) -> DataFrame:
    return spark.read.schema("value string").text(source_path(root, source)).select(
        "value",
        F.col("date").cast("date").alias("date"),
        relative_path(F.col("_metadata.file_path"), _escaped(root)).alias("relative_path"),
    )


def _listed(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The files of a source by path, day and size. Without its content column a binary file is listed, not opened."""
    return spark.read.format("binaryFile").load(source_path(root, source)).select(
        relative_path(F.col("_metadata.file_path"), _escaped(root)).alias("relative_path"),
        F.col("date").cast("date").alias("date"),
        "length",
    )


#: Bytes of a file, compressed or plain, from which on it is not worth a shuffle to gather it with others of its day.
LARGE_FILE = {True: 1 << 20, False: 16 << 20}


def _are_large(files: DataFrame, compressed: bool) -> bool:
    """Whether the files of every day are large on average; one row comes to the driver."""
    least = files.groupBy("date").agg(F.avg("length").alias("size")).agg(F.min("size")).first()[0]
    return least is not None and least >= LARGE_FILE[compressed]


def _hadoop_path(spark: SparkSession, path: str):
    """A path of the file system that Spark uses; ``path`` as Spark's listings give it, a URI."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, manifest: str) -> None:
    """Move the staged files of a manifest to their places. A file that is there already was moved before."""
    for row in spark.table(manifest).collect():  # one row per file written, each of the size AQE aims at
        staged, files = _hadoop_path(spark, row.staged)
        target, _ = _hadoop_path(spark, row.target)
        if files.exists(staged):
            files.mkdirs(target.getParent())
            files.delete(target, False)  # left by a move that copied and stopped before it deleted
            if not files.rename(staged, target):
                raise OSError(f"cannot move {row.staged} to {row.target}")


def finish_promotion(spark: SparkSession, ledger_table: str) -> None:
    """Replay what a stopped promotion has decided: publish its files, and enter in the ledger what is not there yet."""
    manifest, pending = f"{ledger_table}__manifest", f"{ledger_table}__pending"
    if not spark.catalog.tableExists(manifest):
        return
    _publish(spark, manifest)
    chosen = spark.table(pending)
    known = table_or_none(spark, ledger_table)
    if known is not None:
        both = ["source", "relative_path"]
        chosen = spread_join(chosen, known.select(*both).distinct(), both, "left_anti")
    append_table(chosen, ledger_table)
    spark.sql(f"DROP TABLE IF EXISTS {manifest}")


def promote(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    ledger_table: str,
    sources: Iterable[str] = tuple(SOURCES),
    *,
    since: str | None = None,
    compression: str | None = None,
) -> None:
    """Copy the files not promoted yet, source by source, and enter them in the ledger; each line once, wherever a run stops.

    Lines keep their ``date=`` folder; the ledger keeps the original file names. The new files are
    found first, from a listing that opens none, and fixed in ``<ledger>__pending``. Only the folders
    they lie in are then read, and the first promotion of a source copies without any join. The copies of
    a day of small files are gathered before they are written, in files of the size AQE aims at; large files are copied
    by the tasks that read them. Both go below ``_promotion`` in the target,
    where no reader looks. ``<ledger>__manifest`` lists them with the places they go to. It is the decision: a run that
    stops before it is written has changed nothing, and what comes after (moving the files, the ledger) is replayed by
    the next run, which finds what is done already.
    ``since`` leaves older ``date=`` folders out altogether; ``compression`` is that of the copies.
    """
    finish_promotion(spark, ledger_table)
    for source in sources:
        lines, listed = _landed(spark, src_root, source), _listed(spark, src_root, source)
        if since:
            lines, listed = (df.filter(F.col("date") >= F.lit(since).cast("date")) for df in (lines, listed))
        known = table_or_none(spark, ledger_table)
        if known is not None:
            known = known.filter(F.col("source") == source).select("relative_path")
            known = None if known.isEmpty() else known
        files = promoted_lines(listed, known)
        pending = f"{ledger_table}__pending"
        files.drop("length").withColumn("source", F.lit(source)).write.format("parquet").mode(
            "overwrite"
        ).saveAsTable(pending)
        chosen = spark.table(pending)
        if not chosen.filter(F.col("relative_path").isNull()).isEmpty():
            raise ValueError(f"{src_root}: the files found there are not below that path")
        if known is not None:
            # one row per landing folder with something new
            days = [r.date for r in chosen.select("date").distinct().collect()]
            if not days:
                continue
            lines = spread_join(
                lines.filter(F.col("date").isin(*days)),
                chosen.select("relative_path"),
                ["relative_path"],
                "left_semi",
            )
        stage = source_path(f"{dst_root.rstrip('/')}/_promotion", source)
        copies = lines.select("value", "date")
        if not _are_large(files, compression is not None):
            copies = copies.hint("rebalance", "date")
        line_writer(copies, compression).mode("overwrite").text(stage)
        _list_staged(spark, stage, source, f"{ledger_table}__manifest")
        finish_promotion(spark, ledger_table)


def _list_staged(spark: SparkSession, stage: str, source: str, manifest: str) -> None:
    """Write the manifest: the staged files, found by a listing, and where they go."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage)
    listing = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(place, True)
    rows = []
    while listing.hasNext():
        path = listing.next().getPath()
        if not path.getName().startswith(("_", ".")):
            staged = path.toUri().toString()
            root, _, below = staged.rpartition(f"/_promotion/{source}/")
            rows.append((staged, f"{root}/{source}/{below}"))
    listed = spark.createDataFrame(rows, "staged string, target string").coalesce(1)
    listed.write.format("parquet").mode("overwrite").saveAsTable(manifest)
