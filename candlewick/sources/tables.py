"""Catalog tables: append by name, and full replacement that never leaves a half-written table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None before its first write. A table that a stopped replacement has set aside is
    brought back first: taking it for missing would start its history anew. A stopped swap is finished, and so is a
    replacement of several tables that was decided."""
    finish_replace(spark, _decision(name))
    if not spark.catalog.tableExists(name):
        recover_table(spark, name)
    else:
        finish_swap(spark, name)
    return spark.table(name) if spark.catalog.tableExists(name) else None


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _save(writer: DataFrameWriter, name: str, spark: SparkSession, mode: str = "overwrite") -> None:
    """Timestamps as microseconds, whose bounds stand in the file footers; the older 96-bit form has none. Zstandard takes
    less room than Spark's default. The shuffles of the write go with it, not when the driver next collects garbage."""
    micros = setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    with micros, setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        writer.format("parquet").option("compression", "zstd").mode(mode).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name; the first call creates the table.

    A column the table does not know, or one that is missing, is an error: a new column is an
    explicit rebuild (``replace_table`` over ``unionByName(allowMissingColumns=True)``).
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if set(columns) != set(df.columns):
            raise ValueError(f"{name} has {columns}, the batch {df.columns}")
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    _save(df.write, name, spark, "append")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish or undo a replacement that stopped half way. Safe to call at any time.

    The old table is set aside before the new one takes its name. If the name is free and an old
    table is set aside, the old one comes back; otherwise the name is good and leftovers go. A decided
    replacement of several tables is finished first.
    """
    finish_replace(spark, _decision(name))
    staged, old = f"{name}__staged", f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        _rename(spark, old, name)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def replace_table(
    df: DataFrame,
    name: str,
    *,
    validate: Callable[[DataFrame], None] | None = None,
    bucket_by: str | Sequence[str] | None = None,
    buckets: int | None = None,
    sort_by: Sequence[str] = (),
    part_by: str | None = None,
    dealt: bool = False,
) -> None:
    """Write the new content beside the table, check it, then swap names.

    ``df`` may read the table it replaces. If the write or ``validate`` fails, the table is untouched.
    With ``bucket_by`` later joins and windows on these columns read the table without a shuffle; with
    ``part_by`` it has one folder per value of that column, whose rows are gathered before they are written. With both,
    the rows of a bucket are gathered, and each folder has files of the buckets that occur in it. ``dealt`` as for
    :func:`swap_partitions`.
    """
    spark = df.sparkSession
    # A swap of partitions that a stop left open belongs to the content that goes.
    spark.sql(f"DROP TABLE IF EXISTS {name}__swap")
    recover_table(spark, name)
    staged, old = f"{name}__staged", f"{name}__old"
    bucketed = None
    if bucket_by:
        columns = (bucket_by,) if isinstance(bucket_by, str) else tuple(bucket_by)
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        bucketed = Buckets(count, columns, (*columns, *sort_by))
    if part_by:
        _write_parts(df, staged, part_by, dealt, bucketed)
    elif bucketed:
        _save(_in_buckets(df if dealt else bucketed.gathered(df), bucketed), staged, spark)
    else:
        _save(df.write, staged, spark)
    if validate is not None:
        validate(spark.table(staged))
    if spark.catalog.tableExists(name):
        _rename(spark, name, old)
    _rename(spark, staged, name)
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def meeting_in_buckets(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that run within may join tables in their buckets if these are by a part of the key alone, which Spark does
    not do by itself, as a hot bucket could not be split."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


@dataclass(frozen=True)
class Buckets:
    """How a table is bucketed."""

    count: int
    columns: tuple[str, ...]
    sort_by: tuple[str, ...]

    def gathered(self, df: DataFrame) -> DataFrame:
        """One task per bucket."""
        return df.repartition(self.count, *self.columns)


def _in_buckets(df: DataFrame, buckets: Buckets) -> DataFrameWriter:
    return df.write.bucketBy(buckets.count, *buckets.columns).sortBy(*buckets.sort_by)


def buckets_of(spark: SparkSession, name: str) -> Buckets | None:
    """How a stored table is bucketed, or None."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in about:
        return None
    by, sort_by = (tuple(re.findall("`([^`]+)`", about[k])) for k in ("Bucket Columns", "Sort Columns"))
    return Buckets(int(about["Num Buckets"]), by, sort_by or by)


def _write_parts(df: DataFrame, name: str, part_by: str, dealt: bool = False, buckets: Buckets | None = None) -> None:
    """The folders are found by listing: a catalog that keeps their places would keep the old ones over a rename."""
    with setting(df.sparkSession, "spark.sql.hive.manageFilesourcePartitions", "false"):
        if not dealt:
            df = buckets.gathered(df) if buckets else df.hint("rebalance", part_by)
        writer = _in_buckets(df, buckets) if buckets else df.write
        _save(writer.partitionBy(part_by), name, df.sparkSession)


def swap_partitions(
    df: DataFrame,
    name: str,
    part_by: str,
    *,
    validate: Callable[[DataFrame], None] | None = None,
    dealt: bool = False,
) -> None:
    """Replace those partitions of a table that occur in ``df`` by its content; the others keep their files.

    ``df`` may read the table. The new partitions are written beside it, checked, and only then brought in, so a failure
    before that changes nothing; a stop while they are brought in is finished by the next access, from the copy.
    With ``dealt`` the rows lie in tasks as they are to be written, and are not gathered by a shuffle of their own. The new
    partitions are bucketed as the table is.
    """
    spark = df.sparkSession
    finish_swap(spark, name)
    staged, swap = f"{name}__staged", f"{name}__swap"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    _write_parts(df, staged, part_by, dealt, buckets_of(spark, name))
    if validate is not None:
        validate(spark.table(staged))
    _rename(spark, staged, swap)  # from here on the swap counts as decided
    finish_swap(spark, name)


def finish_swap(spark: SparkSession, name: str) -> None:
    """Bring in the partitions of a decided swap, by moving their folders. Doing it again gives the same table: a folder
    that is not in the copy any more has been moved. Only if the columns' types differ is the copy written anew."""
    swap = f"{name}__swap"
    if not spark.catalog.tableExists(swap):
        return
    if dict(spark.table(swap).dtypes) == dict(spark.table(name).dtypes):
        _move_partitions(spark, swap, name)
        spark.sql(f"DROP TABLE IF EXISTS {swap}")
        return
    columns = [F.col(f"`{c}`") for c in spark.table(name).columns]
    micros = setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    with micros, setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        spark.table(swap).select(*columns).write.mode("overwrite").insertInto(name)
    spark.sql(f"DROP TABLE IF EXISTS {swap}")


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]


def _move_partitions(spark: SparkSession, swap: str, name: str) -> None:
    """One move per partition folder; a folder goes from the copy last, so a stop in between is seen."""
    jvm = spark.sparkContext._jvm
    place = lambda path: jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    source, target = place(_location(spark, swap)), place(_location(spark, name))
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(source):
        folder = status.getPath()
        if status.isDirectory() and "=" in folder.getName():
            there = jvm.org.apache.hadoop.fs.Path(target, folder.getName())
            files.delete(there, True)
            if not files.rename(folder, there):
                raise OSError(f"cannot move {folder} to {there}")
    spark.catalog.refreshTable(name)


def _decision(name: str) -> str:
    """The table that says that staged tables of a schema are to take their places."""
    return f"{name.rpartition('.')[0]}.replacement__decided".lstrip(".")


def replace_all(contents: Mapping[str, Callable[[], DataFrame]], spark: SparkSession) -> None:
    """Replace several tables of one schema: all of them, or none.

    Every new content is written beside its table first; a failure up to there leaves all old tables as they are. Then
    one small table is written that lists them, which is the decision: from then on each access to a table of the schema
    (``table_or_none``, ``replace_table``, ``replace_all``) first finishes what is left of the swaps.
    """
    decisions = {_decision(name) for name in contents}
    if len(decisions) != 1:
        raise ValueError("the tables are of several schemas, or there are none")
    decision = decisions.pop()
    for name in contents:
        recover_table(spark, name)
    try:
        for name, content in contents.items():
            _save(content().write, f"{name}__staged", spark)
    except BaseException:
        for name in contents:
            spark.sql(f"DROP TABLE IF EXISTS {name}__staged")
        raise
    listed = spark.createDataFrame([(name,) for name in contents], "name string").coalesce(1)
    _save(listed.write, decision, spark)
    finish_replace(spark, decision)


def finish_replace(spark: SparkSession, decision: str) -> None:
    """Bring in the tables of a decided replacement that still wait. Doing it again changes nothing."""
    if not spark.catalog.tableExists(decision):
        return
    for row in spark.table(decision).collect():
        staged, old = f"{row.name}__staged", f"{row.name}__old"
        if spark.catalog.tableExists(staged):
            if spark.catalog.tableExists(row.name):
                spark.sql(f"DROP TABLE IF EXISTS {old}")
                _rename(spark, row.name, old)
            _rename(spark, staged, row.name)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"DROP TABLE IF EXISTS {decision}")
