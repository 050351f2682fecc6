"""Least and greatest values of a stored table's columns from the footers of its files.

Spark answers MIN and MAX over Parquet from the footers if the newer reader plans the scan: one row per file, no data
page. That holds for whole numbers and dates; timestamps are asked for as the microseconds they are stored as. A file
without the statistics (a column that is NULL throughout, the 96-bit timestamps of other writers) makes Spark refuse;
the column is then scanned, and so is one behind a nested column. The files hold the columns in the table's order, as
``sources.tables`` writes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sources.tables import setting, table_or_none

#: Footers leave out NaN, which Spark takes for the greatest value, and may cut texts short: neither kind is answered.
_COUNTED = (T.TimestampType, T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _ends(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    ends = [f(F.col(f"`{c}`")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in (("low", F.min), ("high", F.max))]
    return rows.agg(*ends)


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]


def footer_ends(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """One row low_0, high_0, low_1, ... over the files, timestamps as microseconds. To be planned and run with the
    settings of ``bounds``."""
    # Spark finds a column's statistics by its place in the schema, so all columns are named, as they lie in the files.
    stored = T.StructType(
        [T.StructField(f.name, T.LongType() if f.dataType == T.TimestampType() else f.dataType) for f in spark.table(table).schema]
    )
    return _ends(spark.read.schema(stored).parquet(_location(spark, table)), columns)


def _placed(rows: DataFrame, column: str) -> bool:
    """Whether the place in the schema is the place in the footers: a nested column has several or none there."""
    names = rows.columns
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return not any(isinstance(rows.schema[c].dataType, nested) for c in names[: names.index(column)])


def bounds(spark: SparkSession, table: str, columns: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """(least, greatest) value of each column as literals; NULLs for a table without rows or a column without values.

    To the driver come two values per column. Columns of a kind that footers do not answer exactly are an
    error.
    """
    rows = table_or_none(spark, table)
    if rows is None:
        raise ValueError(f"no table {table}")
    types = {c: rows.schema[c].dataType for c in columns}
    for column, kind in types.items():
        if not isinstance(kind, _COUNTED):
            raise ValueError(f"{column} is {kind.simpleString()}, which has no bounds in a footer")
    readers = "spark.sql.sources.useV1SourceList"
    older = ",".join(r for r in spark.conf.get(readers).split(",") if r.strip() != "parquet")
    found: dict[str, tuple] = {}
    for column in columns:  # one by one, so that one without statistics does not make all of them be scanned
        if _placed(rows, column):
            with setting(spark, readers, older), setting(spark, "spark.sql.parquet.aggregatePushdown", "true"):
                try:
                    found[column] = tuple(footer_ends(spark, table, [column]).first())
                except (PySparkException, Py4JJavaError):
                    pass  # a file without statistics; the scan below gives the answer, or the true fault
        if column not in found:
            value = F.col(f"`{column}`")
            if types[column] == T.TimestampType():
                value = F.unix_micros(value)
            found[column] = tuple(_ends(rows.select(value.alias(column)), [column]).first())
    return {c: tuple(_literal(v, types[c]) for v in found[c]) for c in columns}


def _literal(value: object, kind: T.DataType) -> Column:
    if value is not None and kind == T.TimestampType():
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)
