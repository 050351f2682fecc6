"""Landed records held against the schema of their source."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.drift import drift_report, unfold, unknown_values
from candlewick.sources.landing import source_path
from candlewick.sources.registry import CORRUPT, SOURCES


def _schema(source: str) -> T.StructType:
    return T.StructType([f for f in SOURCES[source].envelope if f.name != CORRUPT])


def _lines(spark: SparkSession, root: str, source: str) -> DataFrame:
    lines = spark.read.schema("value string").text(source_path(root, source))
    return lines.select("value", "date", F.col("_metadata.file_path").alias("_source_file"))


def landing_drift(spark: SparkSession, root: str, sources: Iterable[str] = tuple(SOURCES)) -> DataFrame:
    """source, path, declared, landed, n_values, n_lost, status for all that was landed, at every level of nesting."""
    parts = [
        drift_report(unfold(_lines(spark, root, s), _schema(s)), _schema(s)).select(F.lit(s).alias("source"), "*")
        for s in sources
    ]
    return reduce(DataFrame.unionByName, parts)


def landing_unknown(spark: SparkSession, root: str, source: str) -> DataFrame:
    """date, _source_file, path, landed, value (VARIANT) of the fields that the source's schema lacks."""
    return unknown_values(unfold(_lines(spark, root, source), _schema(source), keep=["date", "_source_file"]))
