"""Typed tables from landed envelopes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import (
    cast_rejects,
    dedup_latest,
    exclude_existing,
    fingerprint,
    idempotency_report,
    split_null_keys,
)
from candlewick.operators.incremental import FIRST_WINS, any_null, exclude_identical, value_range
from candlewick.session import remove_folder, shared_dir
from candlewick.sources.key_index import KeyIndex
from candlewick.sources.landing import read_landing
from candlewick.sources.registry import CORRUPT, SOURCES, TABLES
from candlewick.sources.tables import append_table, replace_all, table_or_none


def with_source_file(envelopes: DataFrame) -> DataFrame:
    """Attach the path of the file each envelope came from."""
    return envelopes.select("*", F.col("_metadata.file_path").alias("_source_file"))


def project(envelopes: DataFrame, table: str) -> DataFrame:
    """The columns of a typed table, from envelopes that carry ``_source_file``; rows as landed.

    Fields the table does not use are pruned inside the JSON parser.
    """
    spec = TABLES[table]
    if spec.explode:
        envelopes = envelopes.select("*", F.explode(spec.explode).alias("_element"))
    return envelopes.select(*_columns(table))


def _columns(table: str) -> list[Column]:
    return [
        *[expr.alias(name) for name, expr in TABLES[table].columns().items()],
        F.col("_ingested_at").try_cast("timestamp").alias("_ingested_at"),
        F.col("_source_file"),
    ]


def fan_out(envelopes: DataFrame, tables: Sequence[str], folder: str) -> dict[str, DataFrame]:
    """The projected rows of several tables of one source from a single parse, written to ``folder`` in one job.

    The parsed envelopes are written as typed Parquet, one row each, and each table is projected from the columns it
    needs of these, as often as a load asks for it; the files outlive a lost executor. At most one of the tables may
    explode an array.
    """
    exploded = [t for t in tables if TABLES[t].explode]
    if len(exploded) > 1:
        raise ValueError(f"{exploded} each explode an array")
    parsed = envelopes.select("record", "_ingested_at", "_request_metadata", "_source_file")
    parsed.write.option("compression", "zstd").parquet(folder)
    staged = envelopes.sparkSession.read.schema(parsed.schema).parquet(folder)
    return {t: project(staged, t) for t in tables}


def structured(rows: DataFrame, table: str) -> DataFrame:
    """Projected rows made unique by key where the table asks for it within a batch: newest ingest
    first, then a total order, so the same row survives on every run. Other tables keep all rows."""
    spec = TABLES[table]
    if not spec.unique_in_batch:
        return rows
    return dedup_latest(rows, spec.keys, [F.col("_ingested_at").desc_nulls_last()])


def rejected_values(envelopes: DataFrame, table: str) -> DataFrame:
    """How many landed text values a typed table could not cast, per field."""
    casts = dict(TABLES[table].text_casts)
    return cast_rejects(envelopes.select(*[F.col(f"record.{c}").alias(c) for c in casts]), casts)


def mismatched_values(envelopes: DataFrame, source: str) -> DataFrame:
    """How many landed values were not of the type their record field has, and so became NULL, per field.

    The parser keeps the text of a line it could not take in whole, and only such lines are looked at twice.
    """
    fields = [f.name for f in SOURCES[source].record]
    text = F.col(CORRUPT)

    def lost(name: str) -> Column:
        there = F.get_json_object(text, f"$.record.{name}").isNotNull()
        return text.isNotNull() & F.col(f"record.{name}").isNull() & there

    counts = [F.struct(F.lit(n).alias("column_name"), F.count_if(lost(n)).alias("rejected")) for n in fields]
    return envelopes.agg(F.array(*counts).alias("all")).select(F.inline("all"))


def new_rows(
    rows: DataFrame,
    existing: DataFrame | None,
    table: str,
    *,
    policy: str = FIRST_WINS,
    key_range: tuple[str, object, object] | None = None,
    small_batch: bool = False,
    stored: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The projected rows of a batch that a load would append to ``existing``. With ``stored`` only rows with a new key are
    made unique and shuffled, see :func:`exclude_existing`; what is stored has a row for keys with a NULL, too."""
    spec = TABLES[table]
    if stored is not None and existing is not None and policy == FIRST_WINS:
        fresh = exclude_existing(rows, existing, spec.keys, derived=spec.derived_keys(), key_range=key_range, stored=stored)
        return structured(fresh, table)
    keyed, _ = split_null_keys(rows, spec.keys, spec.derived_keys())
    return exclude_existing(
        structured(keyed, table),
        existing,
        spec.keys,
        derived=spec.derived_keys(),
        policy=policy,
        key_range=key_range,
        small_batch=small_batch,
    )


def append_batch(
    spark: SparkSession,
    envelopes: DataFrame,
    table: str,
    target: str,
    *,
    policy: str = FIRST_WINS,
    small_batch: bool = False,
    indexed: bool = False,
) -> dict[str, int]:
    """Project the envelopes and append the rows; see :func:`append_rows`."""
    return append_rows(
        spark, project(envelopes, table), table, target, policy=policy, small_batch=small_batch, indexed=indexed
    )


def append_rows(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    target: str,
    *,
    policy: str = FIRST_WINS,
    small_batch: bool = False,
    indexed: bool = False,
) -> dict[str, int]:
    """Append the projected rows with new keys to ``target``; rows without a key go to its quarantine table.

    Returns both row counts, observed while writing. The write also counts the rows without a key, so
    the rows are read a second time only if there are any. With ``small_batch`` the lookup of
    known keys is limited to the batch's range of the table's time key, or else to the batch's keys.
    With ``indexed`` it opens only the files that may hold a key of the batch, which a :class:`KeyIndex`
    names; the counts then say how many of how many files these were. Any other batch for a table that exists is taken for
    known for the most part, as landing files stay: its new keys are found first, from keys alone, and whole rows are read
    only if there are any.
    """
    spec = TABLES[table]
    parsed, written = Observation(), Observation()
    counted = rows.observe(parsed, F.count_if(any_null(spec.keys, spec.derived_keys())).alias("unkeyed"))
    existing, opened = table_or_none(spark, target), {}
    if indexed:
        keyed, _ = split_null_keys(rows, spec.keys, spec.derived_keys())
        index = KeyIndex(spark, target, spec.keys, spec.derived_keys(), spec.range_key)
        existing, some, every = index.existing(keyed)
        opened, small_batch = {"files_opened": some, "files": every}, False
    key_range = None
    if small_batch and existing is not None and spec.range_key:
        key_range = value_range(rows, spec.range_key)
    folder = f"{shared_dir(spark)}/new-keys-{uuid.uuid4().hex}"
    unknown: list[bool] = []  # whether rows lack a key, where keys were looked up alone

    def stored(keys: DataFrame) -> DataFrame:
        keys.write.parquet(folder)
        new = spark.read.schema(keys.schema).parquet(folder)
        keyed, unkeyed = split_null_keys(new, keys.columns)
        unknown.append(not unkeyed.isEmpty())
        return keyed

    by_keys = existing is not None and policy == FIRST_WINS and not (small_batch or indexed)
    try:
        fresh = new_rows(
            rows if by_keys else counted,
            existing,
            table,
            policy=policy,
            key_range=key_range,
            small_batch=small_batch and not spec.range_key,
            stored=stored if by_keys else None,
        )
        append_table(fresh.observe(written, F.count(F.lit(1)).alias("rows")), target)
    finally:
        remove_folder(spark, folder)
    counts = {"appended": written.get.get("rows", 0), "quarantined": 0, **opened}
    if unknown[0] if by_keys else parsed.get.get("unkeyed") != 0:
        aside = f"{target}__quarantine"
        _, unkeyed = split_null_keys(rows, spec.keys, spec.derived_keys())
        held = Observation()
        unkeyed = exclude_identical(unkeyed, table_or_none(spark, aside))
        append_table(unkeyed.observe(held, F.count(F.lit(1)).alias("rows")), aside)
        counts["quarantined"] = held.get.get("rows", 0)
    return counts


def landed(
    spark: SparkSession, landing_root: str, table: str, since: date | None = None
) -> DataFrame:
    """Envelopes of a table's source; ``since`` prunes older landing folders. The key rule of the load
    stays in force either way, as a new folder may replay old records."""
    envelopes = with_source_file(read_landing(spark, landing_root, TABLES[table].source))
    return envelopes if since is None else envelopes.filter(F.col("date") >= F.lit(since))


def load_table(
    spark: SparkSession,
    table: str,
    *,
    landing_root: str,
    target: str,
    policy: str = FIRST_WINS,
    since: date | None = None,
    indexed: bool = False,
) -> dict[str, int]:
    """Load one typed table from the landing folder of its source."""
    return append_batch(
        spark,
        landed(spark, landing_root, table, since),
        table,
        target,
        policy=policy,
        small_batch=since is not None,
        indexed=indexed,
    )


def load_bronze(
    spark: SparkSession,
    *,
    landing_root: str,
    schema: str,
    policy: str = FIRST_WINS,
    since: date | None = None,
    indexed: bool = False,
) -> dict[str, dict[str, int]]:
    """Load all six tables in order. A source that feeds two tables is parsed once, into both."""
    counts: dict[str, dict[str, int]] = {}
    staged: dict[str, DataFrame] = {}
    folders: list[str] = []
    try:
        for table, spec in TABLES.items():
            together = [t for t, other in TABLES.items() if other.source == spec.source]
            if table not in staged and len(together) > 1:
                folders.append(f"{shared_dir(spark)}/fan-out-{uuid.uuid4().hex}")
                staged.update(fan_out(landed(spark, landing_root, table, since), together, folders[-1]))
            rows = staged.get(table)
            counts[table] = append_rows(
                spark,
                project(landed(spark, landing_root, table, since), table) if rows is None else rows,
                table,
                f"{schema}.{table}",
                policy=policy,
                small_batch=since is not None,
                indexed=indexed,
            )
    finally:
        for folder in folders:
            remove_folder(spark, folder)
    return counts


def reload_bronze(spark: SparkSession, *, landing_root: str, schema: str) -> dict[str, int]:
    """Rebuild all six tables and their quarantine tables from Landing: all of them, or none. A failure in any table
    leaves the old ones, and a stop while the new ones take their places is finished by the next access."""
    seen: dict[str, Observation] = {}
    contents: dict[str, Callable[[], DataFrame]] = {}
    for table, spec in TABLES.items():
        rows = project(landed(spark, landing_root, table), table)
        parsed, seen[table] = Observation(), Observation()

        def fresh(rows: DataFrame = rows, table: str = table, parsed: Observation = parsed) -> DataFrame:
            missing = any_null(TABLES[table].keys, TABLES[table].derived_keys())
            counted = rows.observe(parsed, F.count_if(missing).alias("unkeyed"))
            return new_rows(counted, None, table).observe(seen[table], F.count(F.lit(1)).alias("rows"))

        def aside(rows: DataFrame = rows, table: str = table, parsed: Observation = parsed) -> DataFrame:
            if parsed.get.get("unkeyed") == 0:  # parsed a second time only if there is something to set aside
                return spark.createDataFrame([], rows.schema)
            return split_null_keys(rows, TABLES[table].keys, TABLES[table].derived_keys())[1]

        contents[f"{schema}.{table}"] = fresh
        contents[f"{schema}.{table}__quarantine"] = aside
    replace_all(contents, spark)
    return {table: seen[table].get.get("rows", 0) for table in TABLES}


def verify_incremental(
    spark: SparkSession, *, landing_root: str, schema: str
) -> DataFrame:
    """Load twice and compare row counts and content of every table: all must say 'ok'.

    The fingerprints of the first load are one row per table and are fixed before the second load.
    """
    def prints() -> DataFrame:
        parts = [fingerprint(spark.table(f"{schema}.{t}"), t) for t in TABLES]
        return reduce(DataFrame.unionByName, parts)

    load_bronze(spark, landing_root=landing_root, schema=schema)
    columns = prints().schema
    before = spark.createDataFrame(prints().collect(), columns)
    load_bronze(spark, landing_root=landing_root, schema=schema)
    return idempotency_report(before, prints())
