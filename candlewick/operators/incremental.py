"""Key-based incremental append, and the checks around it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.joins import spread_join

FIRST_WINS = "first_wins"
LATEST_WINS = "latest_wins"


def any_null(keys: Sequence[str], derived: Mapping[str, Column] | None = None) -> Column:
    test = F.lit(False)
    for part in [*[F.col(key) for key in keys], *(derived or {}).values()]:
        test = test | part.isNull()
    return test


def split_null_keys(
    df: DataFrame, keys: Sequence[str], derived: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows without), key parts computed from other columns included. A NULL key
    never matches a join, so those rows would be appended again by every rerun; they belong in a table
    of their own."""
    missing = any_null(keys, derived)
    return df.filter(~missing), df.filter(missing)


def exclude_existing(
    batch: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    *,
    derived: Mapping[str, Column] | None = None,
    policy: str = FIRST_WINS,
    version: str = "_ingested_at",
    key_range: tuple[str, object, object] | None = None,
    small_batch: bool = False,
    stored: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` does not hold yet. ``None`` stands for no target table.

    ``derived`` adds key parts computed from other columns on both sides (such as the day of a
    timestamp); they are not part of the result. With ``policy="latest_wins"`` a known key passes
    as well if its ``version`` is newer than the newest one stored; a NULL version is never newer.

    Existing keys are made unique before the shuffle (the target may hold a key many times); the
    batch side is left whole, and AQE can split a key that is hot there. ``key_range`` (a key column
    and the batch's smallest and largest value of it, see :func:`value_range`) limits the stored rows
    that are read: the filter reaches the scan, and a batch of a few days skips years of history. Days
    as bounds of a timestamp column take in the whole last day. ``small_batch`` first cuts the stored
    keys to those of the batch: the batch is read twice, but where its keys are small enough for Spark to
    broadcast, the stored side is neither made distinct nor shuffled. ``stored`` (writes a table and gives it back read
    from there) is for batches that are known for the most part and for ``policy="first_wins"``: the new keys are found
    from keys alone, by one grouping of both sides, and stored, now; then their size is known, and the rows of the batch need no shuffle where Spark
    broadcasts them.
    """
    if policy not in (FIRST_WINS, LATEST_WINS):
        raise ValueError(f"unknown policy {policy!r}")
    if existing is None:
        return batch
    if key_range is not None:
        column, low, high = key_range
        if dict(existing.dtypes)[column].startswith("timestamp"):
            after = F.date_add(F.lit(high).cast("date"), 1).cast("timestamp")
            within = (F.col(column) >= F.lit(low).cast("date").cast("timestamp")) & (F.col(column) < after)
        else:
            within = F.col(column).between(F.lit(low), F.lit(high))
        existing = existing.filter(within)
    derived = dict(derived or {})
    on = [*keys, *derived]
    columns = [F.col(f"`{c}`") for c in batch.columns]
    extra = [expr.alias(name) for name, expr in derived.items()]
    keyed = batch.select("*", *extra)
    known = existing.select("*", *extra)
    if small_batch:
        known = spread_join(known, keyed.select(*on).distinct(), on, "left_semi")
    if policy == FIRST_WINS and stored is not None:
        asked, have = (side.select(*on, F.lit(held).alias("_held")) for side, held in ((keyed, False), (known, True)))
        groups = asked.unionByName(have).groupBy(*on).agg(F.bool_or("_held").alias("_known"), F.bool_and("_held").alias("_only"))
        # A NULL never matches, so a key with one is new although there are stored ones like it.
        new = stored(groups.filter(~F.col("_only") & (~F.col("_known") | any_null(on))).select(*on))
        return spread_join(keyed, new, on, "left_semi").select(*columns)
    if policy == FIRST_WINS:
        return spread_join(keyed, known.select(*on).distinct(), on, "left_anti").select(*columns)

    newest = known.groupBy(*on).agg(F.max(version).alias("_stored"))
    names = {key: f"_known_{i}" for i, key in enumerate(on)}
    renamed = newest.select(
        *[F.col(k).alias(alias) for k, alias in names.items()],
        "_stored",
        F.xxhash64(*on).alias("_known_hash"),
    )
    hashed = keyed.select("*", F.xxhash64(*on).alias("_spread"))
    not_newer = F.col(version).isNull() | (F.col(version) <= F.col("_stored"))
    held = (F.col("_spread") == F.col("_known_hash")) & not_newer
    for key, alias in names.items():
        held = held & (F.col(key) == F.col(alias))
    return hashed.join(renamed, held, "left_anti").select(*columns)


def value_range(batch: DataFrame, column: str) -> tuple[str, object, object]:
    """The column with its smallest and largest value, as days if it is a timestamp. Runs now: a filter
    reaches a file scan only with values that are known when the query is planned."""
    value = F.col(column)
    if dict(batch.dtypes)[column].startswith("timestamp"):
        value = value.cast("date")
    row = batch.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    return column, row.low, row.high


def exclude_identical(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` that ``existing`` does not hold in identical form; NULL equals NULL.

    Both sides are matched on a hash of the whole row first, which spreads rows that share a NULL key.
    """
    if existing is None:
        return batch
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    known = existing.select(
        F.xxhash64(row).alias("_known_hash"), row.alias("_known_row")
    ).distinct()
    hashed = batch.select("*", F.xxhash64(row).alias("_hash"), row.alias("_row"))
    same = (F.col("_hash") == F.col("_known_hash")) & F.col("_row").eqNullSafe(F.col("_known_row"))
    return hashed.join(known, same, "left_anti").select(*[F.col(f"`{c}`") for c in batch.columns])


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """One row: the table's name, row count and an order-free checksum of its content.

    The hash passes over NULLs, so each column goes in with a mark of whether it is NULL.
    """
    marked = [part for c in df.columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    digest = F.xxhash64(*marked).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("checksum"),
    ).select(F.lit(name).alias("table_name"), "row_count", "checksum")


def idempotency_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compare two unions of :func:`fingerprint` rows, one per load, table by table."""
    first = before.select(
        "table_name", F.col("row_count").alias("run_1"), F.col("checksum").alias("checksum_1")
    )
    second = after.select(
        "table_name", F.col("row_count").alias("run_2"), F.col("checksum").alias("checksum_2")
    )
    same = F.col("run_1").eqNullSafe(F.col("run_2")) & F.col("checksum_1").eqNullSafe(
        F.col("checksum_2")
    )
    return first.join(second, "table_name", "full_outer").select(
        "table_name",
        "run_1",
        "run_2",
        F.when(same, "ok").otherwise("changed").alias("status"),
    )


def cast_rejects(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Per cast column, how many non-NULL values the target type cannot hold. One pass over ``df``."""
    counts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce(
                F.sum(
                    (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).cast("long")
                ),
                F.lit(0),
            ).alias("rejected"),
        )
        for name, kind in casts.items()
    ]
    return df.agg(F.array(*counts).alias("all")).select(F.inline("all"))
