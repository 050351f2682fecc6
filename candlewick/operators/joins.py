"""Joins that hold up when one key has a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"


def _check_overlap(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    overlap = [c for c in right.columns if c in left.columns and c not in on]
    if overlap:
        raise ValueError(f"both sides share the columns {overlap}; rename one side")


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, *, in_place: bool = False) -> DataFrame:
    """Equi-join whose left side AQE can always split when a key is hot.

    AQE splits a skewed partition only where the join reads a shuffle of its own. A side that is
    already clustered on ``on`` (the result of a dedup or a distinct) has none, so the hot key would
    stay in one task. Joining on a hash of the key as well gives each side its own shuffle.
    Which side is broadcast, if any, is left to the optimizer's size check. ``in_place`` is for sides without a hot key
    that lie in the same buckets of a part of the key: they meet there, without a shuffle, where the query runs within
    :func:`candlewick.sources.tables.meeting_in_buckets`.
    """
    if how not in ("left_anti", "left_semi"):
        _check_overlap(left, right, on)
    if in_place:
        joined = left.join(right, [*on], how)
    else:
        key_hash = F.xxhash64(*[F.col(c) for c in on]).alias(_SPREAD)
        joined = left.select("*", key_hash).join(right.select("*", key_hash), [*on, _SPREAD], how)
    kept = [*left.columns]
    if how not in ("left_anti", "left_semi"):
        kept += [c for c in right.columns if c not in on]
    return joined.select(*kept)


def current_lookup(
    fact: DataFrame, dim: DataFrame, key: str, *, how: str = "inner", current: str = "is_current"
) -> DataFrame:
    """Fact rows with the attributes of the dimension version that is current now."""
    return spread_join(fact, dim.filter(F.col(current)), [key], how)


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    date_col: str,
    *,
    closed: bool = False,
    how: str = "inner",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    bucket_days: int = 64,
    date_range: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Fact rows with the dimension version valid on the fact's date.

    Half-open by default: ``valid_from <= date < valid_to``. ``closed=True`` includes ``valid_to`` and
    therefore returns two rows on a version boundary. ``how="left"`` keeps facts without a version.

    An equi-join on the key alone would compare every fact with every version of its key. Each
    version is therefore spread over the ``bucket_days``-long time buckets it covers, limited to
    the fact dates (pass ``date_range`` when known, to save the scan), and the join is on
    (key, bucket): a fact meets only versions of its own bucket, and a hot key is cut by time.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if date_range is None:
        # One scalar subquery, used in several places and computed once.
        ends = F.struct(F.min(date_col).alias("low"), F.max(date_col).alias("high"))
        bounds = fact.agg(ends.alias("bounds")).scalar()
        date_range = (bounds.getField("low"), bounds.getField("high"))
    low, high = date_range

    def bucket(day: Column) -> Column:
        return F.floor(F.unix_date(day.cast("date")) / F.lit(bucket_days))

    _check_overlap(fact, dim, [key])
    first = F.greatest(bucket(F.col(valid_from)), bucket(low))
    last = F.least(F.coalesce(bucket(F.col(valid_to)), bucket(high)), bucket(high))
    versions = (
        dim.select("*", first.alias("_first"), last.alias("_last"))
        .filter(F.col("_first") <= F.col("_last"))
        .select(
            F.col(key).alias("_dim_key"),
            *[c for c in dim.columns if c != key],
            F.explode(F.sequence("_first", "_last")).alias("_dim_bucket"),
        )
    )
    facts = fact.select("*", bucket(F.col(date_col)).alias("_bucket"))
    started = F.col(date_col) >= F.col(valid_from)
    running = F.col(valid_to).isNull()
    ended = F.col(date_col) <= F.col(valid_to) if closed else F.col(date_col) < F.col(valid_to)
    matches = (
        (F.col(key) == F.col("_dim_key"))
        & (F.col("_bucket") == F.col("_dim_bucket"))
        & started
        & (running | ended)
    )
    return facts.join(versions, matches, how).drop("_bucket", "_dim_bucket", "_dim_key")
