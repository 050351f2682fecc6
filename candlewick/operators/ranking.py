"""Row choice and numbering within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.joins import spread_join

_RANK = "_rank"
SPLITS = 64


def total_order(df: DataFrame, *, skip: Sequence[str] = ()) -> list[Column]:
    """Descending order over every remaining column, so that only identical rows can tie.

    The sort reaches these columns only when all earlier ones are equal.
    """
    return [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in skip]


def top_k_recent(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key in the given order.

    Spark turns ``row_number() <= k`` into a WindowGroupLimit that runs before the shuffle as
    well (for ``k`` up to the optimizer's limit of 1,000), so a map task sends at most ``k`` rows per
    key and a hot key stays small.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) <= k).drop(_RANK)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the first in ``order``. Ties fall to ``tiebreak`` (default: all other columns)."""
    if tiebreak is None:
        tiebreak = total_order(df, skip=keys)
    return top_k_recent(df, keys, [*order, *tiebreak], 1)


def _shared(low: Column, high: Column) -> Column:
    """How many characters two texts begin with alike; 0 if one holds the separator."""
    ends = F.concat(low, F.lit("\0"), high)
    alike = F.length(F.regexp_extract(ends, r"(?s)^([^\x00]*)[^\x00]*\x00\1", 1))
    return F.when(F.size(F.split(ends, r"\x00")) == 2, alike).otherwise(0)


def _image(df: DataFrame, id_col: str, shared: Column) -> Column | None:
    """A number that never falls as the id grows, for ids of one group; None for other types.

    Texts are compared by their bytes: the number is made of the first six after the ``shared`` characters that all
    ids of the group begin with.
    """
    kind, value = df.schema[id_col].dataType, F.col(f"`{id_col}`")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.StringType):
        rest = F.encode(F.substring(value, shared + 1, F.lit(6)), "UTF-8")
        six = F.substring(F.rpad(rest, 6, F.lit(b"\0")), 1, 6)
        return F.conv(F.hex(six), 16, 10).cast("double")
    return None


def _parts_by_quantile(placed: DataFrame, keys: Sequence[str], id_col: str, split_rows: int) -> DataFrame:
    """``placed`` with ``_part``, which grows with the id: groups of more than ``split_rows`` rows are cut at the
    quantiles that a sketch of their ids gives, all other groups are one part. Only rows of such groups are sketched;
    without any, Spark drops the join at run time. What the ids of a group share is found once per group, and the number
    of an id once per row, before it is compared with the cuts."""
    value = F.col(f"`{id_col}`")
    sizes = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    image = _image(placed, id_col, F.col("_shared"))
    if image is None:
        return placed.withColumn("_part", F.struct(F.lit(0).alias("p")))
    text = isinstance(placed.schema[id_col].dataType, T.StringType)
    shared = _shared(F.col("_low"), F.col("_high")) if text else F.lit(0)
    hot = sizes.where(F.col("_rows") > split_rows).select(*keys, shared.alias("_shared"))
    at = [i / SPLITS for i in range(1, SPLITS)]
    cuts = (
        spread_join(placed.select(*keys, f"`{id_col}`"), hot, keys, "inner")
        .groupBy(*keys, "_shared")
        .agg(F.percentile_approx(image, at, 20 * SPLITS).alias("_cuts"))
    )
    # No lambda over the cuts: what it compares with would be computed anew for each of them.
    below = F.array_position(F.sort_array(F.array_append("_cuts", image)), image) - 1
    part = F.struct(F.when(value.isNotNull(), F.coalesce(below, F.lit(0)).cast("int")).alias("p"))
    return spread_join(placed, cuts, keys, "left").select(*placed.columns, part.alias("_part"))


def event_sequence(
    df: DataFrame,
    key: str,
    date_col: str,
    id_col: str,
    *,
    name: str = "event_seq",
    id_block: Column | None = None,
    split_rows: int = 1_000_000,
) -> DataFrame:
    """Number the events of each key, newest date first, ``id_col`` ascending within a date.

    A key's whole history is never sorted in one task, and neither is one huge date. Rows are numbered inside
    blocks of (key, date, part of the ids); the number of rows in the earlier blocks of the key is added to that.
    Block counts are aggregated before they are shuffled, so one row per block and task travels, and
    a window over them sees one row per date of a key, or per part of a date.
    A date of a key with more than ``split_rows`` rows is cut into parts by a quantile sketch of its ids; the
    numbers do not depend on where. ``id_block`` gives the parts instead: it must grow with ``id_col`` (a prefix,
    ``floor(id / n)``).
    """
    # Wrapped in structs, NULL keys and dates group, partition and join like any other value.
    parts = {"_key": F.struct(key), "_day": F.struct(F.col(date_col).alias("d"))}
    placed = df.select("*", *[expr.alias(n) for n, expr in parts.items()])
    if id_block is None:
        placed = _parts_by_quantile(placed, list(parts), id_col, split_rows)
    else:
        placed = placed.withColumn("_part", F.struct(id_block.alias("p")))
    parts = [*parts, "_part"]
    earlier_rows = (Window.unboundedPreceding, -1)

    def rows_before(scope: Sequence[str], order: Column) -> Column:
        window = Window.partitionBy(*scope).orderBy(order).rowsBetween(*earlier_rows)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    blocks = placed.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    newer_days = rows_before(["_key"], F.col("_day.d").desc_nulls_last())
    days = blocks.groupBy("_key", "_day").agg(F.sum("_n").alias("_n"))
    smaller_ids = rows_before(["_key", "_day"], F.col("_part.p").asc_nulls_last())
    offsets = (
        blocks.select(*parts, smaller_ids.alias("_in_day"))
        .join(days.select("_key", "_day", newer_days.alias("_newer")), ["_key", "_day"])
        .select(*parts, (F.col("_newer") + F.col("_in_day")).alias("_before"))
    )
    within = Window.partitionBy(*parts).orderBy(F.col(id_col).asc_nulls_last())
    return (
        placed.withColumn("_at", F.row_number().over(within))
        .join(offsets, parts, "inner")
        .select(*df.columns, (F.col("_before") + F.col("_at")).cast("long").alias(name))
    )
