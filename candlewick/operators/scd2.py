"""Type-2 history: which attribute values were valid when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.ranking import dedup_latest


def current_state(
    versions: DataFrame,
    key: str,
    order: Sequence[Column],
    columns: Sequence[str],
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest row of each key, reduced to the key and the tracked columns."""
    return dedup_latest(versions, [key], order, tiebreak).select(key, *columns)


def _differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    differs = F.lit(False)
    for a, b in zip(left, right, strict=True):
        differs = differs | ~a.eqNullSafe(b)
    return differs


def scd2_merge(
    state: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], run_ts: Column
) -> DataFrame:
    """The history after one run: a new key opens a version, a changed one closes its open version at
    ``run_ts`` and opens the next, an unchanged or missing one stays as it is.

    ``state`` has the columns of ``current`` plus ``valid_from`` and ``valid_to``; ``current`` has one
    row per key. Only open versions take part in the join, which has at most one row per key on each
    side; closed history is passed through without a shuffle.
    """
    attributes = [c for c in current.columns if c != key]
    opened = state.filter(F.col("valid_to").isNull()).select(
        F.struct(*[F.col(c) for c in (key, *attributes, "valid_from")]).alias("old"),
        F.col(key).alias("_old_key"),
    )
    incoming = current.filter(F.col(key).isNotNull()).select(
        F.struct(*[F.col(c) for c in (key, *attributes)]).alias("new"),
        F.col(key).alias("_new_key"),
    )
    pairs = opened.join(incoming, F.col("_old_key") == F.col("_new_key"), "full_outer")
    known, seen = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    changed = (
        known
        & seen
        & _differs([F.col(f"old.{c}") for c in check_cols], [F.col(f"new.{c}") for c in check_cols])
    )
    stamp = state.schema["valid_from"].dataType

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in (key, *attributes)],
            start.cast(stamp).alias("valid_from"),
            end.cast(stamp).alias("valid_to"),
        )

    rows = F.array(
        F.when(known, version("old", F.col("old.valid_from"), F.when(changed, run_ts))),
        F.when(~known | changed, version("new", run_ts, F.lit(None))),
    )
    merged = (
        pairs.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("row"))
        .select("row.*")
        .select(*state.columns)
    )
    return state.filter(F.col("valid_to").isNotNull()).unionByName(merged)


def scd2_history(
    versions: DataFrame, key: str, check_cols: Sequence[str], ts: str
) -> DataFrame:
    """The history that one merge per distinct ``ts`` would build, in a single pass.

    ``versions`` has one row per (key, ``ts``): a window partition is bounded by the number of
    snapshot days. Both windows share one shuffle and one sort.
    """
    timeline = Window.partitionBy(key).orderBy("_at")
    first = F.row_number().over(timeline) == 1
    changed = _differs([F.lag(c).over(timeline) for c in check_cols], [F.col(c) for c in check_cols])
    starts = (
        versions.filter(F.col(key).isNotNull())
        .select(key, *check_cols, F.col(ts).alias("_at"))
        .select("*", (first | changed).alias("_starts"))
        .filter("_starts")
    )
    return starts.select(
        key,
        *check_cols,
        F.col("_at").alias("valid_from"),
        F.lead("_at").over(timeline).alias("valid_to"),
    )


def scd2_splice(
    state: DataFrame,
    snapshots: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: str,
    seen: str = "seen_at",
    *,
    replace: bool = False,
) -> DataFrame:
    """The history after snapshots that may be older than what it holds.

    ``state`` has the key, the checked columns, ``valid_from``, ``valid_to`` and ``seen``, the sorted times
    of the snapshots that showed a version. They are what a later splice needs: where a snapshot falls
    inside a version, the times behind it begin a version of their own, with the same values. In whatever
    order and grouping snapshots arrive, the result is that of :func:`scd2_history` over all of them; a
    snapshot seen before changes nothing. Of two different snapshots of one key and time the one with the
    greater values (in column order, NULL least) stands, so that the order of arrival does not matter here either;
    with ``replace`` the one of the batch stands, as a correction.

    Only versions near a new snapshot are opened: of each key those that begin or end within the span from
    the version before its first new snapshot to the version after its last one. All others pass through
    without a shuffle if the keys of the batch are small enough to be broadcast. A window partition is bounded
    by the number of snapshot times of a key.
    """
    columns = [key, *check_cols]
    fresh = snapshots.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        *columns, F.col(ts).cast(state.schema["valid_from"].dataType).alias("_at")
    )
    spans = fresh.groupBy(F.col(key).alias("_k")).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    placed = state.join(spans, F.col(key) == F.col("_k"), "left")
    # A version touches the span if it is valid at some time of it, ends where the span begins or begins right behind.
    begins = F.col("valid_from") <= F.col("_last")
    ends = F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_first"))
    timeline = Window.partitionBy(key).orderBy("valid_from")
    known = placed.filter(F.col("_k").isNotNull())
    near = begins & ends
    marked = known.select("*", near.alias("_near")).select(
        "*", (F.col("_near") | F.coalesce(F.lag("_near").over(timeline), F.lit(False))).alias("_open")
    )
    # A span before the first version touches none; its first version follows right behind.
    first = F.row_number().over(timeline) == 1
    marked = marked.select("*", (F.col("_open") | (first & (F.col("valid_from") > F.col("_last")))).alias("_opened"))
    untouched = placed.filter(F.col("_k").isNull()).select(*state.columns)
    passed = marked.filter(~F.col("_opened")).select(*state.columns)
    points = marked.filter("_opened").select(*columns, F.explode(seen).alias("_at"), F.lit(0).alias("_arrived"))
    arrived = fresh.select("*", F.lit(int(replace)).alias("_arrived"))
    values = [F.col(c).desc_nulls_last() for c in ("_arrived", *check_cols)]
    every = dedup_latest(points.unionByName(arrived), [key, "_at"], values, tiebreak=[])
    order = Window.partitionBy(key).orderBy("_at")
    changed = (F.row_number().over(order) == 1) | _differs(
        [F.lag(c).over(order) for c in check_cols], [F.col(c) for c in check_cols]
    )
    numbered = every.select("*", changed.cast("int").alias("_starts")).select(
        "*", F.sum("_starts").over(order).alias("_version")
    )
    grouped = numbered.groupBy(key, "_version").agg(
        *[F.min_by(c, "_at").alias(c) for c in check_cols],
        F.min("_at").alias("valid_from"),
        F.sort_array(F.collect_list("_at")).alias(seen),
    )
    # What follows the last opened version is either a version that stayed or nothing.
    ends_at = marked.filter("_opened").groupBy(F.col(key).alias("_k2")).agg(
        F.max(F.struct("valid_from", "valid_to"))["valid_to"].alias("_end")
    )
    spliced = grouped.join(ends_at, F.col(key) == F.col("_k2"), "left").select(
        *columns,
        "valid_from",
        F.coalesce(F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from")), "_end").alias("valid_to"),
        seen,
    )
    return untouched.unionByName(passed).unionByName(spliced.select(*state.columns))
