"""Series metrics computed anew only where a changed bar can reach."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.joins import spread_join

#: Rows that the furthest metric looks back (an average over 50 rows) or a lag of one, rounded up.
HALO = 50
REACHED = "_reached"


def reached_bars(
    bars: DataFrame,
    changes: DataFrame,
    halo: int = HALO,
    key: str = "ticker",
    order: str = "trade_date",
    *,
    few: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """The bars a change can reach, with the bars before them that their metrics look at.

    ``changes`` has the key and date of bars that were added, corrected or removed; ``bars`` is the content after
    that. A change at a date reaches the first bar at or after it and the ``halo`` bars behind that one; ``_reached``
    tells these from the ``halo`` bars before each of them. Tickers without a change are left out by a join that needs
    no shuffle of the bars where the changed tickers are few. One shuffle and one sort serve all windows, and
    :func:`bar_metrics` over the result uses them again. Without ``few`` most tickers are taken for changed, and those
    that are not are left out by the windows alone, as the join would shuffle the bars once more. ``tasks`` is the number
    of tasks that the tickers are dealt to (default: Spark's); changes that lie in as many buckets by ticker stay there.
    """
    points = changes.filter(F.col(key).isNotNull() & F.col(order).isNotNull()).select(key, order).distinct()
    own = spread_join(bars, points.select(key).distinct(), [key], "left_semi") if few else bars
    if tasks:
        own = own.repartition(tasks, key)
    marks = points.select(*[(F.col(c) if c in (key, order) else F.lit(None).cast(own.schema[c].dataType)).alias(c) for c in bars.columns])
    line = own.withColumn("_mark", F.lit(0)).unionByName(marks.withColumn("_mark", F.lit(1)))
    series = Window.partitionBy(key).orderBy(order, F.col("_mark").desc())
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = line.withColumn("_n", F.sum(1 - F.col("_mark")).over(so_far))  # bars up to here; before it, for a mark
    last_change = F.max(F.when(F.col("_mark") == 1, F.col("_n"))).over(so_far)
    reached = numbered.withColumn(REACHED, (F.col("_mark") == 0) & F.coalesce(F.col("_n") <= last_change + 1 + halo, F.lit(False)))
    # The next reached bar stands behind the next mark, and only bars lie before that, so a frame of ``halo`` rows finds it.
    # A frame that runs to the end of the series would be summed up anew for every row.
    next_mark = F.min(F.when(F.col("_mark") == 1, F.col("_n"))).over(series.rowsBetween(Window.currentRow, halo))
    every = F.max("_n").over(series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = F.when(F.col(REACHED), F.col("_n")).when(next_mark < every, next_mark + 1)
    needed = reached.withColumn("_next", following).filter((F.col("_mark") == 0) & (F.col("_next") - F.col("_n") <= halo))
    return needed.drop("_mark", "_n", "_next")


def refreshed(
    facts: DataFrame,
    bars: DataFrame,
    changes: DataFrame,
    compute: Callable[[DataFrame, Sequence[str]], DataFrame],
    keep: Sequence[str],
    halo: int = HALO,
    key: str = "ticker",
    order: str = "trade_date",
) -> DataFrame:
    """``facts`` with the rows that a change reaches replaced, those of removed bars left out, and new ones added.

    ``compute(bars, keep)`` gives the fact's columns and those of ``keep`` for the bars it gets.
    """
    near = reached_bars(bars, changes, halo, key, order)
    anew = compute(near, [*keep, REACHED]).filter(REACHED).drop(REACHED)
    return replaced(facts, anew, changes, key, order)


def replaced(
    facts: DataFrame, anew: DataFrame, changes: DataFrame, key: str = "ticker", order: str = "trade_date", *, in_place: bool = False
) -> DataFrame:
    """``facts`` with the rows of ``anew`` in place of those of their key and date, without those of ``changes``. ``anew`` is
    used twice. With ``in_place`` all three lie in the same buckets of the key, and none is shuffled."""
    gone = [rows.select(key, order) for rows in (anew, changes)]
    if not in_place:
        gone = [gone[0].union(gone[1])]
    stay = facts
    for rows in gone:
        stay = spread_join(stay, rows.distinct(), [key, order], "left_anti", in_place=in_place)
    return stay.unionByName(anew.select(*facts.columns))
