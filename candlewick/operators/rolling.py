"""Per-ticker series metrics over daily bars.

The input holds one bar per (ticker, day), so a window partition is bounded by the calendar (about
36,500 rows in a century), however large the table is. The table's rows spread over its tickers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import above_baseline, guarded_ratio, null_or, trend_label

# Fixed values (business rules): 3 % move, 1 % band, 2x volume, windows of 5/20/50 and 20 rows.
MOVE_THRESHOLD = 0.03
TREND_BAND = 0.01
SPIKE_FACTOR = 2
AVERAGE_WINDOWS = (5, 20, 50)
VOLUME_WINDOW = 20

RETURN_COLUMNS = ("prev_close_price", "daily_return", "is_significant_move")
VOLUME_COLUMNS = ("avg_volume_20d", "volume_ratio", "is_volume_spike")
AVERAGE_COLUMNS = (
    *(f"moving_avg_{n}d" for n in AVERAGE_WINDOWS),
    "volatility_20d",
    "trend",
)


def bar_metrics(
    bars: DataFrame,
    wanted: Sequence[str] = (*RETURN_COLUMNS, *AVERAGE_COLUMNS, *VOLUME_COLUMNS),
    *,
    keep: Sequence[str] | None = None,
    threshold: float = MOVE_THRESHOLD,
    band: float = TREND_BAND,
    window: int = VOLUME_WINDOW,
    factor: float = SPIKE_FACTOR,
) -> DataFrame:
    """``bars`` with the wanted metrics.

    Every metric shares one partitioning and one order, so any subset costs one shuffle and one sort.
    Columns outside ``keep`` (default: all) and the inputs of the metrics do not enter the shuffle.
    """
    series = Window.partitionBy("ticker").orderBy("trade_date")

    def trailing(rows: int) -> Window:
        return series.rowsBetween(1 - rows, Window.currentRow)

    close, volume = F.col("close_price"), F.col("volume")
    base: dict[str, Column] = {
        "prev_close_price": F.lag("close_price").over(series),
        **{f"moving_avg_{n}d": F.avg(close).over(trailing(n)) for n in AVERAGE_WINDOWS},
        "volatility_20d": F.stddev_samp(close).over(trailing(20)),
        "avg_volume_20d": F.avg(volume).over(series.rowsBetween(-window, -1)),
    }
    prev = F.col("prev_close_price")
    daily_return = guarded_ratio(close - prev, prev)
    baseline = F.col("avg_volume_20d")
    final: dict[str, Column] = {
        "daily_return": daily_return,
        "is_significant_move": null_or(daily_return, F.abs(daily_return) >= threshold),
        "trend": trend_label(F.col("moving_avg_5d"), F.col("moving_avg_20d"), band),
        "volume_ratio": guarded_ratio(volume, baseline),
        "is_volume_spike": above_baseline(volume, baseline, factor),
    }
    kept = list(bars.columns if keep is None else keep)
    needed = {
        "daily_return": ["prev_close_price"],
        "is_significant_move": ["prev_close_price"],
        "trend": ["moving_avg_5d", "moving_avg_20d"],
        "volume_ratio": ["avg_volume_20d"],
        "is_volume_spike": ["avg_volume_20d"],
    }
    first = {dep for name in wanted for dep in needed.get(name, [name])}
    sources = {"ticker", "trade_date", *kept}
    if first & {"avg_volume_20d"}:
        sources.add("volume")
    if first - {"avg_volume_20d"}:
        sources.add("close_price")
    windowed = bars.select(*[c for c in bars.columns if c in sources]).select(
        "*", *[expr.alias(name) for name, expr in base.items() if name in first]
    )
    return windowed.select(
        *kept, *[(final[name] if name in final else F.col(name)).alias(name) for name in wanted]
    )
