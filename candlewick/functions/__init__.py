from candlewick.functions.columns import (
    above_baseline,
    epoch_ms_to_date,
    guarded_ratio,
    null_or,
    relative_path,
    trend_label,
)

__all__ = [
    "above_baseline",
    "epoch_ms_to_date",
    "guarded_ratio",
    "null_or",
    "relative_path",
    "trend_label",
]
