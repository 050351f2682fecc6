from candlewick.operators.calendar import day_spine, days_of
from candlewick.operators.incremental import (
    cast_rejects,
    exclude_existing,
    fingerprint,
    idempotency_report,
    split_null_keys,
)
from candlewick.operators.joins import asof_join, current_lookup, spread_join
from candlewick.operators.quality import (
    Check,
    freshness,
    freshness_status,
    not_null,
    report,
    single_current,
    unique,
    unique_combination,
)
from candlewick.operators.ranking import dedup_latest, event_sequence, total_order, top_k_recent
from candlewick.operators.rolling import bar_metrics
from candlewick.operators.scd2 import current_state, scd2_history, scd2_merge, scd2_splice

__all__ = [
    "Check",
    "asof_join",
    "bar_metrics",
    "cast_rejects",
    "current_lookup",
    "current_state",
    "day_spine",
    "days_of",
    "dedup_latest",
    "event_sequence",
    "exclude_existing",
    "fingerprint",
    "freshness",
    "freshness_status",
    "idempotency_report",
    "not_null",
    "report",
    "scd2_history",
    "scd2_merge",
    "scd2_splice",
    "single_current",
    "split_null_keys",
    "spread_join",
    "top_k_recent",
    "total_order",
    "unique",
    "unique_combination",
]
