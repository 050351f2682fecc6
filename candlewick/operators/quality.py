"""Data tests: each returns the violating rows or keys; none means it passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL = "not_null"
UNIQUE = "unique"
COMBINATION = "unique_combination"
SINGLE_CURRENT = "single_current"


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def _repeated(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return _repeated(df.filter(F.col(column).isNotNull()), [column], "n_records")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULL counts as a value."""
    return _repeated(df, columns, "n_records")


def single_current(dim: DataFrame, key: str, current: str = "is_current") -> DataFrame:
    """Keys with more than one current version."""
    return _repeated(dim.filter(F.col(current)), [key], "current_version_count")


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{'_'.join(self.columns)}"


def _tests(model: str, counted: Sequence[tuple[Check, Column]]) -> Column:
    """One (test_name, model, violations) struct per check, from aggregates."""
    return F.array(
        *[
            F.struct(
                F.lit(check.name).alias("test_name"),
                F.lit(model).alias("model"),
                F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
            )
            for check, violations in counted
        ]
    )


def _null_pass(df: DataFrame, model: str, nulls: Sequence[Check]) -> DataFrame:
    """All NOT NULL tests of a model in a single scan without a key shuffle."""
    counted = [(c, F.count_if(F.col(c.columns[0]).isNull())) for c in nulls]
    return df.agg(_tests(model, counted).alias("tests")).select(F.inline("tests"))


def _key_pass(df: DataFrame, model: str, check: Check, nulls: Sequence[Check]) -> DataFrame:
    """A uniqueness test and NOT NULL tests in the same grouping: one scan, one shuffle of counts that were
    aggregated per task before. NULLs of a key column are counted from its groups, so a plain uniqueness test with
    such tests alone sends the counts of its keys and nothing else: models with the same keys of the same rows share
    that shuffle."""
    single = check.kind == SINGLE_CURRENT
    hits = F.count_if("is_current") if single else F.count(F.lit(1))
    inner = nulls if single else []
    groups = df.groupBy(*check.columns).agg(
        hits.alias("_hits"),
        *[F.count_if(F.col(c.columns[0]).isNull()).alias(f"_null_{c.columns[0]}") for c in inner],
    )
    repeated = F.col("_hits") > 1
    if check.kind == UNIQUE:
        repeated = repeated & F.col(check.columns[0]).isNotNull()
    counted = [
        (c, F.sum(f"_null_{c.columns[0]}" if c in inner else F.when(F.col(c.columns[0]).isNull(), F.col("_hits"))))
        for c in nulls
    ]
    counted.append((check, F.count_if(repeated)))
    return groups.agg(_tests(model, counted).alias("tests")).select(F.inline("tests"))


def report(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """test_name, model, violations, status ('pass' or 'fail') for every check.

    Violations are NULL rows for a NOT NULL test and repeated keys for the others. Each model is read once per
    uniqueness test, and once more if NOT NULL tests are left that do not go with one (a scan of those columns).
    """
    parts: list[DataFrame] = []
    for model, df in models.items():
        nulls = [c for c in checks if c.model == model and c.kind == NOT_NULL]
        keyed = [c for c in checks if c.model == model and c.kind != NOT_NULL]
        for check in keyed:
            if check.kind not in (UNIQUE, COMBINATION, SINGLE_CURRENT):
                raise ValueError(f"unknown check {check.kind!r}")
            inner = [c for c in nulls if check.kind == SINGLE_CURRENT or c.columns[0] in check.columns]
            parts.append(_key_pass(df, model, check, inner))
            nulls = [c for c in nulls if c not in inner]
        if nulls:
            parts.append(_null_pass(df, model, nulls))
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def freshness(
    tables: Mapping[str, DataFrame],
    loaded_at: str = "_ingested_at",
    *,
    as_of: Column | None = None,
    warn_after_hours: float | None = None,
    error_after_hours: float | None = None,
) -> DataFrame:
    """table_name, last_loaded_at, status per table. Without thresholds it reports and never fails."""
    parts = [
        df.agg(F.max(loaded_at).alias("last_loaded_at")).select(
            F.lit(name).alias("table_name"), "last_loaded_at"
        )
        for name, df in tables.items()
    ]
    loaded = reduce(DataFrame.unionByName, parts)
    return freshness_status(loaded, as_of=as_of, warn_after_hours=warn_after_hours, error_after_hours=error_after_hours)


def freshness_status(
    loaded: DataFrame,
    *,
    as_of: Column | None = None,
    warn_after_hours: float | None = None,
    error_after_hours: float | None = None,
) -> DataFrame:
    """The status of rows (table_name, last_loaded_at), wherever these come from."""
    last = F.col("last_loaded_at")
    now = F.current_timestamp() if as_of is None else as_of
    age = (F.unix_timestamp(now) - F.unix_timestamp(last)) / 3600
    status: Column | None = None
    for limit, label in ((error_after_hours, "error"), (warn_after_hours, "warn")):
        if limit is not None:
            late = last.isNull() | (age > limit)
            status = F.when(late, label) if status is None else status.when(late, label)
    status = F.lit("pass") if status is None else status.otherwise("pass")
    return loaded.withColumn("status", status)
