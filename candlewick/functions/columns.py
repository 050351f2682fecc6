"""Column expressions. All of them stay in whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


# The days a market record can plausibly carry: the years 1900 to 2199.
FIRST_MS = -2_208_988_800_000
LAST_MS = 7_258_118_399_999


def epoch_ms_to_date(ms: Column) -> Column:
    """UTC calendar day of an epoch-millisecond value, whatever the session time zone is.

    NULL outside the years 1900 to 2199, which is where a value in micro- or nanoseconds lands: a wrong unit
    becomes a missing key, and neither stops a load nor stretches the calendar.
    """
    whole_days = F.call_function("div", ms - F.pmod(ms, F.lit(DAY_MS)), F.lit(DAY_MS))
    return F.when(ms.between(FIRST_MS, LAST_MS), F.date_from_unix_date(whole_days.cast("int")))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL, never an ANSI error, for a NULL or zero denominator."""
    return F.when(denominator.isNotNull() & (denominator != 0), numerator / denominator)


def null_or(tested: Column, flag: Column) -> Column:
    """Three-valued flag: NULL while ``tested`` is NULL."""
    return F.when(tested.isNotNull(), flag)


def above_baseline(value: Column, baseline: Column, factor: float) -> Column:
    return F.when(baseline.isNotNull() & (baseline != 0), value >= F.lit(factor) * baseline)


def trend_label(fast: Column, slow: Column, band: float) -> Column:
    """Position of the fast average against a band around the slow one; the band edges are sideways."""
    return (
        F.when(slow.isNull(), F.lit(None).cast("string"))
        .when(fast > slow * F.lit(1 + band), F.lit("uptrend"))
        .when(fast < slow * F.lit(1 - band), F.lit("downtrend"))
        .otherwise(F.lit("sideways"))
    )


_SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.-]*:(?://([^/]*))?)?"


def relative_path(path: Column, root: str) -> Column:
    """``path`` below ``root``, without leading slashes.

    Both may carry a scheme and authority (``file:///a/b``, ``dbfs:/a/b``, ``/a/b`` name the same
    folder), and ``root`` may end in slashes. Where both name an authority (a bucket, a host), it must be
    the same. NULL when the path is not below the root, so that a folder whose name merely starts
    alike cannot pass for it.
    """
    scheme = re.match(f"^{_SCHEME}", root)
    bare_root = root[scheme.end() :].rstrip("/")
    authority = scheme.group(1)
    same = rf"(?://(?:\Q{authority}\E)?(?=/))?" if authority else "(?://[^/]*)?"
    below = rf"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:{same})?\Q{bare_root}\E/+(.+)$"
    return F.nullif(F.regexp_extract(path, below, 1), F.lit(""))
