"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exit types that end a session early, tiers by price.
ABNORMAL_EXITS = ("crash", "disconnect", "timeout")
TIER_ORDER = ("free", "priority", "ultimate")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(day: dt.date) -> Column:
    """Midnight of ``day`` as a zone-less timestamp literal."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def ts_within(ts: Column | str, window: tuple[dt.date, dt.date]) -> Column:
    """Half-open date window on a timestamp, in the form the Parquet scan can push."""
    ts = as_col(ts)
    return (ts >= ntz(window[0])) & (ts < ntz(window[1]))


def date_within(day: Column | str, window: tuple[dt.date, dt.date]) -> Column:
    day = as_col(day)
    return (day >= F.lit(window[0])) & (day < F.lit(window[1]))


def days_from(start: dt.date, day: Column | str) -> Column:
    return F.datediff(as_col(day), F.lit(start))


def period_index(start: dt.date, day: Column | str, period_days: int) -> Column:
    """1-based period of ``day`` counted from ``start``; 0 and below before it."""
    return (F.floor(days_from(start, day) / F.lit(period_days)) + 1).cast("int")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Difference of the whole seconds of two timestamps."""
    return F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den``; null where the denominator is null or 0."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def share(hits: Column | str, total: Column | str) -> Column:
    return safe_ratio(hits, total)


def relative_change(new: Column | str, old: Column | str) -> Column:
    return safe_ratio(as_col(new) - as_col(old), old)


def sample_std(n: Column | str, total: Column | str, squares: Column | str) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    The inputs are whole numbers (seconds), and ``n * squares - total**2`` is taken in
    decimals, so nothing cancels: exact while sums of squares stay below 2**53, some
    690 million sessions of an hour in a group.
    """
    n, total, squares = (as_col(c).cast("decimal(19,0)") for c in (n, total, squares))
    spread = F.greatest((n * squares - total * total).cast("double"), F.lit(0.0))
    n = n.cast("double")
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1))))


def square(c: Column | str) -> Column:
    c = as_col(c).cast("double")
    return c * c


def is_peak_hour(ts: Column | str) -> Column:
    return F.hour(as_col(ts)).between(19, 23)


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(as_col(ts)).isin(1, 7)


def is_abnormal_exit(exit_type: Column | str) -> Column:
    return as_col(exit_type).isin(*ABNORMAL_EXITS)


def tier_rank(tier: Column | str) -> Column:
    """Position of the tier in the price order; null for any other value."""
    return (F.nullif(F.array_position(F.array(*map(F.lit, TIER_ORDER)), as_col(tier)), F.lit(0)) - 1).cast("int")
