"""Numeric column helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """Round as numpy/pandas ``round`` does: scale, round half to even, unscale.

    ``F.bround`` rounds the shortest decimal text of the double, which differs
    from numpy on values such as 3/20000; ``rint`` on the scaled binary value
    does not.  DuckDB's ``round_even`` gives the same results.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def round_half_up(c, digits: int) -> Column:
    """SQL ``ROUND`` (ties away from zero), as in the warehouse reports."""
    return F.round(_col(c), digits)


EXACT_SCALE = 12


def exact_sum(c, scale: int = EXACT_SCALE) -> Column:
    """Sum as a decimal: exact, so independent of summation order (a double
    sum's last bits depend on partitioning and retries)."""
    return F.sum(_col(c).cast(f"decimal(38,{scale})"))


def exact_avg(c, scale: int = EXACT_SCALE) -> Column:
    """Mean = (decimal sum of the values at ``scale`` decimals, as the nearest double) / count.

    NaN counts as missing, in the sum and in the count.  Order-independent, so
    a mean that lands on a rounding tie rounds the same way on every engine,
    partitioning and retry; values with more than ``scale`` decimals are
    rounded to that scale first."""
    value = _col(c).cast("double")
    value = F.when(~F.isnan(value), value)
    return exact_sum(value, scale).cast("double") / F.count(value)


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num / den; ``default`` when den is 0 or null (pandas replace(0, nan) + fillna)."""
    return F.coalesce(F.try_divide(_col(num).cast("double"), _col(den)), F.lit(default))


def micros(ts) -> Column:
    return F.unix_micros(_col(ts))


def seconds_between(start, end) -> Column:
    """Elapsed seconds as a double (micros / 1e6, like Timedelta.total_seconds)."""
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_SECOND))


def micros_between(start, end) -> Column:
    return micros(end) - micros(start)


def minutes_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def days_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(86400.0)


def relative_shift_pct(before, after) -> Column:
    """|after - before| / (|before| + 1e-10) * 100."""
    return F.abs(_col(after) - _col(before)) / (F.abs(_col(before)) + F.lit(1e-10)) * F.lit(100.0)
