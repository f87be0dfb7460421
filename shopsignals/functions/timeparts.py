"""Calendar parts and cyclical encodings (session time zone must be UTC)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopsignals.functions.numeric import _col


def hour_of_day(ts) -> Column:
    return F.hour(_col(ts))


def day_of_week(ts) -> Column:
    """Monday = 0 … Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_col(ts))


def is_weekend(ts) -> Column:
    return day_of_week(ts).isin(5, 6)


def is_night(ts) -> Column:
    """22:00–23:59 or 00:00–04:59."""
    h = hour_of_day(ts)
    return h.between(22, 23) | h.between(0, 4)


def is_payday_window(ts) -> Column:
    """Days 1–3 or 14–16 of the month."""
    d = F.dayofmonth(_col(ts))
    return d.between(1, 3) | d.between(14, 16)


def cyclical_sin(x, period: int) -> Column:
    """sin(2π·x/period); evaluation order as (2π·x)/period."""
    return F.sin(F.lit(2 * math.pi) * _col(x) / F.lit(period))


def cyclical_cos(x, period: int) -> Column:
    return F.cos(F.lit(2 * math.pi) * _col(x) / F.lit(period))


def cyclical_encode(x, period: int) -> tuple[Column, Column]:
    return cyclical_sin(x, period), cyclical_cos(x, period)
