"""Number-to-text helpers that print like Python's format mini-language.

Python rounds the *exact* binary value half to even (``f"{0.35:.1f}"`` is
'0.3', ``f"{28.5:.0f}"`` is '28'); Java's ``%.1f`` rounds the shortest decimal
text half up ('0.4', '29').  ``format_fixed`` decides the rounding with an
exact product (Dekker's two-product), then prints an already rounded value,
so the text matches Python for every double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopsignals.functions.numeric import _col

_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp split constant for doubles


def _round_exact(x: Column, digits: int) -> Column:
    """Round x to ``digits`` decimals as the exact binary value, ties to even."""
    m = float(10 ** digits)
    p = x * F.lit(m)
    c = F.lit(_SPLIT) * x
    hi = c - (c - x)
    lo = x - hi
    err = (hi * F.lit(m) - p) + lo * F.lit(m)  # exact: x*m = p + err
    fl = F.floor(p)
    at_half = (p - fl) == F.lit(0.5)
    k = (
        F.when(at_half & (err > 0), fl + 1)
        .when(at_half & (err < 0), fl)
        .otherwise(F.rint(p))
    )
    return k / F.lit(m)


def format_fixed(x, digits: int) -> Column:
    """Python ``f"{x:.{digits}f}"``."""
    x = _col(x).cast("double")
    return F.format_string(f"%.{digits}f", _round_exact(x, digits))


def format_percent(x, digits: int) -> Column:
    """Python ``f"{x:.{digits}%}"``: x·100 in floating point, then fixed."""
    y = _col(x).cast("double") * F.lit(100.0)
    return F.concat(F.format_string(f"%.{digits}f", _round_exact(y, digits)), F.lit("%"))


def format_thousands(n) -> Column:
    """Python ``f"{n:,}"`` for integers."""
    return F.format_number(_col(n).cast("bigint"), 0)


def python_str(x) -> Column:
    """``str(v)`` of integers and doubles.

    Spark takes the E-notation below 1e-3 and from 1e7; Python does below 1e-4
    and from 1e16.  The digits are the JVM's: up to 15 significant ones they
    are Python's, beyond that JVMs before 19 may print one more than needed.
    """
    col = _col(x)
    s = col.cast("string")
    exponent = F.coalesce(F.regexp_extract(s, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
    mantissa = F.regexp_replace(F.regexp_replace(s, r"E-?\d+$", ""), r"\.0$", "")
    power = F.format_string("%02d", F.abs(exponent))
    scientific = F.concat(mantissa, F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")), power)
    # plain digits: the shortest digits fit a decimal between the two limits
    digits = F.regexp_replace(s.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return (
        F.when(s == "NaN", F.lit("nan"))
        .when(s.endswith("Infinity"), F.regexp_replace(s, "Infinity", "inf"))
        .when(~s.contains("E"), s)
        .when((exponent >= 16) | (exponent < -4), scientific)
        .otherwise(plain)
    )
