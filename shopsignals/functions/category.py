"""Category path helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopsignals.functions.numeric import _col

UNKNOWN_CATEGORY = "unknown"


def top_category(category_code) -> Column:
    """First part of a dot path; null → 'unknown'; no dot → unchanged."""
    return F.coalesce(F.split_part(_col(category_code), F.lit("."), F.lit(1)), F.lit(UNKNOWN_CATEGORY))


def entropy_term(p) -> Column:
    """-p·log2(p + 1e-10), one term of the Shannon entropy of shares."""
    return -_col(p) * F.log2(_col(p) + F.lit(1e-10))
