"""Running totals and selection by position, without a single-partition window.

``sum(x) over (partition by g order by v)`` sorts each group ``g`` in one
task; for a KS statistic or a ROC sweep the group is a whole feature or the
whole score table.  Here the input is evaluated once, dealt by ranges of
(group, value) and written (``ranged``), so a large group lies in several
parts and parts follow each other in order:

1. a local running sum is taken per (group, part);
2. the totals of the parts (one row per part and group in it) get an exclusive
   running sum per group;
3. an equi-join on (group, part) adds the offset to the local sums.

Range borders come from a sample; they only decide how even the parts are, the
totals do not depend on them.  The input must have one row per (group, value)
or a complete order by ``tiebreak_cols``, so the result is deterministic.

``value_at`` finds the value at a position by histograms: counts per block of an
order-preserving cut of the value, held on the driver, choose the block with
the position; a block with many rows is cut again between its own smallest and
largest value; the last few rows are sorted.  The value returns as a plain
Python value, so a split by it is a plain filter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.session import materialize

#: blocks per doubling of |value|: at most about 35,000 counts reach the driver
DEFAULT_RESOLUTION = 8
_EXP_OFFSET = 1100  # covers log2 of every finite non-zero double
#: rows of a block that are sorted instead of being cut again
TARGET_ROWS = 100_000
#: equal steps into which a block is cut
STEPS = 4096


def ranged(df: DataFrame, group_cols: Sequence[str], order_col: str, descending: bool = False, tiebreak_cols: Sequence[str] = ()) -> DataFrame:
    """The rows with a value, written once in ranges of (group, value); ``_part`` numbers the ranges in order."""
    by = [*[F.col(c).asc() for c in group_cols], *_order(order_col, descending, tiebreak_cols)]
    dealt = df.where(F.col(order_col).isNotNull()).repartitionByRange(*by)
    return materialize(dealt.withColumn("_part", F.spark_partition_id()))


def _order(order_col: str, descending: bool, tiebreak_cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in (order_col, *tiebreak_cols)]


def totals_in_order(
    table: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    prefix: str = "cum_",
    tiebreak_cols: Sequence[str] = (),
) -> DataFrame:
    """Running totals of a ``ranged`` table (of the same columns and direction)."""
    keys = [*group_cols, "_part"]
    local_w = Window.partitionBy(*keys).orderBy(*_order(order_col, descending, tiebreak_cols)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = table.select("*", *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in sum_cols])

    parts_w = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy(*keys)
        .agg(*[F.sum(c).alias(f"_bt_{c}") for c in sum_cols])
        .select(*[F.col(c).alias(f"_k_{c}") for c in keys], *[F.coalesce(F.sum(f"_bt_{c}").over(parts_w), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    )
    # offsets has one row per part and group; AQE broadcasts it when it is
    # small at run time, otherwise it is a shuffle join
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    out = d.join(offsets, on, "inner")
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_loc_{c}") + F.col(f"_off_{c}"))
    return out.drop("_part", *[f"_k_{c}" for c in keys], *[f"_loc_{c}" for c in sum_cols], *[f"_off_{c}" for c in sum_cols])


def running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    prefix: str = "cum_",
    tiebreak_cols: Sequence[str] = (),
) -> DataFrame:
    """Adds ``cum_<c>`` = sum of ``c`` over rows of the group with order value
    <= (or >= when ``descending``) the row's, inclusive.  ``tiebreak_cols``
    complete the order when ``order_col`` is not unique within a group.  Rows
    without an order value are left out."""
    table = ranged(df, group_cols, order_col, descending, tiebreak_cols)
    return totals_in_order(table, group_cols, order_col, sum_cols, descending, prefix, tiebreak_cols)


def global_rank(df: DataFrame, order_col: str, out_col: str = "row_pos") -> DataFrame:
    """1-based position of each row when sorted by a unique ``order_col``."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(ones, [], order_col, ["_one"], prefix="_cum").withColumnRenamed("_cum_one", out_col).drop("_one")


# ---------------------------------------------------------------- selection


def order_block(value, resolution: int = DEFAULT_RESOLUTION) -> Column:
    """Monotone non-decreasing block id of a double (NaN last, null stays null):
    ``sign(v) * (floor(log2|v| * resolution) + offset)``, 0 for 0."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    mag = F.floor(F.log2(F.abs(v)) * F.lit(resolution)) + F.lit(_EXP_OFFSET * resolution + 1)
    return (
        F.when(v.isNull(), F.lit(None).cast("long"))
        .when(F.isnan(v), F.lit(4 * _EXP_OFFSET * resolution))
        .when(v == 0, F.lit(0))
        .when(v > 0, mag)
        .otherwise(-mag)
        .cast("long")
    )


def _block_holding(df: DataFrame, block: Column, col: str, position: int | Callable[[int], int]):
    """(position inside the block, smallest, largest value, rows) of the block that holds a position."""
    counts = df.groupBy(block.alias("_blk")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    rows = sorted(counts.collect(), key=lambda r: r["_blk"])
    k = position(sum(r["n"] for r in rows)) if callable(position) else position
    if k < 1:
        return None
    for r in rows:
        if k <= r["n"]:
            return k, r["lo"], r["hi"], r["n"]
        k -= r["n"]
    return None


def value_at(df: DataFrame, col: str, position: int | Callable[[int], int], target: int = TARGET_ROWS):
    """The value at a position (from 1, ascending, nulls left out) of a numeric column; None outside 1 to the rows.

    ``position`` may be a function of the number of rows.  Jobs: one histogram,
    one more per 4096-fold excess of the block over ``target`` rows, one sort of
    the rows left.
    """
    df = df.select(col).where(F.col(col).isNotNull())
    found = _block_holding(df, order_block(col), col, position)
    while found is not None:
        k, lo, hi, rows = found
        if lo == hi:
            return lo
        inside = df.where(F.col(col).between(lo, hi))
        width = float(hi) - float(lo)
        if rows <= target or not 0 < width < math.inf:
            return inside.orderBy(col).offset(k - 1).limit(1).head()[0]
        step = F.floor((F.col(col).cast("double") - F.lit(float(lo))) / F.lit(width) * F.lit(float(STEPS)))
        found = _block_holding(inside, F.least(step, F.lit(STEPS - 1)), col, k)
    return None
