"""Distribution-shift report between a baseline and a current table.

Per feature: two-sample Kolmogorov–Smirnov statistic and p-value, means and
relative mean shift; then a dataset verdict, an alert list and histogram
overlays.  Both inputs are whole DataFrames (no sampling needed); the
statistic is computed from counts per distinct (feature, value), written once
in order, with the running totals of ``operators.running``.

p-value, at every sample size: the asymptotic Kolmogorov series
2·Σ(−1)^(k−1)·exp(−2k²λ²), λ = D·sqrt(n·m/(n+m)), 100 terms, as one column
expression; 1 for λ < 0.2 (where the truncated series is not meaningful).
Missing feature values count as 0, as in the feature table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.functions.numeric import exact_sum, relative_shift_pct, round_half_even
from shopsignals.operators.running import ranged, totals_in_order, value_at

# Monitored features, test level, series length, overlay shape.
MONITOR_FEATURES = [
    "recency_days",
    "total_sessions",
    "sessions_per_week",
    "total_revenue",
    "avg_session_revenue",
    "avg_events_per_session",
    "avg_duration_min",
    "total_views",
    "total_cart_adds",
    "total_purchases",
    "cart_abandonment_rate",
    "purchase_conversion_rate",
    "weekend_activity_ratio",
    "night_owl_score",
    "payday_activity_ratio",
    "activity_trend",
    "category_diversity",
    "brand_loyalty_score",
]
DEFAULT_ALPHA = 0.05
KS_SERIES_TERMS = 100
KS_SMALL_LAMBDA = 0.2
OVERLAY_EDGES = 40
OVERLAY_TOP = 6


def available_features(df: DataFrame, features: Sequence[str] = MONITOR_FEATURES) -> list[str]:
    cols = set(df.columns)
    return [f for f in features if f in cols]


def stack_sides(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, side) rows; null and NaN count as 0; ``side`` 0 = baseline."""
    def long(df, side):
        return (
            df.select(*[F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features])
            .unpivot([], list(features), "feature", "value")
            .withColumn("side", F.lit(side))
        )

    return long(baseline, 0).unionByName(long(current, 1))


def ks_pvalue(d, n, m):
    """Asymptotic two-sided p-value from D and the two sample sizes."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))
    return F.when(lam < F.lit(KS_SMALL_LAMBDA), F.lit(1.0)).otherwise(p)


def side_counts(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per distinct (feature, value) and side, with exact sums of the values.

    Both tables are evaluated once; the counts are written in ranges of
    (feature, value), and statistic, means and histograms all start from them.
    """
    stacked = stack_sides(baseline, current, features)
    is_ref, is_cur = F.col("side") == 0, F.col("side") == 1
    count = lambda side: F.sum(F.when(side, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    counts = stacked.groupBy("feature", "value").agg(
        count(is_ref).alias("n_ref"), count(is_cur).alias("n_cur"),
        exact_sum(F.when(is_ref, F.col("value"))).alias("sum_ref"), exact_sum(F.when(is_cur, F.col("value"))).alias("sum_cur"),
    )
    return ranged(counts, ["feature"], "value")


def ks_details(
    baseline: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """One row per feature: KS statistic, p-value, decision, means, mean shift."""
    features = list(features) if features is not None else available_features(baseline)
    return ks_from_counts(side_counts(baseline, current, features), features, alpha)


def ks_from_counts(counts: DataFrame, features: Sequence[str], alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """``ks_details`` of ``side_counts``."""
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("total_ref"),
        F.sum("n_cur").alias("total_cur"),
        F.try_divide(F.sum("sum_ref").cast("double"), F.sum("n_ref")).alias("ref_mean_raw"),
        F.try_divide(F.sum("sum_cur").cast("double"), F.sum("n_cur")).alias("cur_mean_raw"),
    )
    cum = totals_in_order(counts, ["feature"], "value", ["n_ref", "n_cur"])
    # totals has one row per feature: a proven, tiny broadcast
    gaps = cum.join(F.broadcast(totals.select("feature", "total_ref", "total_cur")), "feature").select(
        "feature",
        F.abs(
            F.try_divide(F.col("cum_n_ref"), F.col("total_ref")) - F.try_divide(F.col("cum_n_cur"), F.col("total_cur"))
        ).alias("gap"),
    )
    ks = gaps.groupBy("feature").agg(F.max("gap").alias("ks_raw"))
    out = totals.filter((F.col("total_ref") > 0) & (F.col("total_cur") > 0)).join(ks, "feature")
    p = ks_pvalue(F.col("ks_raw"), F.col("total_ref").cast("double"), F.col("total_cur").cast("double"))
    order = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    return out.select(
        "feature",
        order.alias("feature_order"),
        round_half_even("ks_raw", 4).alias("ks_statistic"),
        round_half_even(p, 6).alias("p_value"),
        (p < F.lit(alpha)).alias("shift_detected"),
        round_half_even("ref_mean_raw", 4).alias("ref_mean"),
        round_half_even("cur_mean_raw", 4).alias("cur_mean"),
        round_half_even(relative_shift_pct("ref_mean_raw", "cur_mean_raw"), 2).alias("mean_shift_pct"),
        F.col("total_ref").alias("n_ref"),
        F.col("total_cur").alias("n_cur"),
    )


def shift_verdict(details: DataFrame, alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """One row: share of shifted features, decision (> 0.5), counts, name lists.

    ``details`` has one row per feature, so the name lists are bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("feature_order", "feature", "shift_detected")))
    return details.agg(ordered.alias("_f")).select(
        (F.size(F.filter("_f", lambda r: r["shift_detected"])) / F.greatest(F.size("_f"), F.lit(1))).alias("_share"),
        F.size(F.filter("_f", lambda r: r["shift_detected"])).cast("long").alias("n_shifted_features"),
        F.size(F.filter("_f", lambda r: ~r["shift_detected"])).cast("long").alias("n_stable_features"),
        F.size("_f").cast("long").alias("n_total_features"),
        F.transform(F.filter("_f", lambda r: r["shift_detected"]), lambda r: r["feature"]).alias("shifted_features"),
        F.transform(F.filter("_f", lambda r: ~r["shift_detected"]), lambda r: r["feature"]).alias("stable_features"),
    ).select(
        (F.col("_share") > F.lit(0.5)).alias("dataset_shift_detected"),
        round_half_even("_share", 4).alias("shift_share"),
        "n_shifted_features",
        "n_stable_features",
        "n_total_features",
        "shifted_features",
        "stable_features",
        F.lit(alpha).alias("alpha"),
        F.lit("Kolmogorov-Smirnov").alias("test"),
    )


def shift_alerts(details: DataFrame) -> DataFrame:
    """Shifted features, largest KS first."""
    return details.filter("shift_detected").select(
        "feature", "ks_statistic", "p_value", "mean_shift_pct"
    ).orderBy(F.desc("ks_statistic"), "feature")


def top_shifted(details: DataFrame, n: int = OVERLAY_TOP) -> DataFrame:
    return details.orderBy(F.desc("ks_statistic"), "feature_order").limit(n).select("feature")


def distribution_overlay(
    baseline: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    n_edges: int = OVERLAY_EDGES,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Density histograms of both sides on shared equal-width bins.

    Bins as ``numpy.histogram`` with ``linspace(lo, hi, n_edges)`` edges over
    the joint range (last bin closed).  Output: feature, bin, lower, upper,
    baseline_density, current_density (bins without rows are omitted).
    ``wanted`` (a few feature names) limits the rows before they are binned.
    """
    return overlay_from_counts(side_counts(baseline, current, features), n_edges, wanted)


def overlay_from_counts(counts: DataFrame, n_edges: int = OVERLAY_EDGES, wanted: DataFrame | None = None) -> DataFrame:
    """``distribution_overlay`` of ``side_counts``."""
    nb = n_edges - 1
    if wanted is not None:
        counts = counts.join(F.broadcast(wanted), "feature", "left_semi")
    rng = counts.groupBy("feature").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.sum("n_ref").alias("n0"),
        F.sum("n_cur").alias("n1"),
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(nb))

    def edge(i):
        return F.when(i >= F.lit(nb), F.col("hi")).otherwise(F.col("lo") + i * step)

    v = counts.join(F.broadcast(rng), "feature")  # one row per feature
    raw = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(nb))).cast("int")
    idx0 = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(raw, F.lit(nb - 1)))
    v = v.withColumn("_i", idx0)
    v = v.withColumn("_i", F.when(F.col("value") < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    v = v.withColumn(
        "_i",
        F.when((F.col("value") >= edge(F.col("_i") + 1)) & (F.col("_i") != nb - 1), F.col("_i") + 1).otherwise(F.col("_i")),
    )
    bins = v.groupBy("feature", "_i", "lo", "hi", "n0", "n1").agg(F.sum("n_ref").alias("c0"), F.sum("n_cur").alias("c1"))
    width = edge(F.col("_i") + 1) - edge(F.col("_i"))
    return bins.select(
        "feature",
        F.col("_i").alias("bin"),
        edge(F.col("_i")).alias("lower"),
        edge(F.col("_i") + 1).alias("upper"),
        # a constant feature has zero-width bins: density is undefined (null)
        F.try_divide(F.try_divide(F.col("c0"), width), F.col("n0")).alias("baseline_density"),
        F.try_divide(F.try_divide(F.col("c1"), width), F.col("n1")).alias("current_density"),
    )


def positional_split(df: DataFrame, order_col: str = "user_id", fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First ``fraction`` of rows by ``order_col`` vs the rest (order_col unique).

    The key of the last baseline row is found by ``value_at`` (two or three
    small jobs), the cut is ``int(n * fraction)`` as in slicing, and both sides
    are plain filters of the input.
    """
    cut = value_at(df, order_col, lambda n: math.floor(n * fraction))
    if cut is None:
        return df.filter(F.lit(False)), df
    key = F.col(order_col)
    return df.filter(key <= F.lit(cut)), df.filter((key > F.lit(cut)) | key.isNull())


def hash_sample(df: DataFrame, n: int, seed: int = 42, key: str = "user_id") -> DataFrame:
    """Fixed-size, repeatable sample without replacement: the ``n`` rows with
    the smallest ``md5('<key>-<seed>')``; a top-k, so each task keeps at most
    ``n`` rows before the merge."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
