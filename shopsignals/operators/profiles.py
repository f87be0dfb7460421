"""Group profiles and dataset statistics: cluster profiles and sizes, class
balance, dataset means, summary statistics with exact quartiles, mean
absolute attributions, stratified split and hash sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.functions import rules
from shopsignals.functions.numeric import exact_avg, exact_sum, round_half_even
from shopsignals.operators.running import ranged, totals_in_order, value_at
from shopsignals.session import materialize

# Behavioural signals used for clustering (not the label).
CLUSTER_FEATURES = [
    "recency_days",
    "total_sessions",
    "sessions_per_week",
    "avg_events_per_session",
    "avg_duration_min",
    "cart_abandonment_rate",
    "purchase_conversion_rate",
    "weekend_activity_ratio",
    "night_owl_score",
    "payday_activity_ratio",
    "activity_trend",
    "category_diversity",
    "brand_loyalty_score",
    "avg_price_point",
]
MIN_SESSIONS_FOR_CLUSTERING = 2
NOISE_CLUSTER = -1


def clustering_input(features: DataFrame, feature_cols: Sequence[str] = CLUSTER_FEATURES) -> tuple[DataFrame, list[str], list[str]]:
    """Users with >= 2 sessions, the available clustering columns (missing
    ones reported), nulls filled with 0."""
    available = [c for c in feature_cols if c in features.columns]
    missing = [c for c in feature_cols if c not in features.columns]
    df = features.filter(F.col("total_sessions") >= MIN_SESSIONS_FOR_CLUSTERING).fillna(0, subset=available)
    return df, available, missing


def rule_cluster_id() -> F.Column:
    """Cluster id of the rule-based archetype (names → ids of the name table)."""
    name_to_id = {v: k for k, v in rules.ARCHETYPE_NAMES.items()}
    pairs = []
    for k, v in name_to_id.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[rules.rule_archetype()]


def cluster_profiles(
    df: DataFrame,
    cluster_col: str = "cluster",
    feature_cols: Sequence[str] = CLUSTER_FEATURES,
    label_col: str = "churned",
    archetype_col: str | None = None,
) -> DataFrame:
    """One row per cluster: archetype, users, % of all (1 dp), feature means
    (4 dp), churn rate (4 dp).  The share uses a window over the cluster rows
    only (one row per cluster)."""
    feats = [c for c in feature_cols if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("user_count")]
    aggs += [exact_avg(c).alias(c) for c in feats]
    if label_col in df.columns:
        aggs.append(F.avg(label_col).alias("churn_rate"))
    keys = [cluster_col] + ([archetype_col] if archetype_col else [])
    g = df.groupBy(*keys).agg(*aggs)
    share = F.col("user_count") / F.sum("user_count").over(Window.partitionBy()) * F.lit(100.0)
    name = F.col(archetype_col) if archetype_col else rules.archetype_name(F.col(cluster_col))
    cols = [
        F.col(cluster_col).alias("cluster"),
        name.alias("archetype"),
        "user_count",
        round_half_even(share, 1).alias("pct_of_sample"),
        *[round_half_even(c, 4).alias(c) for c in feats],
    ]
    if label_col in df.columns:
        cols.append(round_half_even("churn_rate", 4).alias("churn_rate"))
    else:
        cols.append(F.lit(None).cast("double").alias("churn_rate"))
    return g.select(*cols)


def cluster_sizes(df: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Users per cluster, share of all, and the noise share on every row."""
    g = df.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.lit(1)).alias("users"))
    all_w = Window.partitionBy()  # one row per cluster
    total = F.sum("users").over(all_w)
    noise = F.sum(F.when(F.col("cluster") == NOISE_CLUSTER, F.col("users")).otherwise(0)).over(all_w)
    return g.select(
        "cluster",
        "users",
        round_half_even(F.col("users") / total, 4).alias("share"),
        round_half_even(noise / total, 4).alias("noise_share"),
    )


def class_balance(df: DataFrame, label_col: str = "churned") -> DataFrame:
    """Negatives, positives and the positive-class weight neg/pos."""
    return df.agg(
        F.count(F.when(F.col(label_col) == 0, 1)).alias("negatives"),
        F.count(F.when(F.col(label_col) == 1, 1)).alias("positives"),
    ).withColumn("scale_pos_weight", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def with_class_weight(df: DataFrame, label_col: str = "churned", weight_col: str = "weight") -> DataFrame:
    """Row weight: neg/pos for positives, 1 for negatives (a scalar sub-query)."""
    ratio = class_balance(df, label_col).select("scale_pos_weight").scalar()
    w = F.when(F.col(label_col) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0))
    return df.withColumn(weight_col, w)


def dataset_means(df: DataFrame, label_col: str = "churned") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("users"), round_half_even(F.avg(label_col), 4).alias("churn_rate"))


def _lerp(a, b, t):
    """numpy's linear interpolation (two forms split at t = 0.5)."""
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def describe(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, exact quartiles (linear), max per column.

    The input is evaluated once, into counts per distinct value written in
    order; all figures come from them, so no column's values are gathered into
    one task.
    """
    long = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .filter(F.col("value").isNotNull())
    )
    counts = ranged(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.when(~F.isnan("value"), F.col("value"))).alias("s")), ["feature"], "value")
    numbers = F.sum(F.when(F.isnan("value"), F.lit(0)).otherwise(F.col("n")))
    stats = counts.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.try_divide(F.sum("s").cast("double"), numbers).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # one row per column
    cum = totals_in_order(counts, ["feature"], "value", ["n"]).join(F.broadcast(stats.select("feature", "count", "mean")), "feature")
    aggs = []
    for i, q in enumerate(probs):
        pos = F.lit(q) * (F.col("count") - 1)
        lo_i = F.floor(pos)
        aggs.append(F.min(F.when(F.col("cum_n") >= lo_i + 1, F.col("value"))).alias(f"_lo_{i}"))
        aggs.append(F.min(F.when(F.col("cum_n") >= F.least(lo_i + 2, F.col("count")), F.col("value"))).alias(f"_hi_{i}"))
        aggs.append(F.first(pos - lo_i).alias(f"_t_{i}"))
    squares = F.sum(F.col("n") * (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean")))
    qs = cum.groupBy("feature").agg(F.sqrt(F.try_divide(squares, F.first("count") - 1)).alias("std"), *aggs)
    out = stats.join(qs, "feature")
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    return out.select(
        "feature", "count", "mean", "std", "min",
        *[_lerp(F.col(f"_lo_{i}"), F.col(f"_hi_{i}"), F.col(f"_t_{i}")).alias(names.get(q, f"p{int(q * 100)}")) for i, q in enumerate(probs)],
        "max",
    )


def mean_abs_attribution(attributions: DataFrame, exclude: Sequence[str] = ("churn_proba", "user_id", "margin", "base_margin"), top: int | None = None) -> DataFrame:
    """Mean |attribution| per feature, long form, largest first (top-k optional)."""
    cols = [c for c in attributions.columns if c not in exclude]
    wide = attributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "mean_abs_attribution").orderBy(F.desc("mean_abs_attribution"), "feature")
    return long.limit(top) if top else long


def stratified_split(
    df: DataFrame, label_col: str = "churned", train_fraction: float = 0.8, seed: int = 42, key: str = "user_id"
) -> DataFrame:
    """Adds ``is_test``: per label, rows ranked by ``xxhash64(key, seed)`` (key
    breaks ties); the first ``floor(n_label · train_fraction)`` are training
    rows.  Exact per-label counts, repeatable.

    Only labels, hashes and keys are written and searched for the last training
    row of each label (``value_at``); the table itself gets the flag by a plain
    projection, without a shuffle or join of its columns.  The number of labels
    is that of the classes; rows without a label are training rows.
    """
    hashed = F.xxhash64(F.col(key), F.lit(seed))
    slim = materialize(df.select(F.col(label_col).alias("label"), hashed.alias("h"), F.col(key).alias("k")))
    is_test = F.lit(False)
    for label, rows in sorted(tuple(r) for r in slim.where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1))).collect()):
        own, last = slim.where(F.col("label") == F.lit(label)), math.floor(rows * train_fraction)
        cut = value_at(own, "h", last)
        if cut is None:  # no training row
            behind = F.lit(True)
        else:
            ties = own.where(F.col("h") == F.lit(cut))
            tied, before = ties.count(), own.where(F.col("h") < F.lit(cut)).count()
            last_key = None if tied == 1 else ties.orderBy("k").offset(last - before - 1).limit(1).head()["k"]
            behind = hashed > F.lit(cut)
            if last_key is not None:
                behind = behind | ((hashed == F.lit(cut)) & (F.col(key) > F.lit(last_key)))
        is_test = F.when(F.col(label_col) == F.lit(label), behind).otherwise(is_test)
    return df.withColumn("is_test", is_test)
