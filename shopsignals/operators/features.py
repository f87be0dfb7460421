"""User feature families: sessions, time habits, categories and brands.

Input: an event table (``event_time, event_type, product_id, category_id,
category_code, brand, price, user_id, user_session``).  Output: one row per
user.  Every family is a fixed, static plan:

* global time bounds are one tiny aggregate, used as scalar sub-queries;
* per-session work is one ``groupBy(user_id, user_session)``;
* everything per user is a single ``groupBy(user_id)`` of conditional
  aggregates (no per-category loop, no outer joins of Series);
* entropy and brand loyalty are two-level aggregates: counts per
  (user, category) / (user, brand) first, then per user.

All aggregates are algebraic or bounded (``mode`` keeps one counter per
distinct hour / weekday / category), so Spark combines them map-side before
the shuffle and a very active user does not become one huge task.

Null keys: rows without ``user_id`` never form a user, but they do count in
the global time bounds; rows without ``user_session`` are left out of the
session statistics but count for the last purchase, as in the definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.functions.category import entropy_term, top_category
from shopsignals.functions.numeric import (
    MICROS_PER_DAY,
    exact_avg,
    exact_sum,
    micros,
    micros_between,
    round_half_even,
    safe_ratio,
)
from shopsignals.functions.timeparts import (
    cyclical_cos,
    cyclical_sin,
    day_of_week,
    hour_of_day,
    is_night,
    is_payday_window,
    is_weekend,
)

# Output column order of each family.
SESSION_FEATURES = [
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
]
TEMPORAL_FEATURES = [
    "weekend_activity_ratio",
    "night_owl_score",
    "payday_activity_ratio",
    "activity_trend",
    "preferred_hour_sin",
    "preferred_hour_cos",
    "preferred_day_sin",
    "preferred_day_cos",
]
#: affinity categories of the production catalogue
DEFAULT_AFFINITY_CATEGORIES = ["electronics", "apparel", "appliances", "furniture", "sport", "kids", "auto"]
DEFAULT_HORIZON_DAYS = 14

LABEL = "churned"


def _is(event_type: str):
    return F.col("event_type") == F.lit(event_type)


def _count_if(cond):
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _exact_mean(c):
    """Mean from an exact sum: a mean on a rounding tie rounds the same way whatever the grouping."""
    return F.try_divide(exact_sum(c).cast("double"), F.count(c))


def time_bounds(events: DataFrame) -> DataFrame:
    """One row: first and last event time over *all* rows, as epoch micros.

    Every branch uses exactly this projection, so Spark computes it once and
    reuses the broadcast.
    """
    return events.agg(micros(F.min("event_time")).alias("t_min_us"), micros(F.max("event_time")).alias("t_max_us"))


def with_bounds(df: DataFrame, bounds: DataFrame | tuple[int, int]) -> DataFrame:
    """Attach the global bounds: known values, or scalar sub-queries (computed
    once per query; Spark merges the two into one aggregate over the events)."""
    if isinstance(bounds, tuple):
        return df.withColumns({"t_min_us": F.lit(bounds[0]).cast("long"), "t_max_us": F.lit(bounds[1]).cast("long")})
    return df.withColumns(
        {"t_min_us": bounds.select("t_min_us").scalar(), "t_max_us": bounds.select("t_max_us").scalar()}
    )


# ------------------------------------------------------------------ sessions

def session_aggregate(events: DataFrame) -> DataFrame:
    """Per (user, session): span, event counts, purchase revenue, last purchase.

    ``total_events`` counts non-null event types.  Null sessions stay as their
    own group here (they feed the last-purchase time only).  Revenue is an
    exact decimal sum and the duration integer microseconds, so the user
    roll-up does not depend on summation order.
    """
    purchase = _is("purchase")
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "user_session")
        .agg(
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.count("event_type").alias("total_events"),
            _count_if(_is("view")).alias("views"),
            _count_if(_is("cart")).alias("cart_adds"),
            _count_if(purchase).alias("purchases"),
            F.coalesce(exact_sum(F.when(purchase, F.col("price"))), F.lit(0).cast("decimal(38,12)")).alias(
                "session_revenue"
            ),
            F.max(F.when(purchase, F.col("event_time"))).alias("last_purchase_time"),
        )
        .withColumn("duration_us", F.greatest(micros_between("session_start", "session_end"), F.lit(0)))
    )


def session_features(
    events: DataFrame,
    horizon_days: float = DEFAULT_HORIZON_DAYS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Recency, frequency, money, depth, cart abandonment, conversion, label."""
    bounds = bounds if bounds is not None else time_bounds(events)
    return session_columns_of(session_aggregate(events), bounds, horizon_days)


def session_columns_of(sess: DataFrame, bounds: DataFrame | tuple[int, int], horizon_days: float) -> DataFrame:
    """The session family of a table of sessions."""
    real = F.col("user_session").isNotNull()

    def s(c):
        return F.when(real, F.col(c) if isinstance(c, str) else c)

    per_user = sess.groupBy("user_id").agg(
        F.max(s("session_end")).alias("last_session"),
        F.count(s(F.lit(1))).alias("total_sessions"),
        F.sum(s("session_revenue")).cast("double").alias("total_revenue"),
        (F.sum(s("session_revenue")).cast("double") / F.count(s("session_revenue"))).alias("avg_session_revenue"),
        F.avg(s("total_events")).alias("avg_events_per_session"),
        (exact_avg(s("duration_us"), 0) / F.lit(1e6) / F.lit(60.0)).alias("avg_duration_min"),
        F.sum(s("views")).alias("total_views"),
        F.sum(s("cart_adds")).alias("total_cart_adds"),
        F.sum(s("purchases")).alias("total_purchases"),
        F.count(s(F.when(F.col("cart_adds") > 0, F.lit(1)))).alias("_cart_sessions"),
        F.count(s(F.when((F.col("cart_adds") > 0) & (F.col("purchases") == 0), F.lit(1)))).alias("_abandoned"),
        F.max("last_purchase_time").alias("last_purchase_time"),
    )
    obs_days = (F.col("t_max_us") - F.col("t_min_us")) / F.lit(1e6) / F.lit(86400.0)
    weeks = F.greatest(obs_days / F.lit(7.0), F.lit(1.0))
    cutoff_us = F.col("t_max_us") - F.lit(int(horizon_days * MICROS_PER_DAY))
    out = with_bounds(per_user.filter(F.col("total_sessions") > 0), bounds).select(
        "user_id",
        round_half_even(
            (F.col("t_max_us") - micros("last_session")) / F.lit(1e6) / F.lit(86400.0), 1
        ).alias("recency_days"),
        "total_sessions",
        round_half_even(F.col("total_sessions") / weeks, 4).alias("sessions_per_week"),
        "total_revenue",
        "avg_session_revenue",
        "avg_events_per_session",
        "avg_duration_min",
        "total_views",
        "total_cart_adds",
        "total_purchases",
        F.coalesce(round_half_even(F.try_divide(F.col("_abandoned").cast("double"), F.col("_cart_sessions")), 4), F.lit(0.0)).alias(
            "cart_abandonment_rate"
        ),
        round_half_even(safe_ratio("total_purchases", "total_views"), 4).alias("purchase_conversion_rate"),
        F.when(
            F.col("last_purchase_time").isNull() | (micros("last_purchase_time") < cutoff_us), F.lit(1)
        )
        .otherwise(F.lit(0))
        .alias(LABEL),
    )
    return out


# ------------------------------------------------------------------ per-user one-pass aggregate

def _activity_aggregate(events: DataFrame, bounds: DataFrame, affinity_categories: Sequence[str]) -> DataFrame:
    """One ``groupBy(user_id)`` for the time-habit and category/price families."""
    view, purchase = _is("view"), _is("purchase")
    ev = with_bounds(events.filter(F.col("user_id").isNotNull()), bounds).withColumn(
        "_top", top_category("category_code")
    )
    two_t = F.lit(2) * micros("event_time")
    mid2 = F.col("t_min_us") + F.col("t_max_us")
    # Modes of hour and weekday as fixed-width counters (24 + 7 sums) and an
    # argmax: stays in the code-generated hash aggregate, with a bounded
    # buffer per user; the first maximum is the lowest value, as ties need.
    hour, day = hour_of_day("event_time"), day_of_week("event_time")
    aggs = [
        F.array(*[_count_if(hour == h) for h in range(24)]).alias("_hour_counts"),
        F.array(*[_count_if(day == d) for d in range(7)]).alias("_day_counts"),
        F.avg(F.when(is_weekend("event_time"), 1.0).otherwise(0.0)).alias("_weekend"),
        F.avg(F.when(is_night("event_time"), 1.0).otherwise(0.0)).alias("_night"),
        F.avg(F.when(is_payday_window("event_time"), 1.0).otherwise(0.0)).alias("_payday"),
        _count_if(two_t <= mid2).alias("_first_half"),
        _count_if(two_t > mid2).alias("_second_half"),
        # category / price family (views and purchases)
        _count_if(view).alias("_views"),
        _count_if(purchase).alias("_purchases"),
        _exact_mean(F.when(purchase, F.col("price"))).alias("_avg_purchase_price"),
        F.stddev_samp(F.when(purchase, F.col("price"))).alias("_std_purchase_price"),
        _exact_mean(F.when(view, F.col("price"))).alias("_avg_view_price"),
    ]
    aggs += [_count_if(view & (F.col("_top") == F.lit(c))).alias(f"_n_{i}") for i, c in enumerate(affinity_categories)]
    return (
        ev.groupBy("user_id")
        .agg(*aggs)
        .withColumn("_pref_hour", _argmax_position("_hour_counts"))
        .withColumn("_pref_day", _argmax_position("_day_counts"))
        .drop("_hour_counts", "_day_counts")
    )


def _argmax_position(counts: str):
    """0-based index of the first maximum; null when every counter is 0."""
    c = F.col(counts)
    return F.when(F.array_max(c) > 0, F.array_position(c, F.array_max(c)) - 1)


def _temporal_columns() -> list:
    trend = (F.col("_second_half") - F.col("_first_half")) / (
        F.col("_first_half") + F.col("_second_half") + F.lit(1)
    )
    return [
        round_half_even("_weekend", 4).alias("weekend_activity_ratio"),
        round_half_even("_night", 4).alias("night_owl_score"),
        round_half_even("_payday", 4).alias("payday_activity_ratio"),
        round_half_even(trend, 4).alias("activity_trend"),
        round_half_even(cyclical_sin("_pref_hour", 24), 4).alias("preferred_hour_sin"),
        round_half_even(cyclical_cos("_pref_hour", 24), 4).alias("preferred_hour_cos"),
        round_half_even(cyclical_sin("_pref_day", 7), 4).alias("preferred_day_sin"),
        round_half_even(cyclical_cos("_pref_day", 7), 4).alias("preferred_day_cos"),
    ]


def temporal_features(events: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Weekend / night / payday shares, activity trend, cyclical preferred hour and day."""
    bounds = bounds if bounds is not None else time_bounds(events)
    agg = _activity_aggregate(events, bounds, [])
    return agg.select("user_id", *_temporal_columns())


def _view_counts(events: DataFrame) -> DataFrame:
    """Views per (user, top category, brand): the shared first level of the
    entropy and loyalty aggregates (one scan, one partially combined shuffle)."""
    return (
        events.filter(F.col("user_id").isNotNull() & _is("view"))
        .groupBy("user_id", top_category("category_code").alias("_top"), "brand")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _view_entropy(view_counts: DataFrame) -> DataFrame:
    """Shannon entropy (bits, +1e-10 inside the log) of viewed top categories,
    and the most viewed top category (ties → lowest name).

    The share needs the user's total; the window runs over the user's
    distinct categories only (bounded by the category vocabulary).
    """
    counts = view_counts.groupBy("user_id", "_top").agg(F.sum("_n").alias("_n"))
    share = F.col("_n") / F.sum("_n").over(Window.partitionBy("user_id"))
    return (
        counts.withColumn("_term", entropy_term(share))
        .groupBy("user_id")
        .agg(
            F.sum("_term").alias("_entropy"),
            F.min_by("_top", F.struct((-F.col("_n")).alias("n"), F.col("_top").alias("t"))).alias("top_category"),
        )
    )


def _brand_loyalty(view_counts: DataFrame) -> DataFrame:
    """Views of the user's most viewed brand / views that have a brand."""
    # the null-brand condition sits inside the aggregate (not a filter) so the
    # first-level count subtree stays identical to the entropy branch's and
    # Spark reuses its shuffle instead of scanning again
    counts = view_counts.groupBy("user_id", "brand").agg(F.sum("_n").alias("_n"))
    branded = F.when(F.col("brand").isNotNull(), F.col("_n"))
    return counts.groupBy("user_id").agg((F.max(branded) / F.sum(branded)).alias("_loyalty"))


#: one-hot columns are a projection list, so the vocabulary must stay small;
#: beyond it ``models.sparse`` encodes categories as one sparse vector column
MAX_ONEHOT_CATEGORIES = 1000


def onehot_categories(events: DataFrame, max_categories: int = MAX_ONEHOT_CATEGORIES) -> list[str]:
    """Distinct top categories (sorted); a small, vocabulary-bounded list."""
    return distinct_categories(events.select(top_category("category_code").alias("c")), max_categories)


def distinct_categories(categories: DataFrame, max_categories: int = MAX_ONEHOT_CATEGORIES) -> list[str]:
    """The values of column ``c``, sorted.

    At most ``max_categories + 1`` values reach the driver; a larger
    vocabulary is an error (pass an explicit list, or encode it sparsely)
    rather than a silently truncated encoding."""
    rows = categories.distinct().orderBy("c").limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(
            f"more than {max_categories} top categories: pass the one-hot vocabulary explicitly"
        )
    return [r["c"] for r in rows]


def _category_columns(affinity_categories: Sequence[str], onehot: Sequence[str]) -> list:
    cols = [
        F.coalesce(round_half_even("_entropy", 4), F.lit(0.0)).alias("category_diversity"),
    ]
    for i, c in enumerate(affinity_categories):
        cols.append(
            F.coalesce(round_half_even(F.try_divide(F.col(f"_n_{i}").cast("double"), F.col("_views")), 4), F.lit(0.0)).alias(
                f"{c}_affinity"
            )
        )
    cols += [
        F.coalesce(round_half_even("_loyalty", 4), F.lit(0.0)).alias("brand_loyalty_score"),
        F.coalesce(round_half_even("_avg_purchase_price", 2), F.lit(0.0)).alias("avg_price_point"),
        F.coalesce(round_half_even("_std_purchase_price", 2), F.lit(0.0)).alias("price_sensitivity"),
        F.coalesce(round_half_even("_avg_view_price", 2), F.lit(0.0)).alias("avg_browse_price"),
    ]
    cols += [
        F.when(F.col("top_category") == F.lit(c), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"topcategory_{c}")
        for c in sorted(onehot)
    ]
    return cols


def category_features(
    events: DataFrame,
    affinity_categories: Sequence[str] = DEFAULT_AFFINITY_CATEGORIES,
    onehot: Sequence[str] | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Diversity, affinities, brand loyalty, price level, one-hot top category.

    Users appear when they have at least one view or purchase.  ``onehot``
    fixes the ``topcategory_*`` columns; when omitted, one small distinct
    pass over the category vocabulary decides them.
    """
    bounds = bounds if bounds is not None else time_bounds(events)
    onehot = list(onehot) if onehot is not None else onehot_categories(events)
    agg = _activity_aggregate(events, bounds, affinity_categories)
    return _category_from(agg, events, affinity_categories, onehot)


def _category_from(agg, events, affinity_categories, onehot, extra=()):
    return category_columns_of(agg, _view_counts(events), affinity_categories, onehot, extra)


def category_columns_of(agg, view_counts, affinity_categories, onehot, extra=()):
    """The category family of a per-user aggregate and of views per (user, top category, brand)."""
    geo = agg.filter((F.col("_views") > 0) | (F.col("_purchases") > 0))
    geo = geo.join(_view_entropy(view_counts), "user_id", "left").join(_brand_loyalty(view_counts), "user_id", "left")
    return geo.select("user_id", *extra, *_category_columns(affinity_categories, onehot))


def user_features(
    events: DataFrame,
    horizon_days: float = DEFAULT_HORIZON_DAYS,
    affinity_categories: Sequence[str] = DEFAULT_AFFINITY_CATEGORIES,
    onehot: Sequence[str] | None = None,
) -> DataFrame:
    """The merged modelling table: session ⋈ temporal ⋈ category (inner).

    All families roll up from one written table of partial aggregates
    (``operators.cells``), so the events are read once.
    """
    from shopsignals.operators.cells import merged_features

    return merged_features(events, horizon_days, affinity_categories, onehot)


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("user_id", LABEL)) -> list[str]:
    """Numeric columns usable as model input (non-numeric ones are dropped)."""
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
