"""Mergeable partial table of the events, from which every user feature rolls up.

A *cell* is (user, session, top category, brand, hour).  It holds counts,
exact sums, first and last times: everything the feature families need, and
nothing that depends on the other cells.  So

* the events are read once for all families;
* cells of different months are different cells: the table of a longer period
  is the union of the tables of its months, and a periodic run adds those of
  the new month only;
* a very active user is many cells, spread by all five keys; the roll-ups
  combine them map-side before their shuffles.

The activity trend compares the halves of the whole period.  Only the hour with
the midpoint holds events of both halves; they are looked up in the events by a
filter on the event time (one hour, pushed down to the files).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.functions.category import top_category
from shopsignals.functions.numeric import exact_sum, micros
from shopsignals.functions.timeparts import day_of_week, hour_of_day, is_night, is_payday_window, is_weekend
from shopsignals.operators import features as feat
from shopsignals.session import materialize
from shopsignals.sources.events import in_window

KEYS = ["user_id", "user_session", "top", "brand", "slot"]
HOUR_US = 3_600_000_000


def user_cells(events: DataFrame) -> DataFrame:
    """One row per (user, session, top category, brand, hour); rows without a user count for the time bounds."""
    view, purchase = feat._is("view"), feat._is("purchase")
    price = lambda kind: F.when(kind, F.col("price"))
    return (
        events.select(
            "user_id", "user_session", top_category("category_code").alias("top"), "brand", F.date_trunc("hour", "event_time").alias("slot"),
            "event_time", "event_type", F.col("price").cast("double").alias("price"),
        )
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("event_type").alias("n_typed"),
            feat._count_if(view).alias("views"),
            feat._count_if(feat._is("cart")).alias("cart_adds"),
            feat._count_if(purchase).alias("purchases"),
            F.min("event_time").alias("first_time"),
            F.max("event_time").alias("last_time"),
            F.max(F.when(purchase, F.col("event_time"))).alias("last_purchase_time"),
            exact_sum(price(purchase)).alias("purchase_sum"),
            exact_sum(price(purchase) * F.col("price")).alias("purchase_squares"),
            F.count(price(purchase)).alias("purchase_priced"),
            exact_sum(price(view)).alias("view_sum"),
            F.count(price(view)).alias("view_priced"),
        )
    )


def cell_bounds(cells: DataFrame) -> tuple[int, int] | None:
    """First and last event time in micros; None without events."""
    r = cells.agg(micros(F.min("first_time")).alias("lo"), micros(F.max("last_time")).alias("hi")).first()
    return None if r["lo"] is None else (r["lo"], r["hi"])


def cell_sessions(cells: DataFrame) -> DataFrame:
    """``features.session_aggregate`` from cells."""
    return (
        cells.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "user_session")
        .agg(
            F.min("first_time").alias("session_start"),
            F.max("last_time").alias("session_end"),
            F.sum("n_typed").alias("total_events"),
            F.sum("views").alias("views"),
            F.sum("cart_adds").alias("cart_adds"),
            F.sum("purchases").alias("purchases"),
            F.coalesce(F.sum("purchase_sum"), F.lit(0)).cast("decimal(38,12)").alias("session_revenue"),
            F.max("last_purchase_time").alias("last_purchase_time"),
        )
        .withColumn("duration_us", F.greatest(feat.micros_between("session_start", "session_end"), F.lit(0)))
    )


def cell_activity(cells: DataFrame, events: DataFrame, bounds: tuple[int, int] | None, affinity_categories: Sequence[str]) -> DataFrame:
    """``features._activity_aggregate`` from cells, with the midpoint's hour from the events."""
    mid2 = sum(bounds) if bounds else 0  # twice the midpoint, so that it stays whole
    hour = mid2 // 2 // HOUR_US * HOUR_US
    slot, n = micros("slot"), F.col("n")
    count = lambda cond, what=n: F.sum(F.when(cond, what).otherwise(F.lit(0)))
    hours, days = hour_of_day("slot"), day_of_week("slot")
    aggs = [
        F.array(*[count(hours == h) for h in range(24)]).alias("_hour_counts"),
        F.array(*[count(days == d) for d in range(7)]).alias("_day_counts"),
        F.sum("n").alias("_all"),
        count(is_weekend("slot")).alias("_n_weekend"),
        count(is_night("slot")).alias("_n_night"),
        count(is_payday_window("slot")).alias("_n_payday"),
        count(slot < hour).alias("_before"),
        count(slot > hour).alias("_after"),
        count(slot == hour).alias("_within"),
        F.sum("views").alias("_views"),
        F.sum("purchases").alias("_purchases"),
        F.sum("purchase_sum").cast("double").alias("_sum"),
        F.sum("purchase_squares").cast("double").alias("_squares"),
        F.sum("purchase_priced").alias("_priced"),
        F.try_divide(F.sum("view_sum").cast("double"), F.sum("view_priced")).alias("_avg_view_price"),
    ]
    aggs += [count(F.col("top") == F.lit(c), F.col("views")).alias(f"_n_{i}") for i, c in enumerate(affinity_categories)]
    start = datetime(1970, 1, 1) + timedelta(microseconds=hour)
    inside = in_window(events, f"{start} UTC", f"{start + timedelta(hours=1)} UTC").filter(F.col("user_id").isNotNull())
    early = inside.groupBy("user_id").agg(feat._count_if(F.lit(2) * micros("event_time") <= F.lit(mid2)).alias("_early"))
    share = lambda c: F.col(c).cast("double") / F.col("_all")
    variance = (F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("_priced")) / F.try_subtract(F.col("_priced"), F.lit(1))
    return (
        cells.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(*aggs)
        .join(early, "user_id", "left")
        .withColumns({
            "_weekend": share("_n_weekend"), "_night": share("_n_night"), "_payday": share("_n_payday"),
            "_first_half": F.col("_before") + F.coalesce("_early", F.lit(0)),
            "_second_half": F.col("_after") + F.col("_within") - F.coalesce("_early", F.lit(0)),
            "_avg_purchase_price": F.try_divide(F.col("_sum"), F.col("_priced")),
            "_std_purchase_price": F.when(F.col("_priced") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))),
            "_pref_hour": feat._argmax_position("_hour_counts"), "_pref_day": feat._argmax_position("_day_counts"),
        })
        .drop("_hour_counts", "_day_counts", "_early")
    )


def cell_views(cells: DataFrame) -> DataFrame:
    """Views per cell, in the form that entropy and brand loyalty add up."""
    return cells.filter(F.col("user_id").isNotNull() & (F.col("views") > 0)).select("user_id", F.col("top").alias("_top"), "brand", F.col("views").alias("_n"))


def features_from_cells(
    cells: DataFrame,
    events: DataFrame,
    horizon_days: float = feat.DEFAULT_HORIZON_DAYS,
    affinity_categories: Sequence[str] = feat.DEFAULT_AFFINITY_CATEGORIES,
    onehot: Sequence[str] | None = None,
) -> DataFrame:
    """The merged user features of a written cell table; ``events`` is read for one hour only."""
    bounds = cell_bounds(cells)
    onehot = list(onehot) if onehot is not None else feat.distinct_categories(cells.select(F.col("top").alias("c")))
    activity = cell_activity(cells, events, bounds, affinity_categories)
    views = cell_views(cells)
    side = feat.category_columns_of(activity, views, affinity_categories, onehot, extra=feat._temporal_columns())
    return feat.session_columns_of(cell_sessions(cells), bounds or (0, 0), horizon_days).join(side, "user_id", "inner")


def merged_features(
    events: DataFrame,
    horizon_days: float = feat.DEFAULT_HORIZON_DAYS,
    affinity_categories: Sequence[str] = feat.DEFAULT_AFFINITY_CATEGORIES,
    onehot: Sequence[str] | None = None,
) -> DataFrame:
    """The merged user features of an event table, read once into cells."""
    return features_from_cells(materialize(user_cells(events)), events, horizon_days, affinity_categories, onehot)


# ---------------------------------------------------------------- state by month


def write_cells(cells: DataFrame, root: str) -> None:
    """Cells by ``year=/month=``; months that ``cells`` holds are replaced, others stay."""
    by_month = cells.withColumns({"year": F.year("slot"), "month": F.month("slot")})
    by_month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root)


def read_cells(spark, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("year", "month")
