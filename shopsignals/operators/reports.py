"""Warehouse reports over the event table, as DataFrame plans.

The five reporting statements of the event warehouse: rows per month,
event-type distribution with distinct users and share of total, daily active
users, top brands by purchase revenue and the per-session summary.  They take
any event DataFrame, a registered table included (see ``sources.catalog``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.functions.numeric import exact_sum, round_half_up


def rows_per_month(events: DataFrame) -> DataFrame:
    """Row count per (year, month); uses partition columns when present."""
    cols = events.columns
    year = F.col("year") if "year" in cols else F.year("event_time")
    month = F.col("month") if "month" in cols else F.month("event_time")
    return (
        events.groupBy(year.alias("year"), month.alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("year", "month")
    )


def event_type_distribution(events: DataFrame, approximate_users: bool = False) -> DataFrame:
    """Events, distinct users and % of all events per event type.

    The share uses ``sum(count) over ()`` on the already grouped rows (one row
    per event type), so the empty-partition window is tiny.
    ``approximate_users`` switches the exact two-phase distinct count to
    HyperLogLog for very large inputs.
    """
    users = F.approx_count_distinct("user_id") if approximate_users else F.countDistinct("user_id")
    grouped = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_events"), users.alias("unique_users")
    )
    share = F.col("total_events") * F.lit(100.0) / F.sum("total_events").over(Window.partitionBy())
    return grouped.withColumn("pct", round_half_up(share, 2)).orderBy(F.desc("total_events"), "event_type")


def daily_active_users(events: DataFrame, approximate: bool = False) -> DataFrame:
    users = F.approx_count_distinct("user_id") if approximate else F.countDistinct("user_id")
    return (
        events.groupBy(F.to_date("event_time").alias("event_date"))
        .agg(users.alias("dau"))
        .orderBy("event_date")
    )


#: log2 of the sketch's registers: standard error 1.04 / sqrt(2 ** 12) = 1.6 %
SKETCH_LG_K = 12


def daily_user_sketches(events: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One distinct-user sketch per day; sketches of any days union to the users of these days.

    The exact count of a longer period needs all user ids again; a sketch of a
    few kilobytes a day replaces them.  Rows without a user or time do not count.
    """
    days = events.where("user_id IS NOT NULL AND event_time IS NOT NULL").groupBy(F.to_date("event_time").alias("event_date"))
    return days.agg(F.hll_sketch_agg(F.col("user_id").cast("bigint"), F.lit(lg_k)).alias("users"))


def active_users_from_sketches(sketches: DataFrame, period) -> DataFrame:
    """``period, active_users``: estimated distinct users per period of days (an expression of ``event_date``)."""
    return sketches.groupBy(period.alias("period")).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).cast("long").alias("active_users"))


def top_brands_by_revenue(events: DataFrame, n: int = 20) -> DataFrame:
    """Top-n brands by rounded purchase revenue; brand breaks ties."""
    return (
        events.filter((F.col("event_type") == "purchase") & F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(F.count(F.lit(1)).alias("purchases"), round_half_up(exact_sum("price").cast("double"), 2).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "brand")
        .limit(n)
    )


def session_summary(events: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per (user, session); null keys are kept as in SQL GROUP BY."""
    purchase = F.col("event_type") == "purchase"

    def count_type(t):
        return F.sum(F.when(F.col("event_type") == t, 1).otherwise(0))

    out = events.groupBy("user_id", "user_session").agg(
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        count_type("view").alias("views"),
        count_type("cart").alias("cart_adds"),
        count_type("purchase").alias("purchases"),
        exact_sum(F.when(purchase, F.col("price")).otherwise(F.lit(0.0))).cast("double").alias("session_revenue"),
    )
    return out.orderBy("user_id", "session_start") if ordered else out


def preview(df: DataFrame, n: int = 5, order_by: str = "user_id") -> DataFrame:
    """First ``n`` rows in key order (a top-n, not an arbitrary sample)."""
    return df.orderBy(order_by).limit(n)


#: the reports by name, as ``sources.catalog.run_report`` offers them
REPORTS = {
    "rows_per_month": rows_per_month,
    "event_type_distribution": event_type_distribution,
    "daily_active_users": daily_active_users,
    "top_brands_by_revenue": top_brands_by_revenue,
    "session_summary": session_summary,
}
