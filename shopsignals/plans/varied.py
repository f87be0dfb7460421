"""Checks of every rule branch, over user rows derived from the customer table.

The clickstream's users are all alike, so these queries spread the feature
values by arithmetic on the customer key: all archetypes, risk levels and
factors occur, every kind of rejection, and clusters with noise.  The twins
spell out rules and texts by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.functions import rules
from shopsignals.operators import profiles, scoring
from shopsignals.plans.registry import register

#: feature -> (multiplier, modulus, divisor, offset): (key * multiplier % modulus) / divisor + offset
_SPREAD = {
    "recency_days": (7, 71, 1, 0),
    "total_sessions": (5, 9, 1, 1),
    "sessions_per_week": (11, 40, 10, 0),
    "total_revenue": (131, 9973, 4, 0),
    "avg_session_revenue": (17, 997, 8, 0),
    "avg_events_per_session": (3, 19, 2, 1),
    "avg_duration_min": (13, 90, 2, 0),
    "total_views": (29, 101, 1, 0),
    "total_cart_adds": (19, 23, 1, 0),
    "total_purchases": (23, 4, 1, 0),
    "cart_abandonment_rate": (37, 101, 100, 0),
    "purchase_conversion_rate": (41, 64, 1000, 0),
    "weekend_activity_ratio": (43, 101, 100, 0),
    "night_owl_score": (47, 101, 100, 0),
    "payday_activity_ratio": (53, 41, 100, 0),
    "activity_trend": (59, 81, 40, -1),
    "category_diversity": (61, 33, 16, 0),
    "brand_loyalty_score": (67, 101, 100, 0),
    "avg_price_point": (71, 500, 4, 0),
    "price_sensitivity": (73, 300, 8, 0),
}
_VARIED_SQL = "WITH varied AS (SELECT CAST(c_custkey AS BIGINT) AS user_id, CAST(c_custkey % 3 = 0 AS INTEGER) AS churned, " + ", ".join(
    f"CAST((CAST(c_custkey AS BIGINT) * {a}) % {m} AS DOUBLE) / {d}.0 + {o}.0 AS {name}" for name, (a, m, d, o) in _SPREAD.items()
) + " FROM customer)"


def varied_users(spark, sf) -> DataFrame:
    key = F.col("c_custkey").cast("long")
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        key.alias("user_id"), (key % 3 == 0).cast("int").alias("churned"),
        *[((key * a % m).cast("double") / F.lit(float(d)) + F.lit(float(o))).alias(name) for name, (a, m, d, o) in _SPREAD.items()],
    )


_RULED_SQL = _VARIED_SQL + """,
    ruled AS (
      SELECT *, least(1.0, recency_days / 60.0) * 0.7 + cart_abandonment_rate * 0.3 AS p,
        CASE WHEN purchase_conversion_rate > 0.05 THEN 'The Decisive Buyer'
             WHEN cart_abandonment_rate > 0.7 THEN 'The Cart Abandoner'
             WHEN weekend_activity_ratio > 0.6 THEN 'The Weekend Binge'
             WHEN total_sessions <= 2 AND total_purchases = 0 THEN 'The Window Shopper'
             WHEN payday_activity_ratio > 0.25 THEN 'The Deal Hunter'
             WHEN brand_loyalty_score > 0.6 THEN 'The Loyal Regular'
             ELSE 'The Casual Browser' END AS archetype
      FROM varied),
    levelled AS (
      SELECT *, CASE WHEN p >= 0.85 THEN 'critical' WHEN p >= 0.65 THEN 'high' WHEN p >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level,
        list_filter([
          CASE WHEN recency_days > 20 THEN 'High recency; Last seen ' || CAST(CAST(recency_days AS BIGINT) AS VARCHAR) || ' days ago; high' END,
          CASE WHEN cart_abandonment_rate > 0.7 THEN 'Cart abandonment; ' || printf('%.0f', cart_abandonment_rate * 100.0) || '% of cart sessions not purchased; high' END,
          CASE WHEN activity_trend < -0.1 THEN 'Declining activity; Session frequency dropping over time; medium' END,
          CASE WHEN total_purchases = 0 THEN 'No purchase history; User has never completed a purchase; high' END,
          CASE WHEN sessions_per_week < 0.5 THEN 'Low engagement; Only ' || printf('%.1f', sessions_per_week) || ' sessions per week; medium' END
        ], lambda x: x IS NOT NULL) AS found
      FROM ruled)"""


@register(
    "scoring_batch_varied",
    _RULED_SQL + """
    SELECT user_id, round_even(p, 4) AS churn_probability, p >= 0.5 AS churn_prediction, risk_level, archetype,
      CASE WHEN len(found) = 0 THEN 'Healthy engagement; No significant risk signals; low' ELSE array_to_string(list_slice(found, 1, 3), ' | ') END AS risk_factors,
      CASE archetype
        WHEN 'The Window Shopper' THEN 'Send personalized product recommendations with first-purchase discount.'
        WHEN 'The Decisive Buyer' THEN 'Offer loyalty rewards — this user converts when motivated.'
        WHEN 'The Cart Abandoner' THEN 'Trigger abandoned cart email within 2 hours with limited-time offer.'
        WHEN 'The Weekend Binge' THEN 'Schedule promotional emails for Friday evening.'
        WHEN 'The Deal Hunter' THEN 'Target with payday promotions on the 1st and 15th.'
        WHEN 'The Loyal Regular' THEN 'Enroll in VIP program — high retention value.'
        ELSE 'Re-engagement campaign with bestsellers in their top category.' END AS recommendation
    FROM levelled""",
    "F15-F19 O6 M12 J9 (every branch)",
)
def q_scoring_batch_varied(spark, sf):
    return scoring.score_users(scoring.rule_score(varied_users(spark, sf)), "churn_proba").select(
        "user_id", "churn_probability", "churn_prediction", "risk_level", "archetype",
        rules.factors_text("top_risk_factors").alias("risk_factors"), "recommendation",
    )


@register(
    "scoring_summary_varied",
    _RULED_SQL + """,
    per AS (SELECT archetype, count(*) AS n FROM ruled GROUP BY archetype)
    SELECT count(*) AS total_users, count(CASE WHEN p >= 0.5 THEN 1 END) AS predicted_churners,
           round_even(CAST(sum(CAST(round_even(p, 4) AS DECIMAL(38,12))) AS DOUBLE) / count(*), 4) AS avg_churn_probability,
           count(CASE WHEN risk_level IN ('high', 'critical') THEN 1 END) AS high_risk_users,
           (SELECT string_agg(archetype || '=' || n, ', ' ORDER BY archetype) FROM per) AS archetype_distribution
    FROM levelled""",
    "A30 D9 (summary with its archetype map)",
)
def q_scoring_summary_varied(spark, sf):
    scored = scoring.score_users(scoring.rule_score(varied_users(spark, sf)), "churn_proba")
    shares = F.transform(F.map_entries("archetype_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    # two one-row results
    return scoring.batch_summary(scored).crossJoin(
        scoring.archetype_map(scored).select(F.array_join(F.array_sort(shares), ", ").alias("archetype_distribution"))
    )


#: clusters by key: ids 0 to 6 of the rules, 7 without a name, and a tenth of noise
_CLUSTER_SQL = """CASE WHEN user_id % 10 = 3 THEN -1 ELSE user_id % 8 END"""


def varied_clusters(spark, sf) -> DataFrame:
    key = F.col("user_id")
    return varied_users(spark, sf).withColumn("cluster", F.when(key % 10 == 3, F.lit(-1)).otherwise(key % 8).cast("int"))


@register(
    "profiles_clusters_varied",
    _VARIED_SQL + f""",
    c AS (SELECT *, CAST({_CLUSTER_SQL} AS INTEGER) AS cluster FROM varied)
    SELECT cluster,
      CASE cluster WHEN -1 THEN 'Outlier' WHEN 0 THEN 'The Window Shopper' WHEN 1 THEN 'The Decisive Buyer' WHEN 2 THEN 'The Cart Abandoner'
        WHEN 3 THEN 'The Weekend Binge' WHEN 4 THEN 'The Deal Hunter' WHEN 5 THEN 'The Loyal Regular' WHEN 6 THEN 'The Casual Browser'
        ELSE 'Cluster ' || CAST(cluster AS VARCHAR) END AS archetype,
      count(*) AS user_count, round_even(count(*) / sum(count(*)) OVER () * 100.0, 1) AS pct_of_sample,
      {", ".join(f"round_even(CAST(sum(CAST({f} AS DECIMAL(38,12))) AS DOUBLE) / count({f}), 4) AS {f}" for f in profiles.CLUSTER_FEATURES if f in _SPREAD)},
      round_even(avg(churned), 4) AS churn_rate
    FROM c GROUP BY cluster""",
    "A26 A31 M9 J9 (every name, a nameless cluster, noise)",
)
def q_profiles_clusters_varied(spark, sf):
    return profiles.cluster_profiles(varied_clusters(spark, sf), "cluster")


@register(
    "profiles_cluster_sizes_varied",
    _VARIED_SQL + f""",
    g AS (SELECT CAST({_CLUSTER_SQL} AS INTEGER) AS cluster, count(*) AS users FROM varied GROUP BY 1)
    SELECT cluster, users, round_even(users / sum(users) OVER (), 4) AS share,
           round_even(coalesce(sum(CASE WHEN cluster = -1 THEN users END) OVER (), 0) / sum(users) OVER (), 4) AS noise_share FROM g""",
    "A27 (with noise)",
)
def q_profiles_cluster_sizes_varied(spark, sf):
    return profiles.cluster_sizes(varied_clusters(spark, sf))


def varied_requests(spark, sf) -> DataFrame:
    """Requests as text, with missing, mistyped and out-of-range fields."""
    key = F.col("user_id")
    df = varied_users(spark, sf)
    text = df.select("user_id", *[F.col(c).cast("string").alias(c) for c in _SPREAD])
    return text.withColumns(
        {
            "recency_days": F.when(key % 11 == 1, F.lit(None)).when(key % 11 == 2, F.lit("-3")).otherwise(F.col("recency_days")),
            "total_sessions": F.when(key % 13 == 1, F.lit("abc")).when(key % 13 == 2, F.lit("2.5")).when(key % 13 == 3, F.lit("0")).otherwise(F.col("total_sessions")),
            "cart_abandonment_rate": F.when(key % 7 == 1, F.lit("1.5")).otherwise(F.col("cart_abandonment_rate")),
            "activity_trend": F.when(key % 17 == 1, F.lit("-1.25")).otherwise(F.col("activity_trend")),
            "avg_price_point": F.when(key % 5 == 1, F.lit(None)).otherwise(F.col("avg_price_point")),
        }
    )


@register(
    "scoring_validation_varied",
    """WITH r AS (
      SELECT CAST(c_custkey AS BIGINT) AS user_id, list_filter([
        CASE WHEN c_custkey % 11 = 1 THEN 'recency_days: field required' WHEN c_custkey % 11 = 2 THEN 'recency_days: below 0' END,
        CASE c_custkey % 13 WHEN 1 THEN 'total_sessions: not a number' WHEN 2 THEN 'total_sessions: not an integer' WHEN 3 THEN 'total_sessions: below 1' END,
        CASE WHEN c_custkey % 7 = 1 THEN 'cart_abandonment_rate: above 1' END,
        CASE WHEN c_custkey % 17 = 1 THEN 'activity_trend: below -1' END], lambda x: x IS NOT NULL) AS why
      FROM customer)
    SELECT user_id, len(why) = 0 AS is_valid, array_to_string(why, '; ') AS rejection_reasons FROM r""",
    "P14 F24 (every rejection reason)",
)
def q_scoring_validation_varied(spark, sf):
    v = scoring.validate_features(varied_requests(spark, sf))
    return v.select("user_id", "is_valid", F.array_join("rejection_reasons", "; ").alias("rejection_reasons"))
