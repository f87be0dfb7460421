"""Scoring rules as column expressions: risk level, archetype, risk factors,
recommendation.  Rules are evaluated in order; the first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopsignals.functions.numeric import _col
from shopsignals.functions.text import format_fixed, format_percent

# Thresholds, names and texts of the scoring rules.
RISK_THRESHOLDS = [(0.85, "critical"), (0.65, "high"), (0.40, "medium")]
RISK_DEFAULT = "low"
HIGH_RISK_LEVELS = ["high", "critical"]
CHURN_THRESHOLD = 0.5

ARCHETYPE_NAMES = {
    -1: "Outlier",
    0: "The Window Shopper",
    1: "The Decisive Buyer",
    2: "The Cart Abandoner",
    3: "The Weekend Binge",
    4: "The Deal Hunter",
    5: "The Loyal Regular",
    6: "The Casual Browser",
}
DEFAULT_ARCHETYPE = "The Casual Browser"

RECOMMENDATIONS = {
    "The Window Shopper": "Send personalized product recommendations with first-purchase discount.",
    "The Decisive Buyer": "Offer loyalty rewards — this user converts when motivated.",
    "The Cart Abandoner": "Trigger abandoned cart email within 2 hours with limited-time offer.",
    "The Weekend Binge": "Schedule promotional emails for Friday evening.",
    "The Deal Hunter": "Target with payday promotions on the 1st and 15th.",
    "The Loyal Regular": "Enroll in VIP program — high retention value.",
    "The Casual Browser": "Re-engagement campaign with bestsellers in their top category.",
    "Outlier": "Manual review recommended — atypical behavior pattern.",
}
DEFAULT_RECOMMENDATION = "Monitor engagement over next 7 days."

MAX_RISK_FACTORS = 3
HEALTHY_FACTOR = ("Healthy engagement", "No significant risk signals", "low")


def risk_level(p) -> Column:
    p = _col(p)
    expr = None
    for threshold, name in RISK_THRESHOLDS:
        expr = F.when(p >= threshold, F.lit(name)) if expr is None else expr.when(p >= threshold, F.lit(name))
    return expr.otherwise(F.lit(RISK_DEFAULT))


def churn_decision(p, threshold: float = CHURN_THRESHOLD) -> Column:
    return _col(p) >= F.lit(threshold)


def rule_archetype() -> Column:
    """Archetype from feature values (used when no cluster model is given)."""
    c = F.col
    return (
        F.when(c("purchase_conversion_rate") > 0.05, "The Decisive Buyer")
        .when(c("cart_abandonment_rate") > 0.7, "The Cart Abandoner")
        .when(c("weekend_activity_ratio") > 0.6, "The Weekend Binge")
        .when((c("total_sessions") <= 2) & (c("total_purchases") == 0), "The Window Shopper")
        .when(c("payday_activity_ratio") > 0.25, "The Deal Hunter")
        .when(c("brand_loyalty_score") > 0.6, "The Loyal Regular")
        .otherwise(DEFAULT_ARCHETYPE)
    )


def _map_lookup(mapping: dict, key: Column, default: str) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def archetype_name(cluster_id, default: str | None = None) -> Column:
    """Cluster id → archetype; unknown ids → ``Cluster <id>`` unless a default is given."""
    cid = _col(cluster_id)
    fallback = F.lit(default) if default else F.concat(F.lit("Cluster "), cid.cast("string"))
    pairs = []
    for k, v in ARCHETYPE_NAMES.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[cid], fallback)


def recommendation(archetype) -> Column:
    return _map_lookup(RECOMMENDATIONS, _col(archetype), DEFAULT_RECOMMENDATION)


def _factor(cond: Column, name: str, detail: Column, impact: str) -> Column:
    return F.when(
        cond,
        F.struct(F.lit(name).alias("factor"), detail.alias("detail"), F.lit(impact).alias("impact")),
    )


def risk_factors() -> Column:
    """Up to three matching factors in rule order; a 'healthy' entry when none."""
    c = F.col
    found = F.array_compact(
        F.array(
            _factor(
                c("recency_days") > 20,
                "High recency",
                F.concat(F.lit("Last seen "), format_fixed(c("recency_days"), 0), F.lit(" days ago")),
                "high",
            ),
            _factor(
                c("cart_abandonment_rate") > 0.7,
                "Cart abandonment",
                F.concat(format_percent(c("cart_abandonment_rate"), 0), F.lit(" of cart sessions not purchased")),
                "high",
            ),
            _factor(
                c("activity_trend") < -0.1, "Declining activity", F.lit("Session frequency dropping over time"), "medium"
            ),
            _factor(
                c("total_purchases") == 0, "No purchase history", F.lit("User has never completed a purchase"), "high"
            ),
            _factor(
                c("sessions_per_week") < 0.5,
                "Low engagement",
                F.concat(F.lit("Only "), format_fixed(c("sessions_per_week"), 1), F.lit(" sessions per week")),
                "medium",
            ),
        )
    )
    healthy = F.array(
        F.struct(
            F.lit(HEALTHY_FACTOR[0]).alias("factor"),
            F.lit(HEALTHY_FACTOR[1]).alias("detail"),
            F.lit(HEALTHY_FACTOR[2]).alias("impact"),
        )
    )
    return F.when(F.size(found) > 0, F.slice(found, 1, MAX_RISK_FACTORS)).otherwise(healthy)


def factors_text(factors) -> Column:
    """'factor; detail; impact | …' — a flat text form of the factor array."""
    return F.array_join(
        F.transform(_col(factors), lambda f: F.concat_ws("; ", f["factor"], f["detail"], f["impact"])), " | "
    )
