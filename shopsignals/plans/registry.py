"""Registered queries: a Spark plan and, where SQL can say it, a DuckDB twin.

Every query reads the test tables of an ``sf`` folder through the adapters
(``sources.adapters``), runs over the whole tables, and returns a DataFrame.
The SQL twin restates the same definition in DuckDB over the pre-registered
views ``events``, ``part``, ``lineitem``, ``orders`` … .

Float aggregates that the operator itself does not round (sums and means of
prices and durations) are rounded to 6 decimals in both the Spark result and
the SQL twin of a check, because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignals.functions.numeric import round_half_even
from shopsignals.session import materialize, scratch_path
from shopsignals.operators import features as feat
from shopsignals.operators import reports
from shopsignals.plans import sql_twins as tw
from shopsignals.sources import adapters as ad

#: fixed one-hot vocabulary of the clickstream adapter (part types + unknown)
CLICKSTREAM_ONEHOT = sorted(ad.CLICKSTREAM_CATEGORIES + ["unknown"])
FLOAT_DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ids: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return deco


def _round_cols(df: DataFrame, cols, digits: int = FLOAT_DIGITS) -> DataFrame:
    return df.withColumns({c: round_half_even(c, digits) for c in cols})


def _sql_round(cols, digits: int = FLOAT_DIGITS) -> str:
    return ", ".join(f"round_even({c}, {digits}) AS {c}" for c in cols)


def _clicks(spark, sf):
    return ad.clickstream_events(spark, sf)


def _orders(spark, sf):
    return ad.order_events(spark, sf)


CLICK_CTE = f"ev AS ({ad.clickstream_events_sql()})"
ORDER_CTE = f"ev AS ({ad.order_events_sql()})"

SESSION_FLOATS = ["total_revenue", "avg_session_revenue", "avg_duration_min"]


# ----------------------------------------------------------------- reports (warehouse SQL)

@register(
    "report_rows_per_month",
    f"""WITH {ORDER_CTE}
    SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month, count(*) AS row_count
    FROM ev GROUP BY 1, 2 ORDER BY 1, 2""",
    "A20 O1 F4",
)
def q_rows_per_month(spark, sf):
    return reports.rows_per_month(_orders(spark, sf))


@register(
    "report_event_types",
    f"""WITH {CLICK_CTE}
    SELECT event_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
           round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
    FROM ev GROUP BY event_type ORDER BY total_events DESC, event_type""",
    "A21 W1 O1",
)
def q_event_types(spark, sf):
    return reports.event_type_distribution(_clicks(spark, sf))


@register(
    "report_daily_active_users",
    f"""WITH {CLICK_CTE}
    SELECT strftime(CAST(event_time AS DATE), '%Y-%m-%d') AS event_date, count(DISTINCT user_id) AS dau
    FROM ev GROUP BY 1 ORDER BY 1""",
    "A22 F5 O1",
)
def q_dau(spark, sf):
    # dates as ISO text so both engines hand over the same value type
    df = reports.daily_active_users(_clicks(spark, sf))
    return df.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@register(
    "report_top_brands",
    f"""WITH {CLICK_CTE}
    SELECT brand, count(*) AS purchases, round(sum(price), 2) AS total_revenue
    FROM ev WHERE event_type = 'purchase' AND brand IS NOT NULL
    GROUP BY brand ORDER BY total_revenue DESC, brand LIMIT 20""",
    "P1 P2 A23 O2",
)
def q_top_brands(spark, sf):
    return reports.top_brands_by_revenue(_clicks(spark, sf), 20)


@register(
    "report_session_summary",
    f"""WITH {CLICK_CTE}
    SELECT user_id, user_session, min(event_time) AS session_start, max(event_time) AS session_end,
           count(*) AS total_events,
           CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
           CAST(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_adds,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
           round_even(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END), {FLOAT_DIGITS}) AS session_revenue
    FROM ev GROUP BY user_id, user_session ORDER BY user_id, session_start""",
    "A1 F14 O1",
)
def q_session_summary(spark, sf):
    return _round_cols(reports.session_summary(_clicks(spark, sf)), ["session_revenue"])


@register(
    "report_order_sessions",
    f"""WITH {ORDER_CTE}
    SELECT user_id, user_session, min(event_time) AS session_start, max(event_time) AS session_end,
           count(*) AS total_events,
           CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
           CAST(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_adds,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
           round_even(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END), {FLOAT_DIGITS}) AS session_revenue
    FROM ev GROUP BY user_id, user_session ORDER BY user_id, session_start""",
    "A1 on order data",
)
def q_order_sessions(spark, sf):
    return _round_cols(reports.session_summary(_orders(spark, sf)), ["session_revenue"])


# ----------------------------------------------------------------- feature families

def _session_sql(cte: str, horizon: float) -> str:
    return f"""WITH {cte}, {tw.session_features_ctes(horizon)}
    SELECT * REPLACE ({_sql_round(SESSION_FLOATS)}) FROM session_features"""


@register("features_session", _session_sql(CLICK_CTE, ad.CLICKSTREAM_HORIZON_DAYS), "A1-A10 J1 J2 J8 F6 F7 F10 F11")
def q_features_session(spark, sf):
    df = feat.session_features(_clicks(spark, sf), horizon_days=ad.CLICKSTREAM_HORIZON_DAYS)
    return _round_cols(df, SESSION_FLOATS)


@register("features_session_orders", _session_sql(ORDER_CTE, ad.ORDERS_HORIZON_DAYS), "A1-A10 on order data, 14-day label")
def q_features_session_orders(spark, sf):
    df = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    return _round_cols(df, SESSION_FLOATS)


@register(
    "features_temporal",
    f"""WITH {CLICK_CTE}, {tw.temporal_features_ctes()}
    SELECT * FROM temporal_features""",
    "A11-A13 F2 F3 P3 P4 P5 J3 J4",
)
def q_features_temporal(spark, sf):
    return feat.temporal_features(_clicks(spark, sf))


@register(
    "features_category",
    f"""WITH {CLICK_CTE}, {tw.category_features_ctes(ad.CLICKSTREAM_CATEGORIES, CLICKSTREAM_ONEHOT)}
    SELECT * FROM category_features""",
    "A14-A19 F1 F12 F23 J5 J6",
)
def q_features_category(spark, sf):
    return feat.category_features(
        _clicks(spark, sf), affinity_categories=ad.CLICKSTREAM_CATEGORIES, onehot=CLICKSTREAM_ONEHOT
    )


USER_FEATURES_SQL = f"""WITH {CLICK_CTE}, {tw.user_features_ctes(ad.CLICKSTREAM_HORIZON_DAYS, ad.CLICKSTREAM_CATEGORIES, CLICKSTREAM_ONEHOT)}"""


def clickstream_user_features(spark, sf) -> DataFrame:
    return feat.user_features(
        _clicks(spark, sf),
        horizon_days=ad.CLICKSTREAM_HORIZON_DAYS,
        affinity_categories=ad.CLICKSTREAM_CATEGORIES,
        onehot=CLICKSTREAM_ONEHOT,
    )


@register(
    "features_merged",
    USER_FEATURES_SQL + f" SELECT * REPLACE ({_sql_round(SESSION_FLOATS)}) FROM user_features",
    "J7 D3",
)
def q_features_merged(spark, sf):
    return _round_cols(clickstream_user_features(spark, sf), SESSION_FLOATS)


# ----------------------------------------------------------------- scoring rules

from shopsignals.functions import rules  # noqa: E402
from shopsignals.operators import shift, evaluation, scoring  # noqa: E402

SCORE_SQL = "least(1.0, recency_days / 60.0) * 0.7 + cart_abandonment_rate * 0.3"

ARCHETYPE_SQL = """CASE WHEN purchase_conversion_rate > 0.05 THEN 'The Decisive Buyer'
  WHEN cart_abandonment_rate > 0.7 THEN 'The Cart Abandoner'
  WHEN weekend_activity_ratio > 0.6 THEN 'The Weekend Binge'
  WHEN total_sessions <= 2 AND total_purchases = 0 THEN 'The Window Shopper'
  WHEN payday_activity_ratio > 0.25 THEN 'The Deal Hunter'
  WHEN brand_loyalty_score > 0.6 THEN 'The Loyal Regular'
  ELSE 'The Casual Browser' END"""

RISK_SQL = """CASE WHEN p >= 0.85 THEN 'critical' WHEN p >= 0.65 THEN 'high'
  WHEN p >= 0.40 THEN 'medium' ELSE 'low' END"""

FACTORS_SQL = """coalesce(nullif(array_to_string(list_slice(list_filter([
    CASE WHEN recency_days > 20 THEN 'High recency; Last seen ' || printf('%.0f', recency_days) || ' days ago; high' END,
    CASE WHEN cart_abandonment_rate > 0.7 THEN 'Cart abandonment; ' || printf('%.0f', cart_abandonment_rate * 100.0)
         || '% of cart sessions not purchased; high' END,
    CASE WHEN activity_trend < -0.1 THEN 'Declining activity; Session frequency dropping over time; medium' END,
    CASE WHEN total_purchases = 0 THEN 'No purchase history; User has never completed a purchase; high' END,
    CASE WHEN sessions_per_week < 0.5 THEN 'Low engagement; Only ' || printf('%.1f', sessions_per_week)
         || ' sessions per week; medium' END
  ], lambda x: x IS NOT NULL), 1, 3), ' | '), ''), 'Healthy engagement; No significant risk signals; low')"""


def _recommendation_sql(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in rules.RECOMMENDATIONS.items())
    return f"CASE {whens} ELSE '{rules.DEFAULT_RECOMMENDATION}' END"


SCORED_SQL = f"""{USER_FEATURES_SQL},
    scored_in AS (SELECT *, {SCORE_SQL} AS p FROM user_features),
    scored AS (
      SELECT user_id, round_even(p, 4) AS churn_probability, p >= 0.5 AS churn_prediction,
             {RISK_SQL} AS risk_level, {ARCHETYPE_SQL} AS archetype, {FACTORS_SQL} AS risk_factors
      FROM scored_in)"""


def clickstream_scored(spark, sf) -> DataFrame:
    feats = scoring.rule_score(clickstream_user_features(spark, sf))
    return scoring.score_users(feats, "churn_proba")


@register(
    "scoring_batch",
    SCORED_SQL + f"""
    SELECT *, {_recommendation_sql('archetype')} AS recommendation FROM scored""",
    "M12 F15-F20 F25 O6 J9 D8",
)
def q_scoring_batch(spark, sf):
    s = clickstream_scored(spark, sf)
    return s.select(
        "user_id", "churn_probability", "churn_prediction", "risk_level", "archetype",
        rules.factors_text("top_risk_factors").alias("risk_factors"), "recommendation",
    )


@register(
    "scoring_summary",
    SCORED_SQL + """
    SELECT count(*) AS total_users, count(CASE WHEN churn_prediction THEN 1 END) AS predicted_churners,
           round_even((CAST(sum(CAST(churn_probability AS DECIMAL(38,12))) AS DOUBLE) / count(churn_probability)), 4) AS avg_churn_probability,
           count(CASE WHEN risk_level IN ('high', 'critical') THEN 1 END) AS high_risk_users
    FROM scored""",
    "A30 D9",
)
def q_scoring_summary(spark, sf):
    return scoring.batch_summary(clickstream_scored(spark, sf))


@register(
    "scoring_archetypes",
    SCORED_SQL + " SELECT archetype, count(*) AS users FROM scored GROUP BY archetype",
    "A30 archetype counts",
)
def q_scoring_archetypes(spark, sf):
    return scoring.archetype_distribution(clickstream_scored(spark, sf))


def _validation_sql() -> str:
    parts = []
    for name, integral, lo, hi, default in scoring.FEATURE_REQUEST_SCHEMA:
        v = f"coalesce(CAST({name} AS DOUBLE), {float(default)})" if default is not None else f"CAST({name} AS DOUBLE)"
        if default is None:
            parts.append(f"CASE WHEN {name} IS NULL THEN '{name}: field required' END")
        if integral:
            parts.append(f"CASE WHEN {v} <> floor({v}) THEN '{name}: not an integer' END")
        if lo is not None:
            parts.append(f"CASE WHEN {v} < {lo} THEN '{name}: below {lo}' END")
        if hi is not None:
            parts.append(f"CASE WHEN {v} > {hi} THEN '{name}: above {hi}' END")
    arr = "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"
    return f"""{USER_FEATURES_SQL}
    SELECT user_id, len({arr}) = 0 AS is_valid, array_to_string({arr}, '; ') AS rejection_reasons
    FROM user_features"""


@register("scoring_validation", _validation_sql(), "P14 F24")
def q_scoring_validation(spark, sf):
    v = scoring.validate_features(clickstream_user_features(spark, sf))
    return v.select("user_id", "is_valid", F.array_join("rejection_reasons", "; ").alias("rejection_reasons"))


def _persona_sql() -> str:
    stats = " || chr(10) || ".join(
        f"'- {name.replace('_', ' ').title()}: ' || CAST({name} AS VARCHAR)" for name in scoring.PERSONA_STATS
    )
    factors = FACTORS_SQL.replace("'High recency; ", "'- High recency: ").replace(" days ago; high'", " days ago (impact: high)'")
    head = scoring.PERSONA_TEMPLATE_HEAD.replace("'", "''")
    tail = scoring.PERSONA_TEMPLATE_TAIL.replace("'", "''")
    # the factor lines are rebuilt in the same text form as the Spark side
    factor_lines = """array_to_string(list_transform(string_split(risk_factors, ' | '), lambda f:
        '- ' || split_part(f, '; ', 1) || ': ' || split_part(f, '; ', 2) || ' (impact: ' || split_part(f, '; ', 3) || ')'), chr(10))"""
    del factors
    return f"""{SCORED_SQL}
    SELECT s.user_id,
      '{head}' || 'Archetype: ' || archetype || chr(10)
      || 'Churn probability: ' || printf('%.1f', churn_probability * 100.0) || '%' || chr(10)
      || 'Risk level: ' || risk_level || chr(10)
      || chr(10) || 'Key behavioral signals:' || chr(10) || {stats} || chr(10)
      || chr(10) || 'Risk factors identified:' || chr(10) || {factor_lines} || chr(10)
      || chr(10) || 'Recommended intervention: ' || {_recommendation_sql('archetype')} || chr(10)
      || '{tail}' AS prompt
    FROM scored s JOIN user_features f USING (user_id)"""


@register("scoring_persona_prompts", _persona_sql(), "F21 F20")
def q_scoring_persona_prompts(spark, sf):
    feats = scoring.rule_score(clickstream_user_features(spark, sf))
    scored = scoring.score_users(feats, "churn_proba", keep=["user_id", *scoring.PERSONA_STATS])
    return scoring.persona_prompts(scored)


# ----------------------------------------------------------------- evaluation tables

EVAL_SQL = f"""WITH {ORDER_CTE}, {tw.session_features_ctes(ad.ORDERS_HORIZON_DAYS)},
    scored AS (SELECT user_id, churned AS label, round_even({SCORE_SQL}, 2) AS score FROM session_features),
    counts AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
    sw AS (
      SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N
      FROM counts)"""


def order_scores(spark, sf) -> DataFrame:
    feats = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    s = scoring.rule_score(feats, "score")
    return s.select("user_id", F.col("churned").alias("label"), round_half_even("score", 2).alias("score"))


@register(
    "eval_roc_curve",
    EVAL_SQL + " SELECT score AS threshold, round_even(fp / N, 6) AS fpr, round_even(tp / P, 6) AS tpr FROM sw",
    "E1 W3",
)
def q_eval_roc_curve(spark, sf):
    r = evaluation.roc_curve(order_scores(spark, sf))
    return _round_cols(r, ["fpr", "tpr"])


@register(
    "eval_auc_ap",
    EVAL_SQL + """
    SELECT round_even(sum(neg * (2 * tp - pos)) / (2.0 * sum(pos) * sum(neg)), 4) AS roc_auc,
           round_even(sum(pos * (tp / (tp + fp))) / sum(pos), 4) AS average_precision,
           round_even(sum(pos) / (sum(pos) + sum(neg)), 6) AS positive_rate
    FROM sw""",
    "E1 E2",
)
def q_eval_auc_ap(spark, sf):
    out = evaluation.summary_curves(order_scores(spark, sf))
    return out.select(
        round_half_even("roc_auc", 4).alias("roc_auc"),
        round_half_even("average_precision", 4).alias("average_precision"),
        round_half_even("positive_rate", 6).alias("positive_rate"),
    )


@register(
    "eval_pr_curve",
    EVAL_SQL + " SELECT score AS threshold, round_even(tp / (tp + fp), 6) AS precision, round_even(tp / P, 6) AS recall FROM sw",
    "E2 W3",
)
def q_eval_pr_curve(spark, sf):
    return _round_cols(evaluation.pr_curve(order_scores(spark, sf)), ["precision", "recall"])


GRID_SQL = EVAL_SQL.split(",\n    counts AS")[0] + """,
    grid AS (
      SELECT count(CASE WHEN label = 1 AND score >= 0.5 THEN 1 END) AS tp,
             count(CASE WHEN label = 0 AND score >= 0.5 THEN 1 END) AS fp,
             count(CASE WHEN label = 1 AND score < 0.5 THEN 1 END) AS fn,
             count(CASE WHEN label = 0 AND score < 0.5 THEN 1 END) AS tn
      FROM scored)"""


@register(
    "eval_threshold_metrics",
    GRID_SQL + """
    SELECT round_even(coalesce(tp / nullif(tp + fp, 0), 0.0), 4) AS precision,
           round_even(coalesce(tp / nullif(tp + fn, 0), 0.0), 4) AS recall,
           round_even(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1,
           tp, fp, fn, tn
    FROM grid""",
    "E3",
)
def q_eval_threshold_metrics(spark, sf):
    return evaluation.threshold_metrics(order_scores(spark, sf))


@register(
    "eval_confusion_matrix",
    GRID_SQL + """
    SELECT 0 AS actual, 0 AS predicted, tn AS n FROM grid UNION ALL
    SELECT 0, 1, fp FROM grid UNION ALL SELECT 1, 0, fn FROM grid UNION ALL SELECT 1, 1, tp FROM grid""",
    "E4",
)
def q_eval_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(order_scores(spark, sf))


@register(
    "eval_classification_report",
    GRID_SQL + """,
    per_class AS (
      SELECT 'not churned' AS class, coalesce(tn / nullif(tn + fn, 0), 0.0) AS precision,
             coalesce(tn / nullif(tn + fp, 0), 0.0) AS recall,
             coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0.0) AS f1, tn + fp AS support FROM grid
      UNION ALL
      SELECT 'churned', coalesce(tp / nullif(tp + fp, 0), 0.0), coalesce(tp / nullif(tp + fn, 0), 0.0),
             coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), tp + fn FROM grid),
    rep AS (
      SELECT * FROM per_class
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_class
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM per_class)
    SELECT class, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall,
           round_even(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM rep""",
    "E5",
)
def q_eval_classification_report(spark, sf):
    return evaluation.classification_report(order_scores(spark, sf))


@register(
    "eval_score_histogram",
    EVAL_SQL.split(",\n    counts AS")[0] + """,
    h AS (SELECT label, CAST(least(floor(score * 49.0), 48) AS INTEGER) AS bin, count(*) AS n
          FROM scored WHERE score BETWEEN 0.0 AND 1.0 GROUP BY 1, 2)
    SELECT label, bin, bin * (1.0 / 49) AS lower, n,
           round_even(n / (1.0 / 49) / sum(n) OVER (PARTITION BY label), 6) AS density FROM h""",
    "E6",
)
def q_eval_score_histogram(spark, sf):
    h = evaluation.score_histogram(order_scores(spark, sf))
    return _round_cols(h, ["density"])


# ----------------------------------------------------------------- distribution-shift report

_MON = shift.MONITOR_FEATURES
_MON_LIST = ", ".join(_MON)
_MON_ARRAY = "[" + ", ".join(f"'{f}'" for f in _MON) + "]"

SPLIT_SQL = f"""{USER_FEATURES_SQL.replace("WITH ", "WITH RECURSIVE ", 1)},
    pos AS (SELECT *, row_number() OVER (ORDER BY user_id) AS rn, count(*) OVER () AS n FROM user_features),
    sides AS (SELECT *, CASE WHEN rn <= floor(n * 0.8) THEN 0 ELSE 1 END AS side FROM pos),
    long AS (
      SELECT side, feature, value FROM (
        UNPIVOT (SELECT side, {", ".join(f"coalesce(CAST({f} AS DOUBLE), 0.0) AS {f}" for f in _MON)} FROM sides)
        ON {_MON_LIST} INTO NAME feature VALUE value)),
    totals AS (
      SELECT feature, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS total_ref,
             sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS total_cur,
             (CAST(sum(CAST(CASE WHEN side = 0 THEN value END AS DECIMAL(38,12))) AS DOUBLE) / count(CASE WHEN side = 0 THEN value END)) AS ref_mean_raw,
             (CAST(sum(CAST(CASE WHEN side = 1 THEN value END AS DECIMAL(38,12))) AS DOUBLE) / count(CASE WHEN side = 1 THEN value END)) AS cur_mean_raw
      FROM long GROUP BY feature),
    vcounts AS (
      SELECT feature, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref,
             sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS n_cur
      FROM long GROUP BY feature, value),
    cum AS (
      SELECT feature, value,
             sum(n_ref) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS c_ref,
             sum(n_cur) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS c_cur
      FROM vcounts),
    ks AS (
      SELECT c.feature, max(abs(c_ref / t.total_ref - c_cur / t.total_cur)) AS ks_raw
      FROM cum c JOIN totals t USING (feature) GROUP BY c.feature),
    lam AS (
      SELECT t.*, k.ks_raw,
             k.ks_raw * sqrt(CAST(total_ref AS DOUBLE) * CAST(total_cur AS DOUBLE)
                             / (CAST(total_ref AS DOUBLE) + CAST(total_cur AS DOUBLE))) AS lam
      FROM totals t JOIN ks k USING (feature) WHERE total_ref > 0 AND total_cur > 0),
    details AS (
      SELECT feature, CAST(list_position({_MON_ARRAY}, feature) AS BIGINT) AS feature_order,
             round_even(ks_raw, 4) AS ks_statistic,
             CASE WHEN lam < {shift.KS_SMALL_LAMBDA} THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_reduce(
               list_transform(range(1, {shift.KS_SERIES_TERMS + 1}),
                 lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam)),
               lambda a, b: a + b))) END AS p_raw,
             round_even(ref_mean_raw, 4) AS ref_mean, round_even(cur_mean_raw, 4) AS cur_mean,
             round_even(abs(cur_mean_raw - ref_mean_raw) / (abs(ref_mean_raw) + 1e-10) * 100.0, 2) AS mean_shift_pct,
             CAST(total_ref AS BIGINT) AS n_ref, CAST(total_cur AS BIGINT) AS n_cur
      FROM lam),
    det AS (SELECT * EXCLUDE (p_raw), round_even(p_raw, 6) AS p_value, p_raw < {shift.DEFAULT_ALPHA} AS shift_detected FROM details)"""


def clickstream_monitored_features(spark, sf) -> DataFrame:
    """Feature table consumed by ranking, counts and both sides: materialised once."""
    return materialize(clickstream_user_features(spark, sf))


def clickstream_shift_details(spark, sf) -> DataFrame:
    feats = clickstream_monitored_features(spark, sf)
    base, cur = shift.positional_split(feats, "user_id", 0.8)
    return shift.ks_details(base, cur, shift.available_features(feats))


@register(
    "shift_ks",
    SPLIT_SQL + " SELECT * FROM det",
    "R1-R4 W2 W4 U3 F13",
)
def q_shift_ks(spark, sf):
    return clickstream_shift_details(spark, sf)


@register(
    "shift_verdict",
    SPLIT_SQL + """
    SELECT avg(CASE WHEN shift_detected THEN 1.0 ELSE 0.0 END) > 0.5 AS dataset_shift_detected,
           round_even(avg(CASE WHEN shift_detected THEN 1.0 ELSE 0.0 END), 4) AS shift_share,
           count(CASE WHEN shift_detected THEN 1 END) AS n_shifted_features,
           count(CASE WHEN NOT shift_detected THEN 1 END) AS n_stable_features,
           count(*) AS n_total_features,
           coalesce(string_agg(CASE WHEN shift_detected THEN feature END, ',' ORDER BY feature_order), '') AS shifted_features,
           coalesce(string_agg(CASE WHEN NOT shift_detected THEN feature END, ',' ORDER BY feature_order), '') AS stable_features
    FROM det""",
    "R5",
)
def q_shift_verdict(spark, sf):
    v = shift.shift_verdict(clickstream_shift_details(spark, sf))
    return v.select(
        "dataset_shift_detected", "shift_share", "n_shifted_features", "n_stable_features", "n_total_features",
        F.array_join("shifted_features", ",").alias("shifted_features"),
        F.array_join("stable_features", ",").alias("stable_features"),
    )


@register(
    "shift_alerts",
    SPLIT_SQL + " SELECT feature, ks_statistic, p_value, mean_shift_pct FROM det WHERE shift_detected ORDER BY ks_statistic DESC, feature",
    "R7",
)
def q_shift_alerts(spark, sf):
    return shift.shift_alerts(clickstream_shift_details(spark, sf))


#: orders of the first half of the period against those of the second half
_ORDER_SHIFT = ["order_age_days", "o_totalprice", "o_custkey"]


@register(
    "shift_alerts_orders",
    """WITH o AS (
      SELECT CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey,
             CAST(date_diff('day', CAST(o_orderdate AS DATE), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS DOUBLE) AS order_age_days,
             date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), CAST(o_orderdate AS DATE)) * 2
               > date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS late
      FROM orders),
    long AS (SELECT late, feature, coalesce(value, 0.0) AS value FROM o UNPIVOT (value FOR feature IN (order_age_days, o_totalprice, o_custkey))),
    tot AS (SELECT feature, sum(CASE WHEN late THEN 0.0 ELSE 1.0 END) AS n0, sum(CASE WHEN late THEN 1.0 ELSE 0.0 END) AS n1,
                   avg(CASE WHEN NOT late THEN CAST(value AS DECIMAL(38,12)) END) AS m0, avg(CASE WHEN late THEN CAST(value AS DECIMAL(38,12)) END) AS m1 FROM long GROUP BY 1),
    cdf AS (SELECT feature, value, sum(sum(CASE WHEN late THEN 0.0 ELSE 1.0 END)) OVER w AS c0, sum(sum(CASE WHEN late THEN 1.0 ELSE 0.0 END)) OVER w AS c1
            FROM long GROUP BY feature, value WINDOW w AS (PARTITION BY feature ORDER BY value)),
    ks AS (SELECT feature, max(abs(c0 / n0 - c1 / n1)) AS d FROM cdf JOIN tot USING (feature) GROUP BY 1),
    p AS (SELECT *, d * sqrt(n0 * n1 / (n0 + n1)) AS lam FROM ks JOIN tot USING (feature)),
    pv AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_sum(list_transform(range(1, 101),
             lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam))))) END AS pr FROM p)
    SELECT feature, round_even(d, 4) AS ks_statistic, round_even(pr, 6) AS p_value,
           round_even(abs(m1 - m0) / (abs(m0) + 1e-10) * 100.0, 2) AS mean_shift_pct FROM pv WHERE pr < 0.05""",
    "R7",
)
def q_shift_alerts_orders(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
    # one row: the period's two ends
    ends = orders.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    aged = orders.join(F.broadcast(ends)).withColumn("order_age_days", F.datediff("last_day", "day").cast("double"))
    late = F.datediff("day", "first_day") * 2 > F.datediff("last_day", "first_day")
    return shift.shift_alerts(shift.ks_details(aged.where(~late), aged.where(late), _ORDER_SHIFT))


@register(
    "shift_overlay",
    SPLIT_SQL + f""",
    top AS (SELECT feature FROM det ORDER BY ks_statistic DESC, feature_order LIMIT {shift.OVERLAY_TOP}),
    rng AS (SELECT feature, min(value) AS lo, max(value) AS hi,
                   sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS n1
            FROM long GROUP BY feature),
    b0 AS (SELECT l.*, r.lo, r.hi, r.n0, r.n1, (r.hi - r.lo) / {float(shift.OVERLAY_EDGES - 1)} AS step,
                  CASE WHEN r.hi = r.lo THEN 0 ELSE least(CAST(floor((l.value - r.lo) / (r.hi - r.lo) * {float(shift.OVERLAY_EDGES - 1)}) AS INTEGER), {shift.OVERLAY_EDGES - 2}) END AS i0
           FROM long l JOIN rng r USING (feature) WHERE feature IN (SELECT feature FROM top)),
    b1 AS (SELECT *, CASE WHEN value < (CASE WHEN i0 >= {shift.OVERLAY_EDGES - 1} THEN hi ELSE lo + i0 * step END) THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
    b2 AS (SELECT *, CASE WHEN value >= (CASE WHEN i1 + 1 >= {shift.OVERLAY_EDGES - 1} THEN hi ELSE lo + (i1 + 1) * step END)
                           AND i1 <> {shift.OVERLAY_EDGES - 2} THEN i1 + 1 ELSE i1 END AS bin FROM b1),
    c AS (SELECT feature, bin, lo, hi, n0, n1, step, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c0,
                 sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1 FROM b2 GROUP BY ALL),
    e AS (SELECT *, CASE WHEN bin >= {shift.OVERLAY_EDGES - 1} THEN hi ELSE lo + bin * step END AS lower,
                    CASE WHEN bin + 1 >= {shift.OVERLAY_EDGES - 1} THEN hi ELSE lo + (bin + 1) * step END AS upper FROM c)
    SELECT feature, bin, round_even(lower, 6) AS lower, round_even(upper, 6) AS upper,
           round_even(c0 / (upper - lower) / n0, 6) AS baseline_density,
           round_even(c1 / (upper - lower) / n1, 6) AS current_density
    FROM e""",
    "R6",
)
def q_shift_overlay(spark, sf):
    feats = clickstream_monitored_features(spark, sf)
    base, cur = shift.positional_split(feats, "user_id", 0.8)
    features = shift.available_features(feats)
    details = shift.ks_details(base, cur, features)
    ov = shift.distribution_overlay(base, cur, features, wanted=shift.top_shifted(details))
    return _round_cols(ov, ["lower", "upper", "baseline_density", "current_density"])


# ----------------------------------------------------------------- profiles and statistics

from shopsignals.operators import profiles  # noqa: E402

_CF = [c for c in profiles.CLUSTER_FEATURES]
_RULE_ID_SQL = "CASE " + " ".join(
    f"WHEN ({ARCHETYPE_SQL}) = '{name}' THEN {cid}" for cid, name in rules.ARCHETYPE_NAMES.items()
) + " END"


def clickstream_rule_clusters(spark, sf) -> DataFrame:
    df, _cols, _missing = profiles.clustering_input(clickstream_user_features(spark, sf))
    return df.withColumn("cluster", profiles.rule_cluster_id())


PROFILE_SQL = f"""{USER_FEATURES_SQL},
    cin AS (SELECT * FROM user_features WHERE total_sessions >= 2),
    cl AS (SELECT *, {_RULE_ID_SQL} AS cluster FROM cin),
    prof AS (
      SELECT cluster, count(*) AS user_count,
             {", ".join(f"(CAST(sum(CAST({c} AS DECIMAL(38,12))) AS DOUBLE) / count({c})) AS {c}" for c in _CF)}, avg(churned) AS churn_rate
      FROM cl GROUP BY cluster),
    profiles AS (
      SELECT cluster,
             CASE {" ".join(f"WHEN cluster = {k} THEN '{v}'" for k, v in rules.ARCHETYPE_NAMES.items())}
                  ELSE 'Cluster ' || CAST(cluster AS VARCHAR) END AS archetype,
             user_count, round_even(user_count / sum(user_count) OVER () * 100.0, 1) AS pct_of_sample,
             {", ".join(f"round_even({c}, 4) AS {c}" for c in _CF)}, round_even(churn_rate, 4) AS churn_rate
      FROM prof)"""


@register("profiles_clusters", PROFILE_SQL + " SELECT * FROM profiles", "A26 A31 P7 P11 P13 M9 J9 D7")
def q_profiles_clusters(spark, sf):
    return profiles.cluster_profiles(clickstream_rule_clusters(spark, sf), "cluster", _CF)


@register(
    "profiles_cluster_prompt",
    PROFILE_SQL + f"""
    SELECT '{scoring.CLUSTER_PROMPT_HEAD.replace("'", "''")}'
      || string_agg(chr(10) || archetype || ':' || chr(10)
         || '  - ' || format('{{:,}}', user_count) || ' users (' || CAST(pct_of_sample AS VARCHAR) || '% of sample)' || chr(10)
         || CASE WHEN churn_rate IS NOT NULL AND churn_rate <> 0
                 THEN '  - Churn rate: ' || printf('%.1f', churn_rate * 100.0) || '%' || chr(10) ELSE '' END
         || {" || ".join(f"'  - {c.replace('_', ' ')}: ' || CAST({c} AS VARCHAR) || chr(10)" for c in _CF[:4])},
         '' ORDER BY cluster)
      || '{scoring.CLUSTER_PROMPT_TAIL.replace("'", "''")}' AS prompt
    FROM profiles WHERE cluster <> -1""",
    "F22",
)
def q_profiles_cluster_prompt(spark, sf):
    prof = profiles.cluster_profiles(clickstream_rule_clusters(spark, sf), "cluster", _CF)
    return scoring.cluster_prompt(prof, _CF)


@register(
    "profiles_cluster_sizes",
    PROFILE_SQL + """
    SELECT cluster, user_count AS users, round_even(user_count / sum(user_count) OVER (), 4) AS share,
           round_even(coalesce(sum(CASE WHEN cluster = -1 THEN user_count END) OVER (), 0) / sum(user_count) OVER (), 4) AS noise_share
    FROM profiles""",
    "A27",
)
def q_profiles_cluster_sizes(spark, sf):
    return profiles.cluster_sizes(clickstream_rule_clusters(spark, sf))


@register(
    "profiles_class_balance",
    f"""WITH {ORDER_CTE}, {tw.session_features_ctes(ad.ORDERS_HORIZON_DAYS)}
    SELECT count(CASE WHEN churned = 0 THEN 1 END) AS negatives, count(CASE WHEN churned = 1 THEN 1 END) AS positives,
           CAST(count(CASE WHEN churned = 0 THEN 1 END) AS DOUBLE) / nullif(count(CASE WHEN churned = 1 THEN 1 END), 0)
             AS scale_pos_weight
    FROM session_features""",
    "A28 M3",
)
def q_profiles_class_balance(spark, sf):
    feats = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    return profiles.class_balance(feats)


@register(
    "profiles_dataset_means",
    USER_FEATURES_SQL + " SELECT count(*) AS users, round_even(avg(churned), 4) AS churn_rate FROM user_features",
    "A24",
)
def q_profiles_dataset_means(spark, sf):
    return profiles.dataset_means(clickstream_user_features(spark, sf))


_DESCRIBE = shift.MONITOR_FEATURES


@register(
    "profiles_describe",
    USER_FEATURES_SQL + f""",
    long AS (
      SELECT feature, value FROM (
        UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DESCRIBE)}
                 FROM (SELECT * REPLACE ({_sql_round(SESSION_FLOATS)}) FROM user_features))
        ON {", ".join(_DESCRIBE)} INTO NAME feature VALUE value) WHERE value IS NOT NULL)
    SELECT feature, count(*) AS count, round_even((CAST(sum(CAST(value AS DECIMAL(38,12))) AS DOUBLE) / count(value)), 6) AS mean, round_even(stddev_samp(value), 6) AS std,
           min(value) AS min, round_even(quantile_cont(value, 0.25), 6) AS p25,
           round_even(quantile_cont(value, 0.5), 6) AS p50, round_even(quantile_cont(value, 0.75), 6) AS p75,
           max(value) AS max
    FROM long GROUP BY feature""",
    "A25",
)
def q_profiles_describe(spark, sf):
    feats = materialize(_round_cols(clickstream_user_features(spark, sf), SESSION_FLOATS))
    d = profiles.describe(feats, _DESCRIBE)
    return _round_cols(d, ["mean", "std", "p25", "p50", "p75"])


@register(
    "sample_stratified_split",
    f"""WITH {ORDER_CTE}, {tw.session_features_ctes(ad.ORDERS_HORIZON_DAYS)},
    sizes AS (SELECT churned, count(*) AS n FROM session_features GROUP BY churned)
    SELECT churned, false AS is_test, CAST(floor(n * 0.8) AS BIGINT) AS users FROM sizes WHERE floor(n * 0.8) > 0
    UNION ALL
    SELECT churned, true, CAST(n - floor(n * 0.8) AS BIGINT) FROM sizes WHERE n - floor(n * 0.8) > 0""",
    "O9",
)
def q_sample_stratified_split(spark, sf):
    feats = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    s = profiles.stratified_split(feats, "churned", 0.8, 42)
    return s.groupBy("churned", "is_test").agg(F.count(F.lit(1)).alias("users"))


@register(
    "sample_users",
    f"""WITH {ORDER_CTE}, {tw.session_features_ctes(ad.ORDERS_HORIZON_DAYS)}
    SELECT user_id, total_sessions, total_purchases, churned FROM session_features
    ORDER BY md5(CAST(user_id AS VARCHAR) || '-42'), user_id LIMIT 200""",
    "O8",
)
def q_sample_users(spark, sf):
    feats = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    return shift.hash_sample(feats, 200, seed=42).select("user_id", "total_sessions", "total_purchases", "churned")


@register(
    "shift_positional_split",
    USER_FEATURES_SQL + """,
    pos AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS rn, count(*) OVER () AS n FROM user_features)
    SELECT CASE WHEN rn <= floor(n * 0.8) THEN 'baseline' ELSE 'current' END AS side, count(*) AS users,
           min(user_id) AS first_user, max(user_id) AS last_user
    FROM pos GROUP BY 1""",
    "W4 R1",
)
def q_shift_positional_split(spark, sf):
    # the split's count, block table and cut are scalar sub-queries over the
    # same input: read it from one checkpoint instead of recomputing it
    base, cur = shift.positional_split(clickstream_monitored_features(spark, sf), "user_id", 0.8)
    tagged = base.select("user_id", F.lit("baseline").alias("side")).unionByName(
        cur.select("user_id", F.lit("current").alias("side"))
    )
    return tagged.groupBy("side").agg(
        F.count(F.lit(1)).alias("users"), F.min("user_id").alias("first_user"), F.max("user_id").alias("last_user")
    )


# ----------------------------------------------------------------- models (rows-only checks)

from shopsignals.models import churn as churn_model  # noqa: E402
from shopsignals.models import clusters as cluster_model  # noqa: E402


def order_user_features(spark, sf) -> DataFrame:
    """Merged features from the order data (14-day label), for the models."""
    return feat.user_features(
        _orders(spark, sf),
        horizon_days=ad.ORDERS_HORIZON_DAYS,
        affinity_categories=ad.CLICKSTREAM_CATEGORIES,
        onehot=CLICKSTREAM_ONEHOT,
    )


ORDER_FEATURES_SQL = f"WITH {ORDER_CTE}, {tw.user_features_ctes(ad.ORDERS_HORIZON_DAYS, ad.CLICKSTREAM_CATEGORIES, CLICKSTREAM_ONEHOT)}"


def _trained(spark, sf):
    """Features, model and prepared rows; every query reads the tables and trains."""
    feats = materialize(order_user_features(spark, sf))
    return (feats, *churn_model.train(feats))


@register("model_churn_scores", None, "M1 M2 M3 M4 M12")
def q_model_churn_scores(spark, sf):
    feats, model, _ = _trained(spark, sf)
    scored = churn_model.score(model, feats)
    return scoring.score_users(scored, "churn_proba").select(
        "user_id", "churn_probability", "churn_prediction", "risk_level", "archetype",
        rules.factors_text("top_risk_factors").alias("risk_factors"), "recommendation",
    )


@register("model_churn_metrics", None, "E3 E1 E2 on model scores (test split)")
def q_model_churn_metrics(spark, sf):
    _feats, model, prepared = _trained(spark, sf)
    test = churn_model.score(model, prepared.filter("is_test")).select(
        F.col("churned").alias("label"), F.col("churn_proba").alias("score")
    )
    m = evaluation.threshold_metrics(test)
    curves = evaluation.summary_curves(test)
    return m.withColumns(
        {"roc_auc": curves.select("roc_auc").scalar(), "average_precision": curves.select("average_precision").scalar()}
    )


@register("model_feature_importance", None, "M10 O3")
def q_model_feature_importance(spark, sf):
    _f, model, _p = _trained(spark, sf)
    return churn_model.feature_importance(model, 10)


@register("model_info", None, "M13")
def q_model_info(spark, sf):
    _f, model, _p = _trained(spark, sf)
    return churn_model.model_info(model)


@register("model_attributions", None, "M11a A29 O4 (Shapley values of the trees, all rows)")
def q_model_attributions(spark, sf):
    feats, model, _p = _trained(spark, sf)
    attrs, _cols = churn_model.tree_attributions(model, feats)
    return profiles.mean_abs_attribution(attrs, top=15)


@register(
    "model_attribution_balance",
    ORDER_FEATURES_SQL + " SELECT count(*) AS users, CAST(0 AS BIGINT) AS off_users, CAST(0 AS BIGINT) AS off_scores FROM user_features",
    "M11a: base + attributions = margin, and the margin's probability = the score, for every user",
)
def q_model_attribution_balance(spark, sf):
    feats, model, _p = _trained(spark, sf)
    attrs, cols = churn_model.tree_attributions(model, feats)
    total = F.col("base_margin")
    for c in cols:
        total = total + F.col(c)
    scored = churn_model.score(model, feats, "scored").select("user_id", "scored")
    return attrs.withColumn("_off", F.abs(total - F.col("margin")) > 1e-9).join(scored, "user_id").agg(
        F.count(F.lit(1)).alias("users"), F.count(F.when(F.col("_off"), 1)).alias("off_users"),
        F.count(F.when(F.abs(F.col("churn_proba") - F.col("scored")) > 1e-9, 1)).alias("off_scores"),
    )


@register("model_permutation_importance", None, "M11b (AUC lost when a column is shuffled, test rows)")
def q_model_permutation_importance(spark, sf):
    _f, model, prepared = _trained(spark, sf)
    return churn_model.permutation_importance(model, prepared.filter("is_test"))


@register(
    "model_run_facts",
    ORDER_FEATURES_SQL + """,
    sizes AS (SELECT churned, count(*) AS n FROM user_features GROUP BY churned)
    SELECT CAST(sum(floor(n * 0.8)) AS BIGINT) AS train_size, CAST(sum(n - floor(n * 0.8)) AS BIGINT) AS test_size,
           (SELECT round_even(avg(churned), 4) FROM user_features) AS churn_rate,
           round_even(max(CASE WHEN churned = 0 THEN floor(n * 0.8) END) / max(CASE WHEN churned = 1 THEN floor(n * 0.8) END), 2) AS scale_pos_weight
    FROM sizes""",
    "S19 M3",
)
def q_model_run_facts(spark, sf):
    # the split, the class counts and the prepared rows read them
    feats = materialize(order_user_features(spark, sf))
    prepared = materialize(churn_model.prepare(feats))
    facts = churn_model.run_facts(prepared, feat.feature_columns(feats))
    return spark.createDataFrame(
        [(facts["train_size"], facts["test_size"], facts["churn_rate"], facts["scale_pos_weight"])],
        "train_size long, test_size long, churn_rate double, scale_pos_weight double",
    )


def _clustered(spark, sf):
    feats = materialize(clickstream_user_features(spark, sf))
    model, labelled = cluster_model.fit(feats)
    return feats, model, labelled


@register("model_clusters", None, "M5 M6 M7 M8 M9 S14")
def q_model_clusters(spark, sf):
    _f, _m, labelled = _clustered(spark, sf)
    prof = profiles.cluster_profiles(labelled, "cluster", _CF + ["total_purchases"])
    names = cluster_model.name_clusters(prof)
    return labelled.join(F.broadcast(names), "cluster", "left").select("user_id", "cluster", "archetype")


@register(
    "model_scaler_stats",
    USER_FEATURES_SQL + f""", long AS (
      UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CF)} FROM user_features WHERE total_sessions >= 2)
      ON {", ".join(_CF)} INTO NAME feature VALUE value)
    SELECT feature, round_even(avg(value), 6) AS mean, round_even(stddev_samp(value), 6) AS std FROM long GROUP BY feature""",
    "M5 (the fitted scaler's means and deviations)",
)
def q_model_scaler_stats(spark, sf):
    _f, model, _l = _clustered(spark, sf)
    return _round_cols(cluster_model.scaler_statistics(model), ["mean", "std"], 6)


@register("model_density_clusters", None, "M7 (density clusters with noise)")
def q_model_density_clusters(spark, sf):
    return cluster_model.fit_density(clickstream_user_features(spark, sf))


@register("model_explained_variance", None, "M6")
def q_model_explained_variance(spark, sf):
    _f, model, _l = _clustered(spark, sf)
    return cluster_model.explained_variance(model)


@register("model_silhouette_euclidean", None, "E7 (plain Euclidean, sample of 10,000)")
def q_model_silhouette_euclidean(spark, sf):
    _f, _m, labelled = _clustered(spark, sf)
    return cluster_model.euclidean_silhouette(labelled)


@register("model_cluster_profiles", None, "A26 on model clusters")
def q_model_cluster_profiles(spark, sf):
    _f, _m, labelled = _clustered(spark, sf)
    prof = profiles.cluster_profiles(labelled, "cluster", _CF + ["total_purchases"])
    return prof


@register("model_silhouette", None, "E7")
def q_model_silhouette(spark, sf):
    _f, _m, labelled = _clustered(spark, sf)
    return cluster_model.silhouette(labelled)


@register(
    "model_class_weights",
    f"""WITH {ORDER_CTE}, {tw.session_features_ctes(ad.ORDERS_HORIZON_DAYS)},
    bal AS (SELECT CAST(count(CASE WHEN churned = 0 THEN 1 END) AS DOUBLE)
                   / nullif(count(CASE WHEN churned = 1 THEN 1 END), 0) AS w FROM session_features)
    SELECT user_id, churned, round_even(CASE WHEN churned = 1 THEN coalesce(w, 1.0) ELSE 1.0 END, 6) AS weight
    FROM session_features CROSS JOIN bal""",
    "M3",
)
def q_model_class_weights(spark, sf):
    feats = feat.session_features(_orders(spark, sf), horizon_days=ad.ORDERS_HORIZON_DAYS)
    w = profiles.with_class_weight(feats, "churned", "weight")
    return _round_cols(w.select("user_id", "churned", "weight"), ["weight"])


# ----------------------------------------------------------------- streaming (rows-only)

def _replayed_stream(spark, sf, build, name):
    """Replay the clickstream events as a file stream into the shared
    checkpoint folder, run the streaming plan to completion (availableNow),
    and read the appended result back as a table."""
    from shopsignals.streaming import sessions as st

    root = scratch_path(spark, "streams")
    ev = ad.clickstream_events(spark, sf, sessionize=False).drop("event_id")
    ev.write.mode("overwrite").parquet(f"{root}/source")
    st.closing_event(ev).write.mode("append").parquet(f"{root}/source")
    q = st.start_to_parquet(build(st.read_event_stream(spark, f"{root}/source")), f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register(
    "stream_sessions",
    f"""WITH {CLICK_CTE}
    SELECT user_id, min(event_time) AS session_start, max(event_time) AS session_end, count(*) AS total_events,
           CAST(count(CASE WHEN event_type = 'view' THEN 1 END) AS BIGINT) AS views,
           CAST(count(CASE WHEN event_type = 'cart' THEN 1 END) AS BIGINT) AS cart_adds,
           CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS purchases,
           round_even(CAST(sum(CAST(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END AS DECIMAL(38,12))) AS DOUBLE), {FLOAT_DIGITS}) AS session_revenue
    FROM ev WHERE user_id IS NOT NULL GROUP BY user_id, user_session""",
    "T1",
)
def q_stream_sessions(spark, sf):
    from shopsignals.streaming.sessions import session_stream

    return _round_cols(_replayed_stream(spark, sf, session_stream, "sessions"), ["session_revenue"])


@register(
    "stream_daily_active_users",
    f"""WITH {CLICK_CTE}
    SELECT strftime(CAST(event_time AS DATE), '%Y-%m-%d') AS event_date, count(DISTINCT user_id) AS dau FROM ev GROUP BY 1""",
    "T2",
)
def q_stream_dau(spark, sf):
    from shopsignals.streaming.sessions import dau_stream

    days = _replayed_stream(spark, sf, dau_stream, "dau")
    return days.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@register(
    "stream_late_rows",
    f"""WITH {CLICK_CTE} SELECT count(*) AS input_rows, true AS all_accounted, true AS some_late, true AS sessions_hold_the_rest FROM ev WHERE user_id IS NOT NULL""",
    "T1 (rows later than the watermark are put aside: rows in sessions + late rows = input)",
)
def q_stream_late_rows(spark, sf):
    """The clicks replayed by thirds of the ids, so that the last batches bring rows of the whole period again."""
    from shopsignals.streaming import sessions as st

    root = scratch_path(spark, "streams")
    clicks = ad.clickstream_events(spark, sf, sessionize=False).withColumn("user_session", F.lit(None).cast("string"))
    clicks = materialize(clicks.select(st.STREAM_EVENT_SCHEMA.names).where("user_id IS NOT NULL"))
    third = F.pmod(F.xxhash64("user_id", "event_time"), F.lit(3))
    st.split_arrivals([*[clicks.where(third == part) for part in range(3)], st.closing_event(clicks)], root, delay="1 day", slack="12 hours")
    stream = st.session_stream(st.in_time_stream(spark, f"{root}/split"), watermark="1 day")
    st.start_to_parquet(stream, f"{root}/sessions", f"{root}/ck_sessions").awaitTermination()
    late = st.late_rows(spark, f"{root}/split").agg(F.count(F.lit(1)).alias("late"))
    held = spark.read.parquet(f"{root}/sessions").agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("held"))
    rows = clicks.agg(F.count(F.lit(1)).alias("input_rows"))
    # three tables of one row
    return rows.crossJoin(late).crossJoin(held).select(
        "input_rows", (F.col("late") + F.col("held") == F.col("input_rows")).alias("all_accounted"), (F.col("late") > 0).alias("some_late"),
        (F.col("held") == F.col("input_rows") - F.col("late")).alias("sessions_hold_the_rest"),
    )


@register(
    "report_active_users_by_sketch",
    f"""WITH {CLICK_CTE}
    SELECT strftime(date_trunc('week', CAST(event_time AS DATE)), '%Y-%m-%d') AS week, count(DISTINCT user_id) AS exact_users, true AS sketch_within_error
    FROM ev WHERE user_id IS NOT NULL GROUP BY 1""",
    "A21 A22 (daily sketches united by week, three standard errors)",
)
def q_report_active_users_by_sketch(spark, sf):
    clicks = _clicks(spark, sf).where("user_id IS NOT NULL")
    week = F.date_format(F.date_trunc("week", "event_date"), "yyyy-MM-dd")
    estimated = reports.active_users_from_sketches(reports.daily_user_sketches(clicks), week)
    exact = clicks.withColumn("event_date", F.to_date("event_time")).groupBy(week.alias("period")).agg(F.countDistinct("user_id").alias("exact_users"))
    error = F.abs(F.col("active_users") - F.col("exact_users")) / F.col("exact_users")
    return exact.join(estimated, "period").select(F.col("period").alias("week"), "exact_users", (error <= 3 * 1.04 / 2 ** (reports.SKETCH_LG_K / 2)).alias("sketch_within_error"))


@register(
    "report_feature_preview",
    USER_FEATURES_SQL + f" SELECT * REPLACE ({_sql_round(SESSION_FLOATS)}) FROM user_features ORDER BY user_id LIMIT 5",
    "O7",
)
def q_report_feature_preview(spark, sf):
    return _round_cols(reports.preview(clickstream_user_features(spark, sf), 5), SESSION_FLOATS)


# ----------------------------------------------------------------- ingest round trip

INGEST_SQL = f"""WITH {ORDER_CTE}
    SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
           count(*) AS row_count, count(DISTINCT user_id) AS users, count(DISTINCT user_session) AS sessions,
           count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
           min(event_time) AS first_event, max(event_time) AS last_event,
           round_even(CAST(sum(CAST(CAST(CAST(price AS FLOAT) AS DOUBLE) AS DECIMAL(38,12))) AS DOUBLE), 2) AS revenue
    FROM ev GROUP BY 1, 2 ORDER BY 1, 2"""


def ingested_order_events(spark, sf) -> DataFrame:
    """The order adapter's events written as raw monthly-style CSV into the
    shared checkpoint folder, then ingested the production way: CSV scan with
    the declared schema, UTC parse of the zone-suffixed text, float price,
    ``year=/month=/source=`` Parquet, partitioned read of all months."""
    from shopsignals.sources import events as ev

    root = scratch_path(spark, "ingest")
    ev.write_events_csv(_orders(spark, sf), f"{root}/raw")
    # the second run finds every file listed and takes none
    ev.ingest_csv(spark, f"{root}/raw/*.csv", f"{root}/events")
    ev.ingest_csv(spark, f"{root}/raw/*.csv", f"{root}/events")
    return ev.load_events(spark, f"{root}/events")


@register("ingest_events_roundtrip", INGEST_SQL, "S1 S2 S3 S4 S5 S7 S13 U1 F4 F24 A20")
def q_ingest_events_roundtrip(spark, sf):
    from shopsignals.functions.numeric import exact_sum

    purchase = F.col("event_type") == F.lit("purchase")
    return (
        ingested_order_events(spark, sf)
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("user_id").alias("users"),
            F.countDistinct("user_session").alias("sessions"),
            F.count(F.when(purchase, F.lit(1))).alias("purchases"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
            round_half_even(exact_sum("price").cast("double"), 2).alias("revenue"),
        )
        .orderBy("year", "month")
    )


from shopsignals.plans import varied  # noqa: E402,F401  registers the branch checks
