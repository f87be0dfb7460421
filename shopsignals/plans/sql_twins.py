"""DuckDB text of the feature families (the oracle side of the checks).

Each function returns CTE bodies written against a view ``ev`` with the
event-table columns.  They restate the definitions independently of the
DataFrame plans (plain windows and joins, no blocking), so a shared mistake
in a helper cannot hide.
"""

from __future__ import annotations

import math
from collections.abc import Sequence


def bounds_cte() -> str:
    return """bounds AS (
      SELECT min(event_time) AS t_min, max(event_time) AS t_max,
             epoch_us(min(event_time)) AS t_min_us, epoch_us(max(event_time)) AS t_max_us
      FROM ev)"""


def session_features_ctes(horizon_days: float) -> str:
    horizon_us = int(horizon_days * 86400 * 1_000_000)
    return f"""{bounds_cte()},
    sess AS (
      SELECT user_id, user_session,
             max(event_time) AS session_end,
             count(event_type) AS total_events,
             sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views,
             sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS cart_adds,
             sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
             coalesce(sum(CAST(CASE WHEN event_type = 'purchase' THEN price END AS DECIMAL(38,12))),
                      CAST(0 AS DECIMAL(38,12))) AS session_revenue,
             max(CASE WHEN event_type = 'purchase' THEN event_time END) AS last_purchase_time,
             greatest(epoch_us(max(event_time)) - epoch_us(min(event_time)), 0) AS duration_us
      FROM ev WHERE user_id IS NOT NULL
      GROUP BY user_id, user_session),
    su AS (
      SELECT user_id,
             max(CASE WHEN user_session IS NOT NULL THEN session_end END) AS last_session,
             count(CASE WHEN user_session IS NOT NULL THEN 1 END) AS total_sessions,
             CAST(sum(CASE WHEN user_session IS NOT NULL THEN session_revenue END) AS DOUBLE) AS total_revenue,
             CAST(sum(CASE WHEN user_session IS NOT NULL THEN session_revenue END) AS DOUBLE)
               / count(CASE WHEN user_session IS NOT NULL THEN session_revenue END) AS avg_session_revenue,
             avg(CASE WHEN user_session IS NOT NULL THEN total_events END) AS avg_events_per_session,
             CAST(sum(CAST(CASE WHEN user_session IS NOT NULL THEN duration_us END AS DECIMAL(38,0))) AS DOUBLE)
               / count(CASE WHEN user_session IS NOT NULL THEN duration_us END) / 1e6 / 60.0 AS avg_duration_min,
             CAST(sum(CASE WHEN user_session IS NOT NULL THEN views END) AS BIGINT) AS total_views,
             CAST(sum(CASE WHEN user_session IS NOT NULL THEN cart_adds END) AS BIGINT) AS total_cart_adds,
             CAST(sum(CASE WHEN user_session IS NOT NULL THEN purchases END) AS BIGINT) AS total_purchases,
             count(CASE WHEN user_session IS NOT NULL AND cart_adds > 0 THEN 1 END) AS cart_sessions,
             count(CASE WHEN user_session IS NOT NULL AND cart_adds > 0 AND purchases = 0 THEN 1 END) AS abandoned,
             max(last_purchase_time) AS last_purchase_time
      FROM sess GROUP BY user_id),
    session_features AS (
      SELECT su.user_id,
             round_even((b.t_max_us - epoch_us(last_session)) / 1e6 / 86400.0, 1) AS recency_days,
             total_sessions,
             round_even(total_sessions / greatest((b.t_max_us - b.t_min_us) / 1e6 / 86400.0 / 7.0, 1.0), 4)
               AS sessions_per_week,
             total_revenue, avg_session_revenue, avg_events_per_session, avg_duration_min,
             total_views, total_cart_adds, total_purchases,
             coalesce(round_even(CAST(abandoned AS DOUBLE) / nullif(cart_sessions, 0), 4), 0.0)
               AS cart_abandonment_rate,
             round_even(coalesce(CAST(total_purchases AS DOUBLE) / nullif(total_views, 0), 0.0), 4)
               AS purchase_conversion_rate,
             CAST(CASE WHEN last_purchase_time IS NULL
                       OR epoch_us(last_purchase_time) < b.t_max_us - {horizon_us} THEN 1 ELSE 0 END AS INTEGER)
               AS churned
      FROM su CROSS JOIN bounds b
      WHERE total_sessions > 0)"""


def temporal_features_ctes(with_bounds: bool = True) -> str:
    two_pi = repr(2 * math.pi)
    head = bounds_cte() + "," if with_bounds else ""
    return f"""{head}
    tparts AS (
      SELECT user_id, event_time, hour(event_time) AS h, isodow(event_time) - 1 AS d,
             dayofmonth(event_time) AS dom,
             2 * epoch_us(event_time) AS two_t, b.t_min_us + b.t_max_us AS mid2
      FROM ev CROSS JOIN bounds b WHERE user_id IS NOT NULL),
    hour_mode AS (
      SELECT user_id, h FROM (
        SELECT user_id, h, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, h) AS rn
        FROM tparts WHERE h IS NOT NULL GROUP BY user_id, h) WHERE rn = 1),
    day_mode AS (
      SELECT user_id, d FROM (
        SELECT user_id, d, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, d) AS rn
        FROM tparts WHERE d IS NOT NULL GROUP BY user_id, d) WHERE rn = 1),
    tagg AS (
      SELECT user_id,
             avg(CASE WHEN d IN (5, 6) THEN 1.0 ELSE 0.0 END) AS weekend,
             avg(CASE WHEN h BETWEEN 22 AND 23 OR h BETWEEN 0 AND 4 THEN 1.0 ELSE 0.0 END) AS night,
             avg(CASE WHEN dom BETWEEN 1 AND 3 OR dom BETWEEN 14 AND 16 THEN 1.0 ELSE 0.0 END) AS payday,
             sum(CASE WHEN two_t <= mid2 THEN 1 ELSE 0 END) AS first_half,
             sum(CASE WHEN two_t > mid2 THEN 1 ELSE 0 END) AS second_half
      FROM tparts GROUP BY user_id),
    temporal_features AS (
      SELECT t.user_id,
             round_even(weekend, 4) AS weekend_activity_ratio,
             round_even(night, 4) AS night_owl_score,
             round_even(payday, 4) AS payday_activity_ratio,
             round_even((second_half - first_half) / (first_half + second_half + 1), 4) AS activity_trend,
             round_even(sin({two_pi} * hm.h / 24), 4) AS preferred_hour_sin,
             round_even(cos({two_pi} * hm.h / 24), 4) AS preferred_hour_cos,
             round_even(sin({two_pi} * dm.d / 7), 4) AS preferred_day_sin,
             round_even(cos({two_pi} * dm.d / 7), 4) AS preferred_day_cos
      FROM tagg t LEFT JOIN hour_mode hm ON hm.user_id = t.user_id
                  LEFT JOIN day_mode dm ON dm.user_id = t.user_id)"""


def category_features_ctes(affinity: Sequence[str], onehot: Sequence[str]) -> str:
    aff_counts = ",\n".join(
        f"sum(CASE WHEN event_type = 'view' AND top = '{c}' THEN 1 ELSE 0 END) AS n_{i}"
        for i, c in enumerate(affinity)
    )
    aff_cols = ",\n".join(
        f"coalesce(round_even(CAST(n_{i} AS DOUBLE) / nullif(views, 0), 4), 0.0) AS {c}_affinity"
        for i, c in enumerate(affinity)
    )
    hot_cols = ",\n".join(
        f"CAST(CASE WHEN tm.top = '{c}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS topcategory_{c}" for c in sorted(onehot)
    )
    return f"""ctop AS (
      SELECT *, coalesce(split_part(category_code, '.', 1), 'unknown') AS top
      FROM ev WHERE user_id IS NOT NULL),
    cagg AS (
      SELECT user_id,
             sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views,
             sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
             CAST(sum(CAST(CASE WHEN event_type = 'purchase' THEN price END AS DECIMAL(38,12))) AS DOUBLE) / nullif(count(CASE WHEN event_type = 'purchase' THEN price END), 0) AS avg_purchase_price,
             stddev_samp(CASE WHEN event_type = 'purchase' THEN price END) AS std_purchase_price,
             CAST(sum(CAST(CASE WHEN event_type = 'view' THEN price END AS DECIMAL(38,12))) AS DOUBLE) / nullif(count(CASE WHEN event_type = 'view' THEN price END), 0) AS avg_view_price,
             {aff_counts}
      FROM ctop GROUP BY user_id),
    top_mode AS (
      SELECT user_id, top FROM (
        SELECT user_id, top, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, top) AS rn
        FROM ctop WHERE event_type = 'view' GROUP BY user_id, top) WHERE rn = 1),
    cat_counts AS (
      SELECT user_id, top, count(*) AS n FROM ctop WHERE event_type = 'view' GROUP BY user_id, top),
    entropy AS (
      SELECT user_id, sum(-p * log2(p + 1e-10)) AS h FROM (
        SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM cat_counts) GROUP BY user_id),
    loyalty AS (
      SELECT user_id, max(n) / sum(n) AS l FROM (
        SELECT user_id, brand, count(*) AS n FROM ctop
        WHERE event_type = 'view' AND brand IS NOT NULL GROUP BY user_id, brand) GROUP BY user_id),
    category_features AS (
      SELECT c.user_id,
             coalesce(round_even(e.h, 4), 0.0) AS category_diversity,
             {aff_cols},
             coalesce(round_even(lo.l, 4), 0.0) AS brand_loyalty_score,
             coalesce(round_even(avg_purchase_price, 2), 0.0) AS avg_price_point,
             coalesce(round_even(std_purchase_price, 2), 0.0) AS price_sensitivity,
             coalesce(round_even(avg_view_price, 2), 0.0) AS avg_browse_price,
             {hot_cols}
      FROM cagg c LEFT JOIN entropy e ON e.user_id = c.user_id
                  LEFT JOIN loyalty lo ON lo.user_id = c.user_id
                  LEFT JOIN top_mode tm ON tm.user_id = c.user_id
      WHERE c.views > 0 OR c.purchases > 0)"""


def user_features_ctes(horizon_days, affinity, onehot) -> str:
    return f"""{session_features_ctes(horizon_days)},
    {temporal_features_ctes(with_bounds=False)},
    {category_features_ctes(affinity, onehot)},
    user_features AS (
      SELECT * FROM session_features s
      JOIN temporal_features t USING (user_id)
      JOIN category_features c USING (user_id))"""
