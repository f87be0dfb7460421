"""Feature families on the seven-shopper fixture, checked against a
brute-force pandas restatement of the definitions, plus hand-made edge rows."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from shopsignals.operators import features as feat
from tests.conftest import events_df

TEMPORAL_COLS = [
    "user_id", "weekend_activity_ratio", "night_owl_score", "payday_activity_ratio", "activity_trend",
    "preferred_hour_sin", "preferred_hour_cos", "preferred_day_sin", "preferred_day_cos",
]
AFF = ["electronics", "apparel", "appliances", "furniture", "sport", "kids", "auto"]


def test_merged_features_equal_the_three_families(spark):
    """Roll-ups of the cells: rows without user, session, time or brand, and events on both sides of the midpoint's hour."""
    from datetime import datetime, timedelta

    from tests.conftest import events_df

    t0 = datetime(2021, 5, 1, 8)
    rows = [
        {"event_time": t0 + timedelta(minutes=37 * k + 11 * u), "event_type": ("view", "cart", "purchase", "view", None)[(k + u) % 5], "price": 3.5 + (k * 7 + u) % 13 if k % 6 else None,
         "category_code": ("toys.car", "food", None)[(k + u) % 3], "brand": ("x", "y", None)[k % 3], "user_id": u, "user_session": f"s{u}-{k // 4}" if k % 7 else None}
        for u in range(6) for k in range(40)
    ]
    rows += [{"event_time": t0 - timedelta(days=3), "event_type": "view", "user_id": None, "user_session": "z"}, {"event_time": None, "event_type": "view", "user_id": 1, "user_session": "s1-0", "price": 2.0}]
    # a crowd in the hour that holds the midpoint of the period
    lo, hi = t0 - timedelta(days=3), max(r["event_time"] for r in rows if r["event_time"])
    middle = lo + (hi - lo) / 2
    rows += [{"event_time": middle + timedelta(seconds=s), "event_type": "view", "price": 1.25, "user_id": s % 4, "user_session": f"m{s}", "brand": "m", "category_code": "toys.doll"} for s in range(-9, 10)]
    ev = events_df(spark, rows).repartition(5)
    args = (["toys", "food"], ["toys", "unknown"])
    want = feat.session_features(ev).join(feat.temporal_features(ev), "user_id").join(feat.category_features(ev, *args), "user_id")
    got = feat.user_features(ev, affinity_categories=args[0], onehot=args[1])
    assert set(got.columns) == set(want.columns)
    w, g = (df.select(sorted(df.columns)).toPandas().sort_values("user_id").reset_index(drop=True) for df in (want, got))
    assert len(g) == 6
    pd.testing.assert_frame_equal(g, w, check_dtype=False, rtol=1e-12)
    assert (g["activity_trend"].abs() < 0.9).any() and feat.user_features(ev.limit(0), onehot=["toys"]).count() == 0
    assert [c for c in feat.user_features(ev, affinity_categories=["toys"]).columns if c.startswith("topcategory_")] == ["topcategory_food", "topcategory_toys", "topcategory_unknown"]


def _brute_temporal(pdf):
    df = pdf.copy()
    ts = pd.to_datetime(df["event_time"])
    df["h"], df["d"], df["dom"] = ts.dt.hour, ts.dt.dayofweek, ts.dt.day
    tmin, tmax = ts.min(), ts.max()
    mid = tmin + (tmax - tmin) / 2
    out = {}
    for u, g in df.groupby("user_id"):
        gts = pd.to_datetime(g["event_time"])
        first, second = (gts <= mid).sum(), (gts > mid).sum()
        h = g["h"].value_counts()
        h = min(h[h == h.max()].index)
        d = g["d"].value_counts()
        d = min(d[d == d.max()].index)
        out[u] = {
            "weekend_activity_ratio": np.round(g["d"].isin([5, 6]).mean(), 4),
            "night_owl_score": np.round((g["h"].between(22, 23) | g["h"].between(0, 4)).mean(), 4),
            "payday_activity_ratio": np.round((g["dom"].between(1, 3) | g["dom"].between(14, 16)).mean(), 4),
            "activity_trend": np.round((second - first) / (first + second + 1), 4),
            "preferred_hour_sin": np.round(np.sin(2 * np.pi * h / 24), 4),
            "preferred_day_cos": np.round(np.cos(2 * np.pi * d / 7), 4),
        }
    return out


def test_temporal_features_values(sample_events, sample_events_pd):
    got = {r["user_id"]: r for r in feat.temporal_features(sample_events).collect()}
    want = _brute_temporal(sample_events_pd)
    for u, w in want.items():
        for k, v in w.items():
            assert got[u][k] == pytest.approx(v, abs=1e-9), (u, k)


def test_session_features_values(sample_events, sample_events_pd):
    got = {r["user_id"]: r for r in feat.session_features(sample_events).collect()}
    pdf = sample_events_pd.copy()
    ts = pd.to_datetime(pdf["event_time"])
    pdf["ts"] = ts
    tmax, tmin = ts.max(), ts.min()
    weeks = max((tmax - tmin).total_seconds() / 86400 / 7, 1)
    for u, g in pdf.groupby("user_id"):
        sess = g.groupby("user_session")
        n_sess = sess.ngroups
        views = (g["event_type"] == "view").sum()
        purch = (g["event_type"] == "purchase").sum()
        carts = [((s["event_type"] == "cart").sum() > 0, (s["event_type"] == "purchase").sum() == 0) for _, s in sess]
        with_cart = [c for c, _ in carts]
        abandoned = [c and p for c, p in carts]
        r = got[u]
        assert r["total_sessions"] == n_sess
        assert r["total_views"] == views
        assert r["total_purchases"] == purch
        assert r["sessions_per_week"] == np.round(n_sess / weeks, 4)
        assert r["purchase_conversion_rate"] == np.round(purch / views if views else 0.0, 4)
        rate = sum(abandoned) / sum(with_cart) if sum(with_cart) else 0.0
        assert r["cart_abandonment_rate"] == pytest.approx(np.round(rate, 4))
        last = sess["ts"].max().max()
        assert r["recency_days"] == np.round((tmax - last).total_seconds() / 86400, 1)
        lp = g.loc[g["event_type"] == "purchase", "ts"].max()
        churned = int(pd.isna(lp) or lp < tmax - pd.Timedelta(days=14))
        assert r["churned"] == churned
        rev = g.loc[g["event_type"] == "purchase", "price"].sum()
        assert r["total_revenue"] == pytest.approx(rev)


def test_category_features_values(sample_events, sample_events_pd):
    got = {r["user_id"]: r for r in feat.category_features(sample_events, AFF).collect()}
    pdf = sample_events_pd.copy()
    pdf["top"] = pdf["category_code"].str.split(".").str[0].fillna("unknown")
    for u, g in pdf.groupby("user_id"):
        v = g[g["event_type"] == "view"]
        p = g[g["event_type"] == "purchase"]
        shares = v["top"].value_counts(normalize=True)
        ent = float(-(shares * np.log2(shares + 1e-10)).sum())
        bv = v[v["brand"].notna()]["brand"].value_counts()
        r = got[u]
        assert r["category_diversity"] == pytest.approx(np.round(ent, 4))
        assert r["electronics_affinity"] == pytest.approx(np.round((v["top"] == "electronics").mean(), 4))
        assert r["brand_loyalty_score"] == pytest.approx(np.round(bv.iloc[0] / bv.sum(), 4))
        assert r["avg_price_point"] == pytest.approx(np.round(p["price"].mean(), 2) if len(p) else 0.0)
        spread = p["price"].std(ddof=1)
        assert r["price_sensitivity"] == pytest.approx(0.0 if pd.isna(spread) else np.round(spread, 2))
        assert r["avg_browse_price"] == pytest.approx(np.round(v["price"].mean(), 2))
        counts = v["top"].value_counts()
        top = min(counts[counts == counts.max()].index)
        for c in ["apparel", "appliances", "electronics", "unknown"]:
            assert r[f"topcategory_{c}"] == (1.0 if c == top else 0.0)


def test_merged_one_row_per_user_no_nulls(sample_events, sample_events_pd):
    m = feat.user_features(sample_events).toPandas()
    assert len(m) == sample_events_pd["user_id"].nunique()
    assert m["user_id"].is_unique
    assert m.isnull().sum().sum() == 0


# ---------------------------------------------------------------- edge rows

T0 = datetime(2024, 1, 1)


def ev(user, hours, etype="view", session="s", price=10.0, code="electronics.phone", brand="apple"):
    return {
        "event_time": T0 + timedelta(hours=hours), "event_type": etype, "product_id": 1, "category_id": 1,
        "category_code": code, "brand": brand, "price": price, "user_id": user, "user_session": session,
    }


def test_churn_boundary_exactly_horizon_is_not_churned(spark):
    rows = [ev(1, 0, "purchase"), ev(1, 14 * 24, "view"), ev(2, -1, "purchase", session="t"), ev(2, 1, "view", session="t")]
    got = {r["user_id"]: r["churned"] for r in feat.session_features(events_df(spark, rows), 14).collect()}
    assert got[1] == 0  # last purchase exactly 14 days before the last event
    assert got[2] == 1


def test_mode_tie_takes_lower_hour(spark):
    rows = [ev(1, 5), ev(1, 5 + 24), ev(1, 3), ev(1, 3 + 24)]
    t = feat.temporal_features(events_df(spark, rows)).collect()[0]
    assert t["preferred_hour_sin"] == np.round(np.sin(2 * np.pi * 3 / 24), 4)


def test_single_purchase_price_sensitivity_zero(spark):
    rows = [ev(1, 0, "purchase", price=99.0), ev(1, 1, "view")]
    c = feat.category_features(events_df(spark, rows), AFF).collect()[0]
    assert c["price_sensitivity"] == 0.0 and c["avg_price_point"] == 99.0


def test_cart_only_user_absent_from_merged(spark):
    rows = [ev(1, 0, "cart"), ev(1, 1, "cart"), ev(2, 0, "view"), ev(2, 2, "purchase")]
    m = feat.user_features(events_df(spark, rows)).collect()
    assert [r["user_id"] for r in m] == [2]


def test_purchases_without_views(spark):
    rows = [ev(1, 0, "purchase"), ev(1, 1, "purchase"), ev(2, 0, "view", code="apparel.x")]
    m = {r["user_id"]: r for r in feat.user_features(events_df(spark, rows)).collect()}
    assert m[1]["purchase_conversion_rate"] == 0.0
    assert all(m[1][c] == 0.0 for c in m[1].asDict() if c.startswith("topcategory_"))


def test_null_session_ignored_in_sessions_but_counts_for_bounds_and_purchase(spark):
    rows = [ev(1, 0, "view", session="a"), ev(1, 30 * 24, "purchase", session=None), ev(2, 0, "view", session="b")]
    s = {r["user_id"]: r for r in feat.session_features(events_df(spark, rows), 14).collect()}
    assert s[1]["total_sessions"] == 1
    assert s[1]["total_purchases"] == 0  # the purchase is in the null session
    assert s[1]["churned"] == 0  # but it is the last purchase
    assert s[1]["recency_days"] == 30.0  # bounds include the null-session row


def test_null_brand_everywhere_loyalty_zero(spark):
    rows = [ev(1, 0, brand=None), ev(1, 1, brand=None)]
    c = feat.category_features(events_df(spark, rows), AFF).collect()[0]
    assert c["brand_loyalty_score"] == 0.0


def test_ratio_one_32nd_rounds_to_even(spark):
    rows = [ev(1, i, "view") for i in range(32)] + [ev(1, 40, "purchase")]
    s = feat.session_features(events_df(spark, rows)).collect()[0]
    assert s["purchase_conversion_rate"] == 0.0312
