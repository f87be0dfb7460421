"""Blocked operators against brute force: sessionisation, running totals,
KS statistic, histogram overlay, ROC / PR sweeps, stratified split."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsignals.operators import shift, evaluation, profiles
from shopsignals.operators.running import global_rank, order_block, ranged, running_totals, value_at
from shopsignals.operators.sessionize import sessionize_by_gap


def _brute_sessions(rows, gap_s):
    out = {}
    by_user = {}
    for r in rows:
        by_user.setdefault(r[0], []).append(r)
    for u, rs in by_user.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        start, prev = None, None
        for _, ts, eid in rs:
            us = int((ts - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
            if prev is None or us - prev > gap_s * 1_000_000:
                start = us
            prev = us
            out[eid] = f"{u}-{start}"
    return out


def test_sessionize_matches_brute_force_across_blocks(spark):
    rng = random.Random(5)
    t0 = datetime(2024, 1, 1)
    rows, eid = [], 0
    for u in range(1, 8):
        t = t0
        for _ in range(rng.randint(1, 60)):
            # gaps from minutes to days, crossing day blocks; user 1 is "hot"
            t = t + timedelta(seconds=rng.choice([60, 3600, 11 * 3600, 13 * 3600, 40 * 3600, 0]))
            rows.append((u, t, eid))
            eid += 1
    for i in range(300):  # a hot user with many rows
        rows.append((99, t0 + timedelta(minutes=7 * i), eid))
        eid += 1
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp, event_id long")
    got = {r["event_id"]: r["user_session"] for r in sessionize_by_gap(df, tiebreak_cols=("event_id",), gap_seconds=12 * 3600, block_seconds=6 * 3600).collect()}
    assert got == _brute_sessions(rows, 12 * 3600)


def test_order_block_is_monotone(spark):
    vals = sorted({0.0, -0.0, 1e-300, -1e-300, 5e-324, 1.0, 1.0000001, 2.0, -2.0, -1.5, 1e300, -1e300, 0.5, 0.49999999}
                  | {random.Random(1).uniform(-1e6, 1e6) for _ in range(500)})
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select("v", order_block("v").alias("b")).orderBy("v").collect()
    blocks = [r["b"] for r in got]
    assert blocks == sorted(blocks)


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(9)
    rows = []
    for g in range(3):
        vals = np.unique(np.concatenate([rng.normal(0, 100, 400), rng.exponential(5, 400), [0.0]]))
        for v in vals:
            rows.append((g, float(v), int(rng.integers(0, 5))))
    pdf = pd.DataFrame(rows, columns=["g", "v", "n"])
    df = spark.createDataFrame(pdf)
    for desc in (False, True):
        got = running_totals(df, ["g"], "v", ["n"], descending=desc).toPandas()
        exp = pdf.sort_values(["g", "v"], ascending=[True, not desc])
        exp["cum_n"] = exp.groupby("g")["n"].cumsum()
        m = got.merge(exp, on=["g", "v"], suffixes=("", "_e"))
        assert len(m) == len(pdf)
        assert (m["cum_n"] == m["cum_n_e"]).all()


def test_global_rank(spark):
    ids = random.Random(3).sample(range(10_000), 700)
    df = spark.createDataFrame([(i,) for i in ids], "user_id long")
    got = {r["user_id"]: r["row_pos"] for r in global_rank(df, "user_id").collect()}
    assert got == {u: i + 1 for i, u in enumerate(sorted(ids))}


def _ks_brute(a, b):
    a, b = np.sort(a), np.sort(b)
    allv = np.concatenate([a, b])
    cdf1 = np.searchsorted(a, allv, side="right") / len(a)
    cdf2 = np.searchsorted(b, allv, side="right") / len(b)
    return float(np.max(np.abs(cdf1 - cdf2)))


def test_ks_statistic_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = pd.DataFrame({"x": rng.normal(0, 1, 800).round(2), "y": rng.integers(0, 5, 800).astype(float)})
    cur = pd.DataFrame({"x": rng.normal(0.3, 1, 300).round(2), "y": rng.integers(0, 6, 300).astype(float)})
    det = {r["feature"]: r for r in shift.ks_details(spark.createDataFrame(base), spark.createDataFrame(cur), ["x", "y"]).collect()}
    for f in ["x", "y"]:
        d = _ks_brute(base[f].values, cur[f].values)
        assert det[f]["ks_statistic"] == pytest.approx(np.round(d, 4))
        n, m = len(base), len(cur)
        lam = d * np.sqrt(n * m / (n + m))
        p = 1.0 if lam < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 101))))
        assert det[f]["p_value"] == pytest.approx(round(p, 6), abs=1e-6)
        assert det[f]["ref_mean"] == pytest.approx(np.round(base[f].mean(), 4))


def test_ks_pvalue_is_one_rule_at_every_size(spark):
    """Same D at growing sample sizes: the p-value falls smoothly, without a step."""
    sizes = [9_990, 9_999, 10_000, 10_001, 10_010]
    df = spark.createDataFrame([(float(n),) for n in sizes], "n double")
    got = [r[0] for r in df.select(shift.ks_pvalue(F.lit(0.02), F.col("n"), F.col("n"))).collect()]
    for n, p in zip(sizes, got):
        lam = 0.02 * math.sqrt(n / 2)
        assert p == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)))
    steps = [a - b for a, b in zip(got, got[1:])]
    assert all(0 < s < 2e-4 for s in steps)


def test_shift_fills_missing_values_with_zero(spark):
    a = spark.createDataFrame([(4.0,), (3.0,), (None,), (float("nan"),)], "x double")
    r = shift.ks_details(a, a, ["x"]).first()
    assert (r["n_ref"], r["ref_mean"]) == (4, 1.75)
    plan = shift.ks_details(a, a, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ks_identical_and_disjoint(spark):
    a = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    b = spark.createDataFrame([(float(i + 1000),) for i in range(50)], "x double")
    same = shift.ks_details(a, a, ["x"]).collect()[0]
    assert same["ks_statistic"] == 0.0 and same["p_value"] == 1.0 and not same["shift_detected"]
    apart = shift.ks_details(a, b, ["x"]).collect()[0]
    assert apart["ks_statistic"] == 1.0 and apart["shift_detected"]


def test_overlay_matches_numpy_histogram(spark):
    rng = np.random.default_rng(8)
    a = rng.gamma(2.0, 3.0, 500).round(3)
    b = rng.gamma(2.5, 3.0, 200).round(3)
    da = spark.createDataFrame([(float(x),) for x in a], "x double")
    db = spark.createDataFrame([(float(x),) for x in b], "x double")
    got = shift.distribution_overlay(da, db, ["x"]).toPandas().set_index("bin").sort_index()
    bins = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 40)
    ha, _ = np.histogram(a, bins=bins, density=True)
    hb, _ = np.histogram(b, bins=bins, density=True)
    for i in range(39):
        if i in got.index:
            assert got.loc[i, "baseline_density"] == pytest.approx(ha[i])
            assert got.loc[i, "current_density"] == pytest.approx(hb[i])
        else:
            assert ha[i] == 0 and hb[i] == 0


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = sum(((p > n) + 0.5 * (p == n)) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def _ap_brute(y, s):
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        prec = tp / pred.sum()
        rec = tp / (y == 1).sum()
        ap += (rec - prev_r) * prec
        prev_r = rec
    return ap


def test_auc_by_position_equals_brute_force(spark):
    """Arrays of scores with ties, null labels and several ranges per score, without a row per score."""
    rng = np.random.default_rng(8)
    y, scores = rng.integers(0, 2, 700), np.column_stack([rng.integers(0, 5, 700), rng.normal(size=700), np.zeros(700), rng.integers(0, 90, 700) / 7])
    df = spark.createDataFrame([(None if k % 50 == 0 else int(a), [float(v) for v in b]) for k, (a, b) in enumerate(zip(y, scores))], "label int, scores array<double>").repartition(5)
    y = np.where(np.arange(700) % 50 == 0, 0, y)
    for part_rows in (1000, 100, 9):
        got = {r["position"]: r["roc_auc"] for r in evaluation.auc_by_position(df, lambda rows: rows, part_rows=part_rows).collect()}
        assert sorted(got) == [0, 1, 2, 3]
        for k in range(4):
            assert got[k] == pytest.approx(_auc_brute(y, scores[:, k]), abs=1e-12)
    assert [r["roc_auc"] for r in evaluation.auc_by_position(df.where("label = 1"), lambda rows: rows).collect()] == [None] * 4
    assert evaluation.auc_by_position(df.limit(0), lambda rows: rows).count() == 0


def test_roc_auc_and_average_precision(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(0.3 * y + rng.uniform(0, 0.7, 400), 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert evaluation.roc_auc(df).collect()[0][0] == pytest.approx(_auc_brute(y, s))
    assert evaluation.average_precision(df).collect()[0]["average_precision"] == pytest.approx(_ap_brute(y, s))
    cm = {(r["actual"], r["predicted"]): r["n"] for r in evaluation.confusion_matrix(df).collect()}
    assert cm[(1, 1)] == int(((s >= 0.5) & (y == 1)).sum())
    assert sum(cm.values()) == 400
    h = evaluation.score_histogram(df).toPandas()
    for lab in (0, 1):
        hh, _ = np.histogram(s[y == lab], bins=np.linspace(0, 1, 50), density=True)
        got = h[h["label"] == lab].set_index("bin")["density"]
        for i, v in got.items():
            assert v == pytest.approx(hh[i])


def test_stratified_split_exact_counts(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "user_id long, churned int")
    out = profiles.stratified_split(df, "churned", 0.8, 42)
    c = {(r["churned"], r["is_test"]): r["n"] for r in out.groupBy("churned", "is_test").agg(F.count("*").alias("n")).collect()}
    n1 = sum(1 for _, lab in rows if lab == 1)
    assert c[(1, False)] == int(n1 * 0.8) and c[(1, True)] == n1 - int(n1 * 0.8)
    again = {r["user_id"]: r["is_test"] for r in profiles.stratified_split(df, "churned", 0.8, 42).collect()}
    first = {r["user_id"]: r["is_test"] for r in out.collect()}
    assert again == first


def test_describe_quartiles_match_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(5, 2, 301).round(1)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = profiles.describe(df, ["x"]).collect()[0]
    for q, name in [(25, "p25"), (50, "p50"), (75, "p75")]:
        assert r[name] == pytest.approx(np.percentile(x, q))
    assert r["std"] == pytest.approx(np.std(x, ddof=1))


def test_running_totals_of_null_groups_and_ties(spark):
    rows = [(None, 2.0, 1, 1), (None, 1.0, 2, 1), ("a", 5.0, 1, 10), ("a", 5.0, 2, 20), ("a", None, 3, 99), ("b", float("nan"), 1, 7), ("b", -1.0, 2, 1)]
    df = spark.createDataFrame(rows, "g string, v double, k int, n long").repartition(3)
    got = {(r["g"], r["k"]): r["cum_n"] for r in running_totals(df, ["g"], "v", ["n"], tiebreak_cols=["k"]).collect()}
    assert got == {(None, 2): 1, (None, 1): 2, ("a", 1): 10, ("a", 2): 30, ("b", 2): 1, ("b", 1): 8}


def test_value_at_and_positional_split(spark):
    ids = random.Random(12).sample(range(-5000, 10_000_000), 997)
    df = spark.createDataFrame([(i,) for i in [*ids, None]], "user_id long")
    srt = sorted(ids)
    for k in (1, 2, 500, 797, 997):
        assert value_at(df, "user_id", k) == srt[k - 1] == value_at(df, "user_id", k, target=3)
    assert value_at(df, "user_id", 0) is None and value_at(df, "user_id", 998) is None and value_at(df.limit(0), "user_id", 1) is None
    base, cur = shift.positional_split(df.where("user_id IS NOT NULL"), "user_id", 0.8)
    cut = int(len(ids) * 0.8)
    assert sorted(r[0] for r in base.collect()) == srt[:cut]
    assert sorted(r[0] for r in cur.collect()) == srt[cut:]
    # both sides are plain filters by a literal
    assert "Subquery" not in base._jdf.queryExecution().toString()
    none, all_rows = shift.positional_split(df, "user_id", 0.0)
    assert none.count() == 0 and all_rows.count() == 998


def test_value_at_of_repeated_and_large_values(spark):
    values = [2**62 + k for k in range(40)] + [5] * 300 + [-(2**61)] * 3
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 3, 4, 150, 303, 304, 320, 343):
        assert value_at(df, "v", k, target=10) == sorted(values)[k - 1]
    scores = spark.range(50_000).select((F.lit(0.9) + F.col("id") / 500_000).alias("v"))
    assert value_at(scores, "v", lambda n: n // 2, target=100) == pytest.approx(0.9 + 24_999 / 500_000)


def test_ranges_fit_narrow_values(spark):
    """A million ids of one narrow range: parts follow each other and hold about equal numbers."""
    ids = spark.range(1_000_000).select((F.col("id") * 7 + 512_000_000).alias("v"), F.lit(1).alias("n"))
    parts = ranged(ids, [], "v").groupBy("_part").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_part").collect()
    assert len(parts) > 1 and max(r["n"] for r in parts) <= 3_000_000 / len(parts)
    assert all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:]))
    total = running_totals(ids, [], "v", ["n"]).agg(F.max("cum_n"), F.sum("cum_n")).first()
    assert tuple(total) == (1_000_000, 1_000_000 * 1_000_001 // 2)
    for k in (1, 123_456, 1_000_000):
        assert value_at(ids, "v", k, target=10_000) == (k - 1) * 7 + 512_000_000


def test_stratified_split_of_ties_and_missing_labels(spark):
    """Equal hashes are told apart by the key; rows without a label are training rows."""
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3 == 0) for i in range(400)], "user_id long, churned boolean")
    df = df.withColumn("churned", F.col("churned").cast("int"))
    got = profiles.stratified_split(df, "churned", 0.75, 7).collect()
    for label in (0, 1):
        own = [r for r in got if r["churned"] == label]
        assert sum(not r["is_test"] for r in own) == int(len(own) * 0.75)
    assert not any(r["is_test"] for r in got if r["churned"] is None)
    assert {r["user_id"]: r["is_test"] for r in profiles.stratified_split(df.repartition(5), "churned", 0.75, 7).collect()} == {r["user_id"]: r["is_test"] for r in got}


def test_degenerate_inputs_do_not_fail(spark):
    # one class only; a constant feature; a feature empty on one side
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.7)], "label int, score double")
    r = evaluation.summary_curves(one_class).first()
    assert r["roc_auc"] is None and r["average_precision"] == 1.0
    assert all(p["fpr"] is None for p in evaluation.roc_curve(one_class).collect())
    a = spark.createDataFrame([(1.0, None), (1.0, None)], "x double, y double")
    b = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    det = {r["feature"]: r for r in shift.ks_details(a, b, ["x", "y"]).collect()}
    assert det["x"]["ks_statistic"] == 0.0 and det["y"]["ref_mean"] == 0.0 and det["y"]["ks_statistic"] == 1.0
    ov = shift.distribution_overlay(a, b, ["x"]).collect()
    assert ov and ov[0]["baseline_density"] is None
