"""Scalar helpers: cyclical encoding, entropy, category path, rounding, text."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopsignals.functions.category import top_category
from shopsignals.functions.numeric import exact_avg, exact_sum, round_half_even
from shopsignals.functions.text import format_fixed, format_percent, python_str
from shopsignals.functions.timeparts import cyclical_encode


def _one_col(spark, values, ddl="x double"):
    return spark.createDataFrame([(v,) for v in values], ddl)


@pytest.mark.parametrize("period", [5, 7, 24, 31])
def test_cyclical_encode_lies_on_the_circle(spark, period):
    df = _one_col(spark, list(range(-2, 2 * period)), "x int")
    s, c = cyclical_encode("x", period)
    for r in df.select("x", s.alias("s"), c.alias("c")).collect():
        assert r["s"] ** 2 + r["c"] ** 2 == pytest.approx(1.0, abs=1e-9)
        assert r["s"] == pytest.approx(math.sin(2 * math.pi * r["x"] / period), abs=1e-9)
        assert r["c"] == pytest.approx(math.cos(2 * math.pi * (r["x"] + period) / period), abs=1e-9)


@pytest.mark.parametrize("counts", [[7], [3, 3], [1, 2, 4], [10, 1, 1, 1, 1], [5] * 8])
def test_view_entropy(spark, counts):
    from shopsignals.operators.features import _view_entropy

    rows = [(1, f"shelf{i}", None, n) for i, n in enumerate(counts)]
    got = _view_entropy(spark.createDataFrame(rows, "user_id long, _top string, brand string, _n long")).first()["_entropy"]
    share = np.array(counts) / sum(counts)
    assert got == pytest.approx(-(share * np.log2(share)).sum(), abs=1e-8)
    assert round(got, 4) >= 0


def test_top_category_is_the_first_path_step(spark):
    paths = {"garden.tools.rake": "garden", "garden": "garden", ".odd": "", "a.b.c.d": "a", None: "unknown"}
    df = _one_col(spark, list(paths), "x string")
    assert {r["x"]: r["t"] for r in df.select("x", top_category("x").alias("t")).collect()} == paths


def test_round_half_even_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = [1 / 32, 3 / 20000, 2.675, 0.125, -0.125, 12.345, 0.5, 1.5, 2.5]
    vals += [int(a) / int(b) for a, b in rng.integers(1, 300, size=(300, 2))]
    df = _one_col(spark, vals)
    got = df.select("x", round_half_even("x", 4).alias("r"), round_half_even("x", 2).alias("r2")).collect()
    for row in got:
        assert row["r"] == np.round(row["x"], 4)
        assert row["r2"] == np.round(row["x"], 2)
    assert round_half_even  # 1/32 → 0.0312 (ties to even)
    assert [r["r"] for r in got][0] == 0.0312


def test_format_fixed_matches_python(spark):
    rng = random.Random(11)
    vals = [0.35, 0.25, 28.5, 27.5, 0.05, 0.15, 2.675, -0.35, 1e-7, 123456.785]
    vals += [round(rng.uniform(0, 50), rng.choice([1, 2, 3, 4])) for _ in range(300)]
    df = _one_col(spark, vals)
    rows = df.select(
        "x", format_fixed("x", 0).alias("f0"), format_fixed("x", 1).alias("f1"), format_percent("x", 0).alias("p0"),
        format_percent("x", 1).alias("p1"),
    ).collect()
    for r in rows:
        x = r["x"]
        assert r["f0"] == f"{x:.0f}", x
        assert r["f1"] == f"{x:.1f}", x
        assert r["p0"] == f"{x:.0%}", x
        assert r["p1"] == f"{x:.1%}", x


def test_python_str(spark):
    rng = random.Random(17)
    vals = [0.0, 0.001, 0.0005, 0.00015, 1e-4, 9.99e-5, 5e-05, 1.25e-7, 1e7, 1e7 + 0.5, 12345678.9, 1e15, 1e16, 1.5e16, 1e300, 1.0, -1e7, -3e-6, 22.0]
    vals += [float(f"{rng.uniform(-1, 1):.6g}") * 10.0 ** rng.randrange(-3, 4) for _ in range(100)]
    vals += [float(f"{rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 19):.9g}") for _ in range(300)]
    vals = [v for v in vals if len(repr(v).split("e")[0].strip("-0.").replace(".", "")) <= 15]
    vals += [float("nan"), float("inf"), float("-inf")]
    got = [r[0] for r in _one_col(spark, vals).select(python_str("x")).collect()]
    assert got == [str(v) for v in vals]
    ints = _one_col(spark, [0, -5, 12345678901], "x long")
    assert [r[0] for r in ints.select(python_str("x")).collect()] == ["0", "-5", "12345678901"]


def test_exact_avg_leaves_out_nan_and_null(spark):
    df = _one_col(spark, [1.0, float("nan"), 3.0, None])
    assert df.agg(exact_avg("x")).first()[0] == 2.0
    assert df.where("isnan(x)").agg(exact_avg("x")).first()[0] is None


def test_exact_sum_does_not_depend_on_the_order(spark):
    vals = [0.1] * 1000 + [1e9, -1e9]
    sums = {_one_col(spark, v).agg(exact_sum("x").cast("double")).first()[0] for v in (vals, vals[::-1], vals[500:] + vals[:500])}
    assert sums == {100.0}


def test_session_of_null_user_or_time_is_null(spark):
    from datetime import datetime

    from shopsignals.operators.sessionize import sessionize_by_gap

    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, at, 1), (None, at, 2), (1, None, 3)], "user_id long, event_time timestamp, event_id long")
    got = {r["event_id"]: r["user_session"] for r in sessionize_by_gap(df, "user_id", "event_time", ("event_id",)).collect()}
    assert got[1] is not None and got[2] is None and got[3] is None
