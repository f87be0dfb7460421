import math

import numpy as np
import pytest

from shopsignals.llm import whitening as wh
from tests.llm import helpers as h

DDL = "vec_id long, embedding array<float>, label int"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T, q


@pytest.mark.parametrize("values", [
    np.linspace(1, 50, 40),
    np.r_[3.0, 3.0 + 1e-9, 3.0 - 2e-9, 3.0 + 5e-8, np.linspace(0.1, 2, 20)],  # closer than float32 can tell
    np.r_[7.0, 7.0, 7.0, 1.0, 1.0, 0.0, 0.0],
    np.r_[1e9, 1e9 + 1e-3, 1.0, 1.0 + 1e-9, 1e-6],
    np.ones(6), np.zeros(3), np.array([2.0]),
])
def test_eigenpairs_reach_double_precision(values):
    a, _ = symmetric(values)
    e, x = wh.eigenpairs(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.all(np.diff(e) <= 1e-13 * scale)
    assert np.allclose(e, np.sort(values)[::-1], rtol=0, atol=2e-14 * scale * len(values))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14 * len(values)
    assert np.abs(a @ x - x * e).max() < 2e-14 * scale * len(values)


@pytest.mark.parametrize("values", [
    np.r_[3.0, 3.0 + 1e-9, 3.0 - 2e-9, 3.0 + 5e-8, np.linspace(0.1, 2, 20)],
    np.r_[1e9, 1e9 + 1e-3, 1.0, 1.0 + 1e-9, 1e-6],
    np.repeat([1.0, 1.0 + 1e-14, 1.0 + 1e-12, 2.0], 3),  # gaps within rounding and just above it
    np.r_[1.0, np.logspace(-18, -12, 12)],
    np.ones(6),
])
def test_eigenpairs_settle_whatever_the_rounding(values):
    """Many bases of the same eigenvalues, so that rounding falls on either side of every bound."""
    scale, n = np.abs(values).max(), len(values)
    for seed in [*range(40), 62, 199, 382]:
        a, _ = symmetric(values, seed)
        e, x = wh.eigenpairs(a)
        assert np.allclose(e, np.sort(values)[::-1], rtol=0, atol=2e-14 * scale * n)
        assert np.abs(x.T @ x - np.eye(n)).max() < 1e-14 * n
        assert np.abs(a @ x - x * e).max() < 2e-14 * scale * n


def test_close_eigenvalues_need_the_sub_solve():
    """Eigenvectors of a gap of 1e-9: float32 mixes them, and so does the iteration without clusters."""
    a, q = symmetric(np.r_[5.0, 5.0 - 1e-9, 1.0, 0.5])
    _, x = wh.eigenpairs(a)
    plain = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.float64)
    angle = lambda v: abs(abs(v[:, 0] @ q[:, 0]) - 1)
    assert angle(x) < 1e-11 < angle(plain)


def brute(rows, components=4):
    good = [(r[0], r[1]) for r in rows if r[1] is not None and len(r[1]) and all(c is not None and math.isfinite(c) for c in r[1])]
    dims = [len(v) for _, v in good]
    dim = min(set(dims), key=lambda d: (-dims.count(d), d))
    good = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in good if len(v) == dim]
    fit = np.array(sorted({x for _, x in good}), np.float64)
    n, s = len(fit), fit.sum(axis=0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1], vec[:, ::-1]
    return {"n": n, "e": e, "vec": vec, "v": v, "rows": [(i, x, sum((n * a - int(b)) ** 2 for a, b in zip(x, s))) for i, x in good], "mean": s / n, "kept": min(components, dim)}


def table(seed=3, n=60, dim=9):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(c) for c in rng.standard_normal(dim).astype(np.float32) / 8 * (1 + np.arange(dim))], 1) for i in range(n)]
    rows += [(100 + i, rows[0][1], 2) for i in range(40)] + [(5, rows[9][1], 2), (None, rows[3][1], None)]
    rows += [(300, None, 1), (301, [], 1), (302, [None] + [1.0] * (dim - 1), 1), (303, [math.nan] * dim, 1), (304, [math.inf] + [0.0] * (dim - 1), 1), (305, [1.0, 2.0], 1)]
    return rows


def test_matches_brute_force(spark):
    rows = table()
    want = brute(rows)
    df = h.clashing(spark.createDataFrame(rows, DDL).repartition(5)).withColumnsRenamed({"n": "x.y"})
    got = wh.whiten(df).collect()
    assert len(got) == want["kept"] * len(want["rows"]) and {r["n"] for r in got} == {want["n"]}
    assert all(r["identity_error"] < 1e-12 for r in got)
    for k in range(want["kept"]):
        sign = None
        mine = sorted((r for r in got if r["component"] == k + 1), key=lambda r: (str(r["vec_id"]), r["whitened"]))
        direction = want["vec"][:, k]
        expect = [(str(i), d, float((np.array(x) - want["mean"]) @ direction / math.sqrt(want["e"][k]))) for i, x, d in want["rows"]]
        sign = max((1, -1), key=lambda s: sum(s * a["whitened"] > 0 for a in mine if a["vec_id"] == max(expect, key=lambda z: z[2] if z[0] != "None" else -9)[0] or str(a["vec_id"]) == max(expect, key=lambda z: z[2])[0]))
        expect = sorted((i, sign * w, d) for i, d, w in expect)
        assert [(str(r["vec_id"]), r["deviation"]) for r in mine] == [(i, d) for i, _, d in expect]
        assert np.allclose([r["whitened"] for r in mine], [w for _, w, _ in expect], atol=1e-9)
        assert all(abs(r["explained"] - want["e"][k] / np.trace(want["v"])) < 1e-12 for r in mine)


def test_no_variance_huge_entries_and_empty(spark):
    same = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], DDL)).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = wh.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(6)], DDL)).collect()
    first = [r for r in line if r["component"] == 1]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in first) and all(r["whitened"] is None and r["explained"] == 0 for r in line if r["component"] > 1)
    huge = wh.whiten(spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [1.0, 3.0], 0)], DDL)).collect()
    assert len(huge) == 6 and {(r["vec_id"], r["deviation"]) for r in huge} == {(1, None), (2, None), (3, 513**2 + 768**2)}
    assert wh.whiten(spark.createDataFrame([], DDL)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, None, 0)], DDL)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_integer_sums_and_scaling_are_exact():
    x = np.array([[2**62, -(2**62) - 5, 3]] * 9, np.int64)
    assert wh._integer_sums(x) == [9 * 2**62, -9 * (2**62 + 5), 27]
    import pyarrow as pa

    got = wh._scaled(pa.array([[-0.001, 0.0039, 1e300, -1e300]], pa.list_(pa.float64())), 4, 256, 7)
    assert got.tolist() == [[6, 7, 2**63 - 1, -(2**63)]]
