"""Whitened principal components of integer-scaled embeddings.

1. *Scaling*: every entry ``c`` becomes the integer ``x = floor(scale * c) +
   shift``.  Equal ``x`` vectors are one vector of the *fit list*, whatever the
   number of rows; partial aggregation joins copies before the shuffle, so a
   vector in a third of all rows is one row per task.
2. *Covariance*: two passes over the written fit list.  The first adds the
   entries as integers (exactly); the second subtracts the mean and adds outer
   products.  A task sends one row per dimension and pass; rows of a dimension
   are added where they meet, and the driver receives ``d`` rows of ``d``
   numbers, whatever the number of vectors.
3. *Eigenvectors* (``eigenpairs``): LAPACK on the covariance in float32, then
   Ogita and Aishima's iteration in float64, which needs matrix products only:
   from ``R = I - X'X`` and ``S = X'AX`` it corrects all vectors at once, with
   quadratic convergence, as long as eigenvalues are apart; Newton's iteration
   makes the vectors orthonormal again after each correction.  Eigenvalues closer
   than the error bound form clusters.  A cluster gets a sub-solve: the matrix
   projected on the cluster's subspace, less its mean eigenvalue and scaled up,
   is solved in the same way (float32, refined) and rotates the cluster's
   vectors; the iteration then goes on.
4. *Application*: one Arrow map over all rows; a last pass over the fit list
   measures the covariance of the whitened vectors.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, and so are vectors of another length than most (ties: the
shortest) and empty ones.  Scaled entries beyond a 64-bit integer take its
nearest value.  ``deviation`` is null where it exceeds a 64-bit integer.  A
component whose eigenvalue is zero up to rounding (``d * eps`` times the
largest) has no direction to scale: ``whitened`` is null there, ``explained`` 0
and the component takes no part in ``identity_error``; both are null when no
component has variance (a single different vector).  Rows that repeat an id are
separate rows; null ids pass through; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import arrow_rows, materialize

SCALE = 256
SHIFT = 0
_MIN, _MAX = -(1 << 63), (1 << 63) - 1
#: integers up to here are exact in float64
_EXACT = 1 << 53


# ---------------------------------------------------------------- eigenvectors

#: rounds of the iteration between sub-solves; convergence is quadratic
ROUNDS = 12


def _floor(a: np.ndarray, norm: float) -> float:
    """The distance up to which eigenvalues are equal to rounding."""
    return 4 * len(a) * np.finfo(np.float64).eps * norm


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest orthonormal columns, by Newton's iteration (quadratic) until only rounding is left."""
    for _ in range(ROUNDS):
        r = np.eye(x.shape[1]) - x.T @ x
        x = x + x @ r / 2
        if np.max(np.abs(r)) <= 1e-9:  # its square is below rounding
            break
    return x


def _refine(a: np.ndarray, x: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of all vectors: (vectors, eigenvalues, distance below which two eigenvalues are a cluster).

    The correction of two close eigenvalues can be large; left as it is, its
    square would spoil the angles of all vectors in the next round.
    """
    r = np.eye(len(a)) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    # a gap within rounding says nothing: divided by it, rounding would turn the vectors
    delta = max(2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(r, 2)), _floor(a, norm))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > delta
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2)
    return _orthonormal(x + x @ e), values, delta


def _clusters(values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Index sets of two and more eigenvalues that follow each other within ``delta``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenpairs(a: np.ndarray, depth: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric float64 matrix.

    The start is solved in float32; float64 is reached by matrix products.
    """
    a = (a + a.T) / 2
    scale = float(np.max(np.abs(a), initial=0.0))
    if scale == 0 or len(a) == 1:
        return np.diag(a).copy(), np.eye(len(a))
    a = a / scale
    norm = float(np.linalg.norm(a, 2))
    eps = np.finfo(np.float64).eps
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x.astype(np.float64)
    values, settled = np.diag(x.T @ a @ x), False
    for _ in range(depth):
        for _ in range(ROUNDS):
            before = x
            x, values, delta = _refine(a, x, norm)
            if np.max(np.abs(x - before)) <= 8 * eps:
                break
        # what the iteration cannot tell apart: clusters, solved in their own subspace
        groups = _clusters(values, delta)
        done = delta <= _floor(a, norm)
        if settled or (done and not groups):
            break
        settled = done
        for j in groups:
            inside = x[:, j]
            centre = float(np.mean(values[j]))
            small = inside.T @ (a @ inside - centre * inside)
            small = (small + small.T) / 2
            if np.max(np.abs(small)) <= _floor(a, norm):
                continue  # equal to rounding: any basis of the subspace is right
            x[:, j] = inside @ eigenpairs(small, depth - 1)[1]
            settled = False
    # last step: orthonormal to rounding, values as Rayleigh quotients
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# ---------------------------------------------------------------- passes over the vectors


def _scaled(column: pa.Array, dim: int, scale: float, shift: int) -> np.ndarray:
    """``floor(scale * c) + shift`` as int64, one row per vector."""
    c = np.floor(np.asarray(column.flatten(), np.float64).reshape(-1, dim) * scale)
    low, high = c <= float(_MIN), c >= float(_MAX)
    x = np.where(low | high, 0, c).astype(np.int64)
    if shift:
        room = np.clip(x, _MIN - min(shift, 0), _MAX - max(shift, 0))
        x = room + shift
    x[low], x[high] = _MIN, _MAX
    return x


def _integer_sums(x: np.ndarray) -> list[int]:
    """Column sums of int64 rows as Python integers, exact at any size."""
    high, low = x >> np.int64(32), x & np.int64(0xFFFFFFFF)
    return [(int(h) << 32) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0))]


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(``id, v`` of the usable rows, their length)."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("v").isNotNull()).where((F.size("v") > 0) & finite)
    most = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).head()
    dim = most["d"] if most else 0
    return rows.where(F.size("v") == dim), dim


def fit_list(rows: DataFrame, dim: int, scale: float, shift: int) -> DataFrame:
    """``x``: each different scaled vector once, as little-endian 64-bit integers."""

    def scaled(batches):
        for b in batches:
            if not b.num_rows:
                continue
            # copies inside a batch go before the shuffle
            x = np.unique(_scaled(b.column(0), dim, scale, shift), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x.astype("<i8")], pa.binary())], names=["x"])

    return materialize(rows.select("v").mapInArrow(scaled, "x binary").groupBy("x").agg(F.lit(1).alias("one")).select("x"))


def _rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


def fit_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(number of vectors, sum of each dimension), exact."""

    def sums(batches):
        n, total = 0, [0] * dim
        for b in batches:
            x = _rows_of(b.column(0), dim)
            n += len(x)
            total = [s + t for s, t in zip(total, _integer_sums(x))]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(map(str, total), pa.string())], names=["i", "n", "s"])

    parts = fit.mapInArrow(sums, "i int, n long, s string")
    # at most one row per dimension reaches the driver
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [0] * dim)


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """``i, r`` (parts of row ``i`` of a matrix): the sum of the parts, row by row."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, r in zip(b.column(0).to_pylist(), np.asarray(b.column(1).flatten()).reshape(-1, size)):
                total[i] = total[i] + r if i in total else r.copy()
        if total:
            flat = pa.array(np.concatenate(list(total.values())))
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, size, dtype=np.int32), flat)], names=["i", "r"])

    kind = "i int, r array<double>"
    out = np.zeros((size, size))
    for r in parts.repartition("i").mapInArrow(add, kind).collect():
        out[r["i"]] = r["r"]
    return out


def covariance(fit: DataFrame, n: int, project, size: int, dim: int) -> np.ndarray:
    """Covariance (divisor ``n``) of ``project(x)``, which has mean 0, over the fit list."""

    def products(batches):
        total = np.zeros((size, size))
        for b in batches:
            y = project(_rows_of(b.column(0), dim))
            total += y.T @ y
        flat = pa.array(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.ListArray.from_arrays(np.arange(0, size * size + 1, size, dtype=np.int32), flat)], names=["i", "r"])

    return _added(fit.mapInArrow(products, "i int, r array<double>"), size) / n


# ---------------------------------------------------------------- the operator


@dataclass
class Whitening:
    """A fitted transform: ``x -> (x - sums / n) @ vectors / sqrt(values)``."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray  #: eigenvalues, falling, of the components kept
    vectors: np.ndarray  #: dim x components
    trace: float
    scale: float = SCALE
    shift: int = SHIFT
    identity_error: float | None = None
    mean: np.ndarray = field(init=False)

    def __post_init__(self):
        self.mean = np.array([s / self.n if self.n else 0.0 for s in self.sums])

    @property
    def live(self) -> np.ndarray:
        """Components whose eigenvalue is above rounding."""
        top = self.values.max(initial=0.0)
        return self.values > max(top, 0.0) * self.dim * np.finfo(np.float64).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64) - self.mean

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row per vector; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.live, self.centred(x) @ self.vectors / np.sqrt(np.where(self.live, self.values, np.nan)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - sums) ** 2``; None beyond a long."""
        reach = self.n * int(max(-int(x.min(initial=0)), int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if reach * reach * self.dim <= _MAX:
            d = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(r, self.sums)) for r in x.tolist()]
        return [v if v <= _MAX else None for v in exact]


def fit_whitening(rows: DataFrame, dim: int, components: int, scale: float = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Fits on the different scaled vectors of ``id, v``; None without rows."""
    if not dim:
        return None
    fit = fit_list(rows, dim, scale, shift)
    n, sums = fit_sums(fit, dim)
    if not n:
        return None
    kept = min(components, dim)
    model = Whitening(dim, n, sums, np.zeros(kept), np.eye(dim)[:, :kept], 0.0, scale, shift)
    v = covariance(fit, n, model.centred, dim, dim)
    values, vectors = eigenpairs(v)
    # either sign is right; the largest entry is made positive so that reruns agree
    vectors = vectors * np.where(np.take_along_axis(vectors, np.argmax(np.abs(vectors), axis=0)[None, :], 0) < 0, -1.0, 1.0)
    model.values, model.vectors, model.trace = values[:kept], vectors[:, :kept], float(np.trace(v))
    live = np.flatnonzero(model.live)
    if len(live):
        got = covariance(fit, n, lambda x: model.whitened(x)[:, live], len(live), dim)
        model.identity_error = float(np.max(np.abs(got - np.eye(len(live)))))
    return model


OUT = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])
DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, scale: float = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component, falling by eigenvalue."""
    rows, dim = usable_vectors(vectors, id_col, vector_col)
    model = fit_whitening(rows, dim, components, scale, shift)
    if model is None:
        return vectors.sparkSession.createDataFrame([], DDL)
    kept = len(model.values)
    share = [(float(e) if alive else 0.0) / model.trace if model.trace > 0 else None for e, alive in zip(model.values, model.live)]

    def apply(batches):
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = _scaled(b.column(1), dim, scale, shift)
            w = model.whitened(x).ravel()
            yield arrow_rows(OUT, {
                "vec_id": b.column(0).take(pa.array(np.repeat(np.arange(m), kept))), "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), m), "n": np.full(m * kept, model.n),
                "deviation": [d for d in model.deviations(x) for _ in range(kept)], "whitened": pa.array(w, mask=np.isnan(w)), "explained": share * m, "identity_error": [model.identity_error] * (m * kept),
            })

    return rows.mapInArrow(apply, DDL)
