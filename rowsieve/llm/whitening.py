"""Embedding whitening: distributed moments, eigenvectors, projection.

An entry c becomes the whole number x = floor(64 c) + 1000000.  Moments are
whole numbers too and summed exactly, so they come out the same whatever
order tasks finish or are run again in:

1. one pass sums x and counts rows, per dimension;
2. one pass sums the products of x - m, where m is the mean rounded to a whole
   number, so nothing large cancels; n times these sums less the products of
   the sums of x - m is exactly n**2 times the covariance about the mean;
3. the d x d covariance is reduced to tridiagonal form by Householder
   reflections; eigenvalues are found by bisection on Sturm counts (leading
   ones only), eigenvectors by inverse iteration, reorthogonalised within
   clusters of close eigenvalues, then carried back;
4. one pass measures the covariance of the projected rows, and one returns
   them.  Components reach the tasks as d x k numbers.

Only per-dimension sums (d values) and product sums (d (d + 1) / 2) reach the
driver, whatever the number of rows.  Tasks hold one Arrow batch.

Defined cases: rows whose vector is null or holds a null or non-finite entry
are left out.  Vectors of several lengths cannot share a covariance: those of
the most frequent length (the longest among equals) are taken.  Components
whose eigenvalue is not above ``d * 2**-52`` of the largest (constant or
dependent dimensions, a single row, all rows equal) have no whitened value
and are not returned; so an empty table, empty vectors and rows that all
repeat give no rows.  Repeated rows count each; a null ``vec_id`` is kept;
extra columns are ignored, whatever their names.  A ``deviation`` that no
long holds is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.tables import bound_batches
from rowsieve.llm.vectors import exact_products, finite_rows, whole

SCALE, SHIFT = 64.0, 1_000_000


# -- eigenvectors of a symmetric matrix (driver, d x d) ------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) of ``v`` under Householder reflections."""
    a, d = np.array(v, float), len(v)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x[1:])
        u = np.zeros(d - k - 1)
        if size > 0:
            u[:] = x
            u[0] += np.copysign(np.hypot(x[0], size), x[0])
            u /= np.linalg.norm(u)
            block = a[k + 1 :, k + 1 :]
            p = block @ u
            w = 2 * (p - (u @ p) * u)
            block -= np.outer(u, w) + np.outer(w, u)
            a[k + 1 :, k] = 0
            a[k + 1, k] = x[0] - 2 * u[0] * (u @ x)
        reflections.append(u)
    off = np.array([a[i + 1, i] for i in range(d - 1)])
    return np.diag(a).copy(), off, reflections


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix below each value of ``at``."""
    least = np.finfo(float).tiny * max(1.0, float(np.max(off * off, initial=0)))
    q = diag[0] - at
    q = np.where(np.abs(q) < least, -least, q)
    below = (q < 0).astype(np.int64)
    for i in range(1, len(diag)):
        q = diag[i] - at - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each by bisection to the last bit."""
    d = len(diag)
    reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    size = max(float(np.max(np.abs(diag) + reach)), np.finfo(float).tiny)
    low, high = np.full(k, float(np.min(diag - reach)) - size * 2**-50), np.full(k, float(np.max(diag + reach)) + size * 2**-50)
    rank = d - np.arange(k)  # the j-th largest is the first with so many at or below it
    for _ in range(1100):
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            break
        more = sturm_counts(diag, off, middle) >= rank
        high, low = np.where(open_ & more, middle, high), np.where(open_ & ~more, middle, low)
    return low + (high - low) / 2


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) z = right by elimination with row exchanges; small pivots are raised."""
    d = len(diag)
    main, up, up2 = diag - shift, np.append(off, 0.0), np.zeros(d)
    low, b = off.copy(), right.copy()
    for i in range(d - 1):
        if abs(low[i]) > abs(main[i]):
            main[i], low[i] = low[i], main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = (up[i + 1], 0.0) if i + 2 < d else (0.0, up[i + 1])
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < least:
            main[i] = least
        f = low[i] / main[i]
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        b[i + 1] -= f * b[i]
    if abs(main[-1]) < least:
        main[-1] = least
    z = np.zeros(d)
    for i in reversed(range(d)):
        rest = b[i] - (up[i] * z[i + 1] if i + 1 < d else 0.0) - (up2[i] * z[i + 2] if i + 2 < d else 0.0)
        z[i] = rest / main[i]
    return z / np.linalg.norm(z)


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v``, falling, and unit eigenvectors
    (columns; the entry of largest magnitude is positive)."""
    d = len(v)
    diag, off, reflections = tridiagonal(v)
    values = leading_eigenvalues(diag, off, k)
    size = max(float(np.max(np.abs(v))), np.finfo(float).tiny)
    norm = float(np.max(np.abs(diag) + np.append(np.abs(off), 0) + np.append(0, np.abs(off)))) or size
    least, near = np.finfo(float).eps * norm, 1e-3 * norm
    rng = np.random.default_rng(7)
    z, first, shift = np.zeros((d, k)), 0, np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > near:
            first = j
        # equal shifts would give equal vectors: part them by a few last places
        shift = min(values[j], shift - 4 * least) if j > first else values[j]
        x = rng.standard_normal(d)
        for _ in range(5):
            for _ in range(2):
                x -= z[:, first:j] @ (z[:, first:j].T @ x)
            x = _solve_shifted(diag, off, shift, x / np.linalg.norm(x), least)
        for _ in range(2):
            x -= z[:, :j] @ (z[:, :j].T @ x)
        z[:, j] = x / np.linalg.norm(x)
    for i in reversed(range(len(reflections))):
        u = reflections[i]
        z[i + 1 :] -= 2 * np.outer(u, u @ z[i + 1 :])
    z /= np.linalg.norm(z, axis=0)
    return values, z * np.where(z[np.abs(z).argmax(0), np.arange(k)] < 0, -1.0, 1.0)


# -- exact moments over Spark --------------------------------------------------


def _centred(values: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 - middle, whole numbers as doubles."""
    return np.floor(SCALE * values) + (SHIFT - middle)


def _sums(df: DataFrame, vector: str, func, schema: str) -> list:
    """Rows of exact sums: ``func`` gives (i, j, whole number) of a batch of vectors; they are added up per (i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for key, value in func(batch.column(0)):
                total[key] = total.get(key, 0) + value
        if total:
            keys = list(total)
            # a sum can need more than 64 bits: it travels as text and is added up as a decimal
            columns = [pa.array([k[c] for k in keys], pa.int32()) for c in range(2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([str(int(total[k])) for k in keys], pa.string())], ["i", "j", "s"])

    parts = df.select(F.col(vector)).mapInArrow(run, schema)
    return parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: counts and sums, and components as columns over sqrt(e)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def dims(self) -> int:
        return len(self.sums)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Whitened values: x - S/n on the components, over sqrt(e)."""
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = np.array([float(Fraction(s - self.n * m, self.n)) for s, m in zip(self.sums, middle)])
        return (_centred(vectors, np.array(middle, float)) - rest) @ (self.components / np.sqrt(self.values))

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2 per row, exactly; None beyond a long."""
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        away = np.array([s - self.n * m for s, m in zip(self.sums, middle)], dtype=object)
        y = _centred(vectors, np.array(middle, float))
        most = float(np.abs(y).max(initial=0)) * self.n + self.n
        if most < 2.0**53 and most * most * self.dims < 2.0**62:
            found = ((y.astype(np.int64) * self.n - away.astype(np.int64)) ** 2).sum(1).tolist()
        else:
            found = ((whole(y) * self.n - away) ** 2).sum(1).tolist() if len(y) else []
        return [v if v < 2**63 else None for v in found]


def fit(df: DataFrame, vector: str = "embedding", k: int = 32) -> Whitening | None:
    """The whitening of all vectors of ``df``; None where no component exists."""
    bound_batches(df.sparkSession)

    def first(column):
        """(length, dimension, sum of x) and (length, -1, rows), for every length by itself."""
        lengths = np.unique(np.array([len(v) for v in column.drop_null()] or [0])) if not _one_length(column) else [None]
        for length in lengths:
            rows, values = finite_rows(column, None if length is None else int(length))
            if len(rows):
                width, y = values.shape[1], _centred(values, np.full(values.shape[1], float(SHIFT)))
                yield (width, -1), len(rows)
                totals = exact_products(np.ones((1, len(y))), y)[0] if width else []
                for j, s in enumerate(totals):
                    yield (width, j), int(s) + SHIFT * len(rows)

    found = {(r["i"], r["j"]): int(r["s"]) for r in _sums(df, vector, first, "i int, j int, s string")}
    dims = max(((n, i) for (i, j), n in found.items() if j == -1), default=(0, 0))[1]
    if not dims:
        return None
    n, sums = found[dims, -1], tuple(found[dims, j] for j in range(dims))
    middle = [(2 * s + n) // (2 * n) for s in sums]

    def second(column):
        rows, values = finite_rows(column, dims)
        if len(rows):
            y = _centred(values, np.array(middle, float))
            products = exact_products(y.T, y)
            for i in range(dims):
                for j in range(i, dims):
                    yield (i, j), int(products[i, j])

    products = {(r["i"], r["j"]): int(r["s"]) for r in _sums(df, vector, second, "i int, j int, s string")}
    away = [s - n * m for s, m in zip(sums, middle)]
    v = np.zeros((dims, dims))
    for (i, j), p in products.items():
        v[i, j] = v[j, i] = float(Fraction(n * p - away[i] * away[j], n * n))
    trace = float(sum(Fraction(n * products[i, i] - away[i] ** 2, n * n) for i in range(dims)))
    if trace <= 0:
        return None
    values, z = leading_components(v, min(k, dims))
    keep = values > values[0] * dims * 2.0**-52
    return Whitening(n, sums, values[keep], z[:, keep], values[keep] / trace)


def _one_length(column: pa.Array) -> bool:
    import pyarrow.compute as pc

    ends = pc.min_max(pc.list_value_length(column)).as_py()
    return ends["min"] == ends["max"]


def measured(df: DataFrame, fitted: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            _, values = finite_rows(batch.column(0), fitted.dims)
            w = fitted.project(values)
            total += w.T @ w
            sums += w.sum(0)
        i, j = np.triu_indices(k)
        flat = [np.concatenate([i, np.arange(k)]), np.concatenate([j, np.full(k, -1)]), np.concatenate([total[i, j], sums])]
        yield pa.RecordBatch.from_arrays([pa.array(flat[0], pa.int32()), pa.array(flat[1], pa.int32()), pa.array(flat[2], pa.float64())], ["i", "j", "s"])

    rows = df.select(F.col(vector)).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    means = {r["i"]: r["s"] / fitted.n for r in rows if r["j"] == -1}
    entries = ((r["i"], r["j"], r["s"] / fitted.n) for r in rows if r["j"] >= 0)
    return max(abs(s - means[i] * means[j] - (i == j)) for i, j, s in entries)


def whiten(df: DataFrame, k: int = 32, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    every remaining row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit(df, vector, k)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    error = measured(df, fitted, vector)
    parts = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = finite_rows(batch.column(1), fitted.dims)
            if not len(rows):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(rows, parts)))
            deviation = pa.array(fitted.deviations(values), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), parts)))
            every = len(rows) * parts
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, parts + 1), len(rows)), pa.int32()),
                    pa.array(np.full(every, fitted.n), pa.int64()),
                    deviation,
                    pa.array(fitted.project(values).reshape(-1), pa.float64()),
                    pa.array(np.tile(fitted.explained, len(rows)), pa.float64()),
                    pa.array(np.full(every, error), pa.float64()),
                ],
                schema.replace(" long", "").replace(" int", "").replace(" double", "").split(", "),
            )

    return df.select(F.col(id_col).cast("long"), F.col(vector)).mapInArrow(run, schema)
