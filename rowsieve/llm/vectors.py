"""Columns of vectors in Arrow batches, and exact sums over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Integers of a smaller magnitude are exact as doubles, and so are sums of them below it.
EXACT = float(2**53)


def finite_rows(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, vectors as float64) of the rows that hold a vector of
    ``dims`` entries (any, if not given: of one length), all finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    missing = pc.is_null(flat).to_numpy(zero_copy_only=False)
    values = pc.cast(flat, pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = missing | ~np.isfinite(values)
    sizes = np.maximum(lengths, 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    before = np.concatenate([[0], np.cumsum(bad)])
    good = (lengths >= 0) & (before[starts[1:]] == before[starts[:-1]])
    if dims is not None:
        good &= lengths == dims
    rows = np.flatnonzero(good)
    width = int(lengths[rows[0]]) if len(rows) else (dims or 0)
    if len(rows) and len(rows) == len(lengths):
        return rows, values.reshape(len(rows), width)
    at = starts[rows][:, None] + np.arange(width)
    return rows, values[at] if len(rows) else np.zeros((0, width))


def whole(values: np.ndarray) -> np.ndarray:
    """Doubles without a fraction as Python integers."""
    return np.array([[int(v) for v in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers held as doubles, exactly: as doubles where no
    sum can reach 2**53, else as Python integers."""
    most = lambda m: float(np.abs(m).max()) if m.size else 0.0
    if most(a) * most(b) * max(a.shape[-1], 1) < EXACT:
        return a @ b
    return whole(a) @ whole(b) if a.ndim == 2 and b.ndim == 2 else (whole(a) @ whole(b.reshape(-1, 1)))[:, 0]
