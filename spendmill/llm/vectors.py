"""Float vectors of an Arrow column as whole numbers, and exact products of such numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Beyond this a component would take sums of squares out of 64 bits.
LARGEST = 1 << 27


def whole_vectors(column: pa.Array, scale: int, width: int | None = None) -> tuple[np.ndarray, list[np.ndarray] | np.ndarray]:
    """(row numbers, vectors): the rows whose vector is there and has finite components only, each floor(scale * x).

    With ``width`` only vectors of so many components count, and they come as one matrix; without it vectors may differ
    in length and come as a list. A component beyond ``LARGEST`` is an error, as its products would not be exact.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    ends = np.cumsum(np.maximum(lengths, 0))
    whole = np.zeros(len(lengths), dtype=bool)
    finite = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    there = lengths >= 0 if width is None else lengths == width
    whole[there] = finite[ends[there]] == finite[ends[there] - lengths[there]]
    rows = np.flatnonzero(whole)
    values = np.floor(np.where(np.isfinite(flat), flat, 0) * scale)
    if width is not None:
        values = values[(ends[rows] - width)[:, None] + np.arange(width)]
    if values.size and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}: its products are not exact in 64 bits")
    values = values.astype(np.int64)
    return rows, values if width is not None else [values[ends[r] - lengths[r] : ends[r]] for r in rows]


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """A matrix of ``width`` columns; shorter vectors end in zeros, which change no product."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: min(len(vector), width)] = vector[:width]
    return out


def list_matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of integer lists, none longer than ``width``, as a matrix padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, exact: as doubles where their sums fit, else as integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 63:
        raise ValueError("the vectors are too long or too large for products in 64 bits")
    return a @ b.T


def squared_distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column for each point."""
    return np.stack([((vectors - p) ** 2).sum(axis=1) for p in points], axis=1) if len(points) else np.zeros((len(vectors), 0), np.int64)
