"""Columns of number lists as matrices, and back."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole components saturate here: squared distances of 64 of them, and sums over 2 ** 36 rows, fit 64 bits.
LIMIT = 1 << 27
SLACK = 1e-9  # relative; roots of whole squared distances are right to 1e-15


def matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, matrix) of the lists with ``dims`` components, none NULL or non-finite."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) == dims) & (bad[offsets[1:]] == bad[offsets[:-1]])
    places = np.flatnonzero(good)
    return places, values[offsets[:-1][places][:, None] + np.arange(dims)]


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), within plus or minus ``LIMIT``."""
    return np.clip(np.floor(scale * x), -LIMIT, LIMIT).astype(np.int64)


def lists(x: np.ndarray) -> pa.Array:
    """A matrix as a column of ``array<int>``."""
    n, dims = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dims), pa.array(np.ascontiguousarray(x, np.int32).ravel()))


def whole_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The column that :func:`lists` made, as whole numbers."""
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def square(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two matrices, exact."""
    gaps = x - y
    return np.einsum("ij,ij->i", gaps, gaps)


def floors(sums: Sequence[int], count: int) -> list[int]:
    """Exact floor(sum / count) of every component."""
    return [int(s) // int(count) for s in sums]


def usable(embedding: Column) -> Column:
    """Whether a vector holds neither NULL nor non-finite components; false for a NULL vector."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return embedding.isNotNull() & F.forall(embedding, finite)
