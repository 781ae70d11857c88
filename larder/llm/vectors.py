"""Integer vectors shared by the two operators on ``embeddings``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are floor(scale * x) up to this magnitude; a vector beyond it takes
#: no part (its integer products and distances would not fit 64 bits).
MAX_COMPONENT = 1 << 27


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double (array of long)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, scale: int) -> Column:
    """Whether the vector and all its components can take part."""
    def good(x: Column) -> Column:
        d = x.cast("double") * F.lit(float(scale))  # NaN compares greater than any bound
        return F.coalesce((d < float(MAX_COMPONENT)) & (d >= -float(MAX_COMPONENT)), F.lit(False))
    return F.coalesce(F.forall(vector, good), F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as an int64 matrix; shorter rows end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy().astype(np.int64))
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims)[None, :] < size[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``: through
    doubles where every partial sum stays below 2**53, else in 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T
