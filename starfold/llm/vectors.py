"""Integer vectors: what the vector operators share.

A component ``x`` becomes ``floor(scale * x)`` in double arithmetic. Vectors
travel as little-endian 32-bit integers in a binary column, zero-padded to
one length, so that a task turns a batch into a matrix without a loop.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components must lie strictly between -LIMIT and LIMIT; sums of products of 512 of them then fit in 64 bits.
LIMIT = 1 << 27


def usable(vector: str | Column, scale: int, limit: int = LIMIT) -> Column:
    """Is the vector neither null nor holds it a component that is null, not finite, or beyond ``limit`` when scaled?"""
    v = F.col(vector) if isinstance(vector, str) else vector
    x = lambda e: e.cast("double")
    fits = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(x(e) * scale) < limit))
    return F.coalesce(fits, F.lit(False))


def width(df: DataFrame, vector_col: str) -> int:
    """The length of the longest vector; 0 without any."""
    return max(df.agg(F.max(F.size(vector_col))).first()[0] or 0, 0)


def integers(vector: str | Column, scale: int) -> Column:
    """The vector as integers; use it on :func:`usable` vectors only."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(v, lambda e: F.floor(e.cast("double") * scale).cast("int"))


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of integers as a matrix, short vectors filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    size = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    out = np.zeros((len(size), dim), np.int32)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def packed(matrix: np.ndarray) -> pa.Array:
    """A matrix as one binary value for each row."""
    rows, width_ = matrix.shape[0], matrix[:1].nbytes
    offsets = np.arange(rows + 1, dtype=np.int64) * width_
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


def unpacked(column: pa.Array, dim: int, kind=np.int32) -> np.ndarray:
    """The matrix of a binary column of :func:`packed`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column) or not dim:
        return np.zeros((len(column), dim), kind)
    data = np.frombuffer(b"".join(column.to_pylist()), kind)
    return data.reshape(len(column), dim)
