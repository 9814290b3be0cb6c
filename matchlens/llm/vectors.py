"""Vectors as whole numbers, for operators whose arithmetic must be exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Greatest size of a scaled component; sums of squares and products of some thousand of them fit 64 bits.
LIMIT = 1 << 26


def scaled(df: DataFrame, key: str, vector: str, scale: int = 1024, dims: int | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """``key``, ``x`` (array of int, ``floor(scale * component)`` of doubles) and the columns of ``more``.

    Vectors that are null, hold a null or non-finite component, or have other
    than ``dims`` components are left out. A component that is beyond ``LIMIT`` once scaled stops the
    job, since 64-bit results could not be exact. Other columns are not read; nothing is shuffled.
    """
    own = F.col(f"`{vector}`").cast("array<double>")
    fit = F.forall(own, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # a NaN is greater than infinity
    if dims is not None:
        fit &= F.size(own) == dims
    beyond = F.raise_error(F.lit(f"a vector has a component beyond {LIMIT} once scaled"))

    def whole(v: Column) -> Column:
        large = F.abs(v * scale) > LIMIT
        return F.when(large, beyond.cast("int")).otherwise(F.floor(v * scale).cast("int"))

    return df.where(own.isNotNull() & fit).select(F.col(f"`{key}`").alias("key"), F.transform(own, whole).alias("x"), *[c.alias(n) for n, c in (more or {}).items()])


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow column of integer lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def binaries(rows: np.ndarray) -> pa.Array:
    """Arrow column with the bytes of each row."""
    n, width = rows.shape[0], rows.shape[1] * rows.itemsize
    ends = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def of_binaries(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """The rows that :func:`binaries` wrote."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)
