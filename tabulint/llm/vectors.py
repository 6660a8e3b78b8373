"""Vectors of Arrow batches as matrices: which rows take part, and which entries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether a vector is there and all its entries are numbers."""
    bad = F.exists(F.col(column), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(False))


def dimension(vectors: DataFrame, column: str) -> int:
    """The commonest length of the finite vectors, the longest of several; 0 if there are none."""
    lengths = vectors.filter(finite(column)).groupBy(F.size(column).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.agg(F.max(F.struct("n", "size")).alias("top")).first().top
    return top["size"] if top else 0


def usable(vectors: DataFrame, column: str, size: int) -> DataFrame:
    """The rows whose vector is finite and ``size`` entries long."""
    return vectors.filter(finite(column) & (F.size(column) == size))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a column without NULLs, one a row, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), size)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as whole numbers in double precision; those beyond 2**53 are refused."""
    out = np.floor(values * float(scale))
    if out.size and np.abs(out).max() > 2**53:
        raise OverflowError(f"a vector entry times {scale} exceeds 2**53 and has no exact whole number in double precision")
    return out
