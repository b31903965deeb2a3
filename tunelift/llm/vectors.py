"""Integer vectors of the embedding operators: which rows take part, scaling, numpy views."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = 2 ** 53   # whole numbers below this are exact as doubles


def usable(vector: str) -> Column:
    """The vector is there, and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(False))


def scaled(vector: str, factor: int) -> Column:
    """floor(factor * x) of each component as 32-bit integers (beyond those: an error)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("int"))


def matrix(lists: pa.Array, dims: int, dtype=np.float64) -> np.ndarray:
    """The vectors of an Arrow list column as rows; shorter ones end in zeros."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), dims), dtype=dtype)
    out[np.arange(dims) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def number_type(dims: int, largest: int) -> type:
    """Type in which inner products of such vectors are exact: doubles (fast products) while
    they are, 64-bit integers beyond; an ArithmeticError where a product may not fit a long."""
    if dims * largest ** 2 < EXACT:
        return np.float64
    if dims * largest ** 2 < 2 ** 63:
        return np.int64
    raise ArithmeticError(f"inner products of {dims} components up to {largest} do not fit a long")
