"""Vectors of whole numbers for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components stay below this, so that sums of 64 squared differences and of 64 products are exact in 64 bits.
LARGEST = 1 << 27


def complete(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none of them null, NaN or infinite; false for a null vector."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dims) & finite, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double. A value of 2^27 or more ends the query with an error."""
    def number(v: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * v.cast("double"))
        return F.when(F.abs(value) < LARGEST, value).otherwise(F.raise_error(F.lit("vector component too large")).cast("long"))

    return F.transform(vector, number)


def matrix(column: pa.Array | pa.ChunkedArray, dims: int, kind=np.int64) -> np.ndarray:
    """A list column without nulls as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(-1, dims)


def as_lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))
