"""Embedding columns as rows of whole numbers, and Arrow lists of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """True if a vector is there and all its entries are numbers; an empty one has no bad entry."""
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def whole(vector: Column, scale: int = 256) -> Column:
    """Entries c as long floor(scale * c), c as double; an entry beyond a long is an error."""
    def one(c):
        product = c.cast("double") * F.lit(float(scale))
        return F.when(F.abs(product) < 2.0 ** 62, F.floor(product)).otherwise(
            F.raise_error(F.lit("an entry of a vector exceeds long")).cast("long"))
    return F.transform(vector, one)


def dimensions(rows: DataFrame, vector_col: str) -> int:
    """Entries of the longest vector; shorter ones count as zero beyond their end."""
    return int(rows.agg(F.coalesce(F.max(F.size(vector_col)), F.lit(0))).first()[0])


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of long as a matrix, with zeros where a list is shorter."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out
