"""Per-user item arrays, sparse 0/1 vectors and the dense pivot.

Sparse vectors come from the sorted index arrays: an Arrow-batched pandas UDF
puts them into the vector's struct form. Summaries read that form back with
plain expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F


def user_item_arrays(pairs: DataFrame, user_col: str = "playlist_id",
                     item_col: str = "track_uri_index") -> DataFrame:
    """(user, indices: sorted distinct item ids, values: 1.0 per index).

    ``collect_set`` is partially aggregated before the shuffle, and a user's
    array is bounded by the number of distinct items (the vector size).
    """
    return (pairs.where(F.col(item_col).isNotNull())
            .groupBy(user_col)
            .agg(F.sort_array(F.collect_set(F.col(item_col).cast("int"))).alias("indices"))
            .withColumn("values", F.array_repeat(F.lit(1.0), F.size("indices"))))


@F.pandas_udf(VectorUDT())
def _sparse_from_indices(indices: pd.Series, size: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        "type": np.zeros(len(indices), dtype=np.int8),
        "size": size.astype("int32").to_numpy(),
        "indices": indices,
        "values": [np.ones(len(a), dtype=np.float64) for a in indices],
    })


def vector_size(pairs: DataFrame, item_col: str = "track_uri_index") -> int:
    """max id + 1 (ids start at 1; position 0 stays empty)."""
    return int(pairs.agg(F.coalesce(F.max(item_col), F.lit(0))).first()[0]) + 1


def sparse_vectors(pairs: DataFrame, size: int | None = None, user_col: str = "playlist_id",
                   item_col: str = "track_uri_index") -> DataFrame:
    """(user, features: SparseVector(size) with 1.0 at each item id).

    Ids >= size are outside the vector and are left out (``out_of_range``
    reports them).
    """
    size = size or vector_size(pairs, item_col)
    arrays = user_item_arrays(pairs.where(F.col(item_col) < size), user_col, item_col)
    return arrays.select(user_col, _sparse_from_indices("indices", F.lit(size)).alias("features"))


def out_of_range(pairs: DataFrame, size: int, item_col: str = "track_uri_index") -> DataFrame:
    """Rows whose id does not fit a vector of ``size`` (e.g. ids added later)."""
    return pairs.where(F.col(item_col) >= size)


def vector_summary(col: str) -> Column:
    """Vector column -> struct (n_items, min_id, max_id, sum_id, sum_values, size).

    A dense vector is summarised over its non-zero places; its size is its length.
    """
    v = F.unwrap_udt(F.col(col))
    dense = v["type"] == 1
    ids = F.when(dense, F.filter(F.transform(v["values"], lambda x, i: F.when(x != 0, i)),
                                 lambda i: i.isNotNull())).otherwise(v["indices"])
    return F.struct(
        F.size(ids).alias("n_items"), F.array_min(ids).alias("min_id"), F.array_max(ids).alias("max_id"),
        F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, i: a + i).alias("sum_id"),
        F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x).alias("sum_values"),
        F.when(dense, F.size(v["values"])).otherwise(v["size"]).alias("size"))


def pivot_values(df: DataFrame, item_col: str) -> list:
    """Sorted distinct values of ``item_col``, as far as the engine's own limit for
    pivots (``spark.sql.pivotMaxValues``) allows."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    head = df.select(item_col).where(F.col(item_col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(head) > limit:
        raise ValueError(f"more than {limit} values of {item_col}: pass the values, or use sparse_vectors")
    return sorted(r[0] for r in head)


def pivot_matrix(df: DataFrame, values: list | None = None, user_col: str = "playlist_id",
                 item_col: str = "track_uri_index", rating_col: str = "rating",
                 assemble: bool = True) -> DataFrame:
    """One column per value: the user's largest rating of it, 0 without any (+ ``features``).

    The caller passes the values (of another matrix, say, to get its columns);
    by default they are those of the data.
    """
    wanted = pivot_values(df, item_col) if values is None else values
    cells = [F.coalesce(F.max(F.when(F.col(item_col) == F.lit(v), F.col(rating_col))), F.lit(0)).alias(str(v))
             for v in wanted]
    wide = df.groupBy(user_col).agg(*cells) if cells else df.select(user_col).distinct()
    if not assemble:
        return wide
    return VectorAssembler(inputCols=[str(v) for v in wanted], outputCol="features").transform(wide)
