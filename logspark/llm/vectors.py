"""Rows of an embedding table that can be worked with, as arrays of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """A vector that is not null and has entries, none of them null or non-finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def usable_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` of the usable rows. Vectors of another length than the most frequent one
    (of equally frequent ones the longest) cannot be compared with the rest and are left out."""
    rows = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")
    ).where(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("vector") == (lengths["length"] if lengths else 0))


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """A list column of one length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)
