"""Preparing vector columns: which rows take part, and packing into arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Not null, without null, NaN or infinite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def one_per_id(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vec``: rows that repeat an id count once, with the smallest
    vector; null ids and unusable vectors take no part."""
    usable = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).filter("id IS NOT NULL").filter(finite("vec"))
    return usable.groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    starts = np.cumsum(sizes) - sizes
    for i, (a, n) in enumerate(zip(starts, sizes)):
        out[i, :n] = flat[a : a + n]
    return out
