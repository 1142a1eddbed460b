"""Integer vectors: what the vector operators of this subpackage read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def integers(vector: Column) -> Column:
    """floor(256 * c) of each entry as long; null if the vector is null or an entry is null or not finite."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.when(whole, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)))


def common_length(rows: DataFrame, x: str = "_x") -> int:
    """The commonest length of the vectors that are not empty, of equally common ones the longest; 0 without any."""
    common = rows.filter(F.size(x) > 0).groupBy(F.size(x).alias("size")).count().orderBy(
        F.desc("count"), F.desc("size")).first()
    return common["size"] if common else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The lists of an Arrow column, all of one length, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
