"""Helpers for tables of vectors: which take part, as what matrix, and equal vectors as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null or empty, hold no null or non-finite component and are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def fingerprint(vector: Column) -> Column:
    """Two 64-bit hashes of the components in double precision."""
    as_double = vector.cast("array<double>")
    return F.struct(F.xxhash64(as_double).alias("h1"), F.xxhash64(F.lit(7), as_double).alias("h2"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a list column as rows of doubles; all must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    n = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def sample(rows: DataFrame, order: Column, size: int, vector: str) -> np.ndarray:
    """At most `size` vectors, those first by `order`, on the driver."""
    found = rows.orderBy(order).limit(size).select(F.col(vector).cast("array<double>")).toArrow()
    return matrix(found.column(0)) if found.num_rows else np.zeros((0, 0))
