"""Vector columns as matrices: which rows hold a usable vector, and their numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector is there, has entries, and none of them is null or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(column).isNotNull() & (F.size(column) > 0) & ~bad


def main_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length among usable vectors, the largest of equally frequent ones; 0 without any.

    Counts are aggregated by length and one row comes back.
    """
    found = (vectors.where(usable(column)).groupBy(F.size(column).alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).first())
    return found.d if found else 0


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``length`` entries, as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), length)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    return pa.array([raw[k].tobytes() for k in range(len(raw))], pa.binary()) if width else pa.nulls(
        len(raw), pa.binary())


def unpacked(column: pa.Array, length: int, kind: type = np.float64) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), length)
