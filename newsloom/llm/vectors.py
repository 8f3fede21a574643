"""Vectors that take part in comparisons, and exact cosines."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null, has no null or non-finite component and is not zero."""
    value = lambda v: v.cast("double")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(value(v)) & (F.abs(value(v)) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def units(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, also where squares would overflow or vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal inputs give equal results wherever they stand."""
    a, b = np.ascontiguousarray(a, np.float64), np.ascontiguousarray(b, np.float64)
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def fingerprinted(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Adds key1, key2: a 128-bit fingerprint of the vector's components."""
    return rows.withColumn("key1", F.xxhash64(vector)).withColumn("key2", F.xxhash64(F.lit(99), vector))
