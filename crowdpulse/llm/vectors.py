"""Vectors from array columns, packed into blocks for the tasks that compare them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null or empty, and without null, infinite or not-a-number components; not all zero."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; the largest component goes first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
