"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def matrix(vectors: pd.Series, dtype: type = np.float64) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    if not len(vectors):
        return np.zeros((0, 0), dtype)
    sizes = {len(v) for v in vectors}
    if len(sizes) == 1:
        return np.stack([np.asarray(v, dtype) for v in vectors])
    out = np.zeros((len(vectors), max(sizes)), dtype)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out
