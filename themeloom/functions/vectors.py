"""Vector helpers for array<double> columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x
    )


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of an Arrow batch as one float64 matrix."""
    return np.vstack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)
