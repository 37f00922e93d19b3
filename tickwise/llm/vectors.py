"""Reading vector columns for the embedding operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has components and all are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def lengths(rows: DataFrame, vector: str) -> list[int]:
    """The vector lengths present, one number each; 0 alone without rows."""
    return sorted(r["d"] for r in rows.select(F.size(vector).alias("d")).distinct().collect()) or [0]


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of an array column as one float64 matrix."""
    return np.vstack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 0))


def unpack(column: pd.Series, dtype: str = "<f8") -> np.ndarray:
    """Rows of a binary column of equal lengths as one matrix."""
    return np.frombuffer(b"".join(column), dtype=dtype).reshape(len(column), -1)
