"""Vectors in tables: which take part, and blocks of them as one binary value per row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, no null, NaN or infinite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def clean_vectors(table: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """id, vector array<double> and named further columns of rows that take part."""
    rows = table.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        *(F.col(f"`{c}`").alias(c) for c in more),
    )
    return rows.where(usable(F.col("vector")) & F.col("id").isNotNull())


def matrix(arrow_column) -> np.ndarray:
    """Rows of a list column of one length as a 2-d array."""
    return arrow_column.flatten().to_numpy(zero_copy_only=False).reshape(len(arrow_column), -1)
