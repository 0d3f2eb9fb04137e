"""Helpers for tables of embeddings (vec_id, embedding)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(embedding: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def sound(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    return F.coalesce(F.forall(embedding, sound), F.lit(False))


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A list column whose lists are all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def distinct_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, many): sound rows with an id, equal ones as one with their number."""
    sound = vectors.where(F.col("vec_id").isNotNull()).where(finite()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return sound.groupBy("vec_id", "embedding").agg(F.count("*").alias("many"))
