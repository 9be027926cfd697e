"""Vectors as whole numbers, for the exact operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest vector taken: matrices of this width squared are held by the driver and by tasks.
MOST_DIMENSIONS = 8_192


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and x = floor(scale * component), in double precision, of rows whose vector has only finite components."""
    v = F.col("embedding")
    sound = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def width(rows: DataFrame) -> int:
    """Components of the longest vector (0 without rows)."""
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if dim > MOST_DIMENSIONS:
        raise ValueError(f"a vector has {dim} components; at most {MOST_DIMENSIONS} are taken")
    return dim


def padded(dim: int):
    """x with zeros after its last component, up to ``dim``."""
    return F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))


def stacked(column, dim: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
