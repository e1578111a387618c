"""Vectors of whole numbers: what operators on scaled embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import only

#: Scaled components beyond this are set to it, so that squared distances of up to 64 components fit a long.
LARGEST = 1 << 27

#: Vectors that a task works on at a time.
BLOCK = 4096

LONG = (1 << 63) - 1


def complete(v: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_numbers(v: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double; at most LARGEST either way."""
    cut = lambda x: F.least(F.greatest(x.cast("double") * F.lit(float(scale)), F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    return F.transform(v, lambda x: F.floor(cut(x)).cast("int"))


def whole_vectors(vectors: DataFrame, scale: int, *carry: str) -> DataFrame:
    """(carry..., q): the complete vectors of column ``embedding`` in whole numbers."""
    rows = only(vectors, *carry, "embedding")
    return rows.where(complete(F.col("embedding"))).select(*[F.col(f"`{c}`") for c in carry], whole_numbers(F.col("embedding"), scale).alias("q"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of equally long integer lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def as_long(total: int) -> int | None:
    """A total as a long, null if it does not fit."""
    return total if total <= LONG else None
