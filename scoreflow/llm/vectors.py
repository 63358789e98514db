"""Reading an embedding table as integer vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(vector: Column) -> Column:
    """A vector without null, NaN or infinite entries (null and empty ones are none)."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def integer_vectors(rows: DataFrame, vector: str, scale: int, shift: int = 0) -> DataFrame:
    """The rows with a finite vector and `x`, its entries as
    floor(scale * entry) + shift. Vectors of another length than most (of
    equally common lengths the larger) are no points of this space and go like
    those with a non-finite entry. Entries beyond a long raise an error."""
    entries = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    found = rows.withColumn("x", entries).where(_finite(F.col("x")))
    sizes = found.groupBy(F.size("x").alias("size")).count().agg(F.max(F.struct("count", "size")).alias("m")).first()
    length = sizes.m["size"] if sizes.m else 0
    found = found.where(F.size("x") == length)
    return found.withColumn("x", F.transform("x", lambda c: F.floor(c * scale) + F.lit(shift).cast("bigint")))
