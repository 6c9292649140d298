"""Vector functions on array columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.bind import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a side is missing or has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def unit_vector(a: Column) -> Column:
    """``a`` scaled to length 1, so that a later cosine is only a dot product; null for a zero vector."""
    return let(
        F.sqrt(dot(a, a)), lambda norm: F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm))
    )


def mean_vectors(df: DataFrame, keys: list[str], column: str, weight: str | None = None) -> DataFrame:
    """Mean vector per key, of any length: one aggregate of whole vectors, combined on the map side; nulls are left out."""
    known = df.where(F.col(column).isNotNull()).withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))
    mean = Summarizer.mean(F.col("_v"), F.col(weight).cast("double")) if weight else Summarizer.mean(F.col("_v"))
    return known.groupBy(*keys).agg(mean.alias("_m")).select(*keys, vector_to_array("_m").alias(column))
