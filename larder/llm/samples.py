"""Bounded, reproducible samples of labelled and unlabelled rows, and a small numpy logistic regression.

Rows whose crc32(doc_id as text) mod 4 is 2 are held out: their labels are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(ident: Column) -> Column:
    """Whether the id belongs to the held-out fold; a null id doesn't."""
    return F.coalesce(F.crc32(ident.cast("string")) % 4 == 2, F.lit(False))


def label_sample(labels: DataFrame, label: str, rows: int, seed: str, value: int | None = None) -> DataFrame:
    """(doc_id, y): at most ``rows`` labelled ids outside the held-out fold, the first ones in an order by hash."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).dropDuplicates()
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    if value is not None:
        known = known.where(F.col("y") == value)
    return first_by_hash(known, rows, seed, ["doc_id", "y"])


def first_by_hash(df: DataFrame, rows: int, seed: str, order: list[str]) -> DataFrame:
    """At most ``rows`` rows, the first ones by a hash of ``doc_id``.

    The table's count gives a hash value below which about twice as many rows lie, so the rows that are ordered and sent
    to one task are bounded however large the table is.
    """
    total = df.count()
    key = F.xxhash64(F.lit(seed), "doc_id")
    if total > 2 * rows:
        df = df.where(key <= F.lit(-(1 << 63) + (2 * rows << 64) // total))
    return df.orderBy(key, *order).limit(rows)


def document_sample(docs: DataFrame, rows: int, seed: str) -> DataFrame:
    """(doc_id): at most ``rows`` ids of all documents, the first ones in an order by hash."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL")
    return first_by_hash(ids, rows, seed, ["doc_id"])


def with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sample's columns and the texts; the sample is small by construction and so is broadcast."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").select(*sample.columns, "text")


def piece(text: Column, ident: Column, size: int) -> Column:
    """At most ``size`` characters of a text, from a place chosen by the id's hash."""
    room = F.greatest(F.length(text) - size, F.lit(0)) + 1
    return F.substring(text, (F.pmod(F.xxhash64(ident), room) + 1).cast("int"), F.lit(size))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; zeros without rows (a score of one half)."""
    w = np.zeros(x.shape[1])
    for _ in range(steps if len(y) else 0):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y) + ridge * w
        curve = (x.T * (p * (1 - p))) @ x / len(y) + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def probability(z: np.ndarray) -> np.ndarray:
    """Scores to nine places, so that they don't depend on the order in which a task adds."""
    return np.round(sigmoid(z), 9)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
