"""Data-set labels, the cap on zero-score documents, windows and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import hash_bucket
from larder.operators.ranks import attach_small, kth_value, number_rows, top_n_per_group

LABELS = ("training", "validation", "testing")


def label_rows(df: DataFrame, key: str, seed: str = "larder", labels: Sequence[str] = LABELS) -> DataFrame:
    """Adds ``label``: an even split by a hash of the key, the same on every run and partitioning."""
    bucket = hash_bucket(F.col(key), seed, len(labels))
    return df.withColumn("label", F.get(F.array(*[F.lit(x) for x in labels]), bucket))


def cap_zero_scores(
    df: DataFrame, order: str, score: str = "score", percent: int = 15, cap_zeros_only: bool = False
) -> DataFrame:
    """Drop zero-score rows beyond the first ``percent`` of the rows in ``order`` (a unique integer key).

    A running count of kept rows decides in the plain loop; in closed form a zero-score row stays if and only if
    its position is at most floor(percent of n) + 1. The key at that position is found by counting, so no row is
    numbered. ``cap_zeros_only`` counts only the zero-score rows against the limit.
    """
    zeros = F.coalesce(F.col(score) == 0, F.lit(False))
    n = df.count()
    position = n * percent // 100 + 1
    counted = df.where(zeros) if cap_zeros_only else df
    cutoff = kth_value(counted.select(order), order, position)
    return df if cutoff is None else df.where(~zeros | (F.col(order) <= F.lit(cutoff)))


def split_dataset(df: DataFrame, key: str, seed: str = "larder") -> DataFrame:
    """Cap the zero scores, then label every row."""
    return label_rows(cap_zero_scores(df, key), key, seed)


def even_batches(df: DataFrame, order: str, batches: int = 10) -> DataFrame:
    """Adds ``batch`` 1..batches; the first ``n mod batches`` batches get one row more."""
    numbered = number_rows(df, [F.col(order)])
    n = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    small, extra = F.floor(n / batches), n % batches
    wide = extra * (small + 1)
    batch = F.when(F.col("rn") <= wide, F.floor((F.col("rn") - 1) / (small + 1))).otherwise(
        extra + F.floor((F.col("rn") - 1 - wide) / small)
    )
    return numbered.withColumn("batch", (batch + 1).cast("bigint")).drop("rn")


def fixed_batches(df: DataFrame, order: str, size: int = 100) -> DataFrame:
    """Adds ``batch`` 0, 1, ... of ``size`` rows each in order."""
    numbered = number_rows(df, [F.col(order)])
    return numbered.withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint")).drop("rn")


def last_rows(log: DataFrame, n: int = 3000, model: str = "model", ts: str = "ts", ident: str = "fid") -> DataFrame:
    """The latest ``n`` rows of every model, with ``rn`` 1 for the newest.

    Rows per model and day are counted first (a few rows per model). Days older than the one in which the n-th
    newest row lies are then left out, so that only about ``n`` rows per model are ranked.
    """
    day = F.to_date(ts)
    per_day = log.groupBy(model, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    newest = Window.partitionBy(model).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    needed = per_day.withColumn("_newer", F.coalesce(F.sum("_n").over(newest), F.lit(0))).where(F.col("_newer") < n)
    first_day = needed.groupBy(model).agg(F.min("_day").alias("_from"))
    recent = attach_small(log, first_day, [model]).where(day >= F.col("_from")).drop("_from")
    return top_n_per_group(recent, [model], [F.desc(ts), F.col(ident)], n, F.col(ident))
