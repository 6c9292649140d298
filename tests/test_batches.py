"""Scoring in task batches: every row once, batches full but for a task's last one, the model's own predictions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.operators import regression as reg


@pytest.mark.parametrize(("rows", "parts", "size"), [(1000, 3, 100), (250, 1, 100), (7, 4, 100), (30, 2, 1)])
def test_score_in_batches(spark, rows, parts, size):
    df = spark.range(rows).select(
        F.col("id").alias("fid"), F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).alias("fat"), (F.col("id") % 7).alias("sodium"), F.lit("x").alias("batch_name")
    ).repartition(parts)
    got = reg.score_in_batches(df, reg.LinearScorer((2.0, -1.0), 3.0), ["fat", "sodium"], size).collect()
    assert len(got) == rows
    for r in got:
        assert r.predictions == pytest.approx(2 * (r.fat or 0) - r.sodium + 3)
    tasks = {}
    for batch, n in Counter(r.batch for r in got).items():
        tasks.setdefault(batch >> 32, []).append((batch, n))
    assert all(n == size for found in tasks.values() for _, n in sorted(found)[:-1]) and max(n for f in tasks.values() for _, n in f) <= size


def test_same_as_the_estimator(spark):
    df = spark.range(300).select(F.col("id").alias("fid"), F.rand(3).alias("fat"), F.rand(4).alias("sodium"))
    df = df.withColumn("score", 2 * F.col("fat") - F.col("sodium") + F.rand(5)).cache()
    model = reg.fit_linear(df, ["fat", "sodium"])
    want = {r.fid: r.predictions for r in reg.predict(model, df, features=["fat", "sodium"]).collect()}
    got = reg.score_in_batches(df, reg.linear_scorer(model), ["fat", "sodium"]).collect()
    assert {r.fid: pytest.approx(r.predictions) for r in got} == want
    assert reg.score_in_batches(df.limit(0), reg.linear_scorer(model), ["fat", "sodium"]).collect() == []
