"""Linear and boosted-tree regression on the nutrient features, grid search and residual tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.aggregates import regression_measures
from larder.schemas import FEATURES

# The full grid, 576 trials.
FULL_GRID = {
    "n_estimators": [10, 20, 50, 100],
    "learning_rate": [0.1, 0.05, 0.01, 0.001],
    "max_depth": [3, 5, 7, 9],
    "subsample": [0.8, 0.9, 1.0],
    "colsample_bytree": [0.8, 0.9, 1.0],
}
TRIALS = (
    "trial_no int, n_estimators int, learning_rate double, max_depth int, subsample double, "
    "colsample_bytree double, r2 double"
)


def assemble(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Rows with ``features``; missing features and targets count as 0."""
    filled = df.fillna(0, subset=[*features, *(["score"] if "score" in df.columns else [])])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def fit_linear(train: DataFrame, features: list[str] = FEATURES, target: str = "score") -> LinearRegressionModel:
    """Ordinary least squares from one pass over the rows."""
    return LinearRegression(featuresCol="features", labelCol=target, solver="normal", regParam=0.0).fit(
        assemble(train, features)
    )


def predict(
    model: Model | PipelineModel, df: DataFrame, name: str = "predictions", features: list[str] = FEATURES
) -> DataFrame:
    return model.transform(assemble(df, features)).withColumnRenamed("prediction", name).drop("features")


def predict_all(df: DataFrame, models: dict[str, Model], features: list[str] = FEATURES) -> DataFrame:
    """One pass that adds ``<name>_predictions`` for every model."""
    rows = assemble(df, features)
    for name, model in models.items():
        rows = model.transform(rows).withColumnRenamed("prediction", f"{name}_predictions")
    return rows.drop("features")


@dataclass(frozen=True)
class LinearScorer:
    """A linear model as a function of a matrix of features, small enough to be broadcast."""

    weights: tuple[float, ...]
    intercept: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ np.array(self.weights) + self.intercept


def linear_scorer(model: LinearRegressionModel) -> LinearScorer:
    return LinearScorer(tuple(float(w) for w in model.coefficients), float(model.intercept))


def score_in_batches(
    df: DataFrame, scorer: Callable[[np.ndarray], np.ndarray], features: list[str] = FEATURES, size: int = 100, name: str = "predictions"
) -> DataFrame:
    """Adds ``name`` and ``batch``: every task scores its rows ``size`` at a time with a model that is broadcast once.

    No row is numbered or moved: ``batch`` counts within the task, with the task in its high bits, and only a task's last
    batch is short. A missing feature counts as 0; rows stay in their order and as often as they occur; an empty table gives
    no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(scorer)
    at = [df.columns.index(f) for f in features]
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType()), T.StructField("batch", T.LongType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The task's rows in tables of ``size`` rows, whatever the borders of the batches that come in."""
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while rows + batch.num_rows >= size:
                cut = size - rows
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                batch, held, rows = batch.slice(cut), [], 0
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, table in enumerate(whole(batches)):
            columns = [np.nan_to_num(table.column(c).to_numpy().astype(float)) for c in at]
            found = shared.value(np.stack(columns, axis=1))
            table = table.append_column(name, pa.array(found, pa.float64()))
            yield from table.append_column("batch", pa.array([first + i] * table.num_rows, pa.int64())).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def linear_scores(scored: DataFrame, target: str, prediction: str) -> DataFrame:
    """R2 on each labelled set."""
    return regression_measures(scored, ["label"], target, prediction).select("label", "n", "r2")


def _booster(params: dict, trees: int, target: str) -> GBTRegressor:
    share = params["colsample_bytree"]
    return GBTRegressor(
        featuresCol="features", labelCol=target, maxIter=trees, stepSize=params["learning_rate"],
        maxDepth=params["max_depth"], subsamplingRate=params["subsample"],
        featureSubsetStrategy="all" if share >= 1.0 else str(share), seed=42,
    )


def fit_boosted(train: DataFrame, params: dict, features: list[str] = FEATURES, target: str = "score") -> GBTRegressionModel:
    return _booster(params, params["n_estimators"], target).fit(assemble(train, features))


def grid_trials(grid: dict[str, list]) -> list[dict]:
    names = ["n_estimators", "learning_rate", "max_depth", "subsample", "colsample_bytree"]
    return [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    grid: dict[str, list] = FULL_GRID,
    features: list[str] = FEATURES,
    target: str = "score",
    threads: int = 2,
) -> tuple[DataFrame, dict]:
    """Trial table (best R2 on the validation rows first, ties by trial number) and the parameters of the best trial.

    Trees are added one after the other, so a model with fewer trees is the beginning of a longer one: each setting
    is fitted once with the largest number of trees, and the error after every tree gives the R2 of all sizes.
    """
    trials = grid_trials(grid)
    fit_rows, check = assemble(train, features).persist(), assemble(validation, features).persist()
    spread = check.agg(F.var_pop(target)).first()[0]
    most = max(grid["n_estimators"])
    settings = [dict(s) for s in {tuple((k, v) for k, v in t.items() if k != "n_estimators") for t in trials}]

    def losses(setting: dict) -> tuple[tuple, list[float]]:
        model = _booster(setting, most, target).fit(fit_rows)
        return tuple(sorted(setting.items())), model.evaluateEachIteration(check, "squared")

    try:
        with ThreadPool(threads) as pool:
            by_setting = dict(pool.map(losses, settings))
    finally:
        fit_rows.unpersist()
        check.unpersist()
    rows = []
    for i, t in enumerate(trials):
        key = tuple(sorted((k, v) for k, v in t.items() if k != "n_estimators"))
        mse = by_setting[key][t["n_estimators"] - 1]
        r2 = 1 - mse / spread if spread else None
        rows.append((i, t["n_estimators"], t["learning_rate"], t["max_depth"], t["subsample"], t["colsample_bytree"], r2))
    table = train.sparkSession.createDataFrame(rows, TRIALS).orderBy(F.desc("r2"), "trial_no")
    best = max(rows, key=lambda r: (r[-1] if r[-1] is not None else float("-inf"), -r[0]))
    return table, trials[best[0]]


def residual_rows(df: DataFrame, target: str, prediction: str, features: list[str] = FEATURES) -> DataFrame:
    """``(feature, x, residual)`` for the predicted value and every feature."""
    rows = df.select(
        (F.col(target) - F.col(prediction)).alias("residual"), F.col(prediction).alias("predicted"),
        *[F.col(f).cast("double").alias(f) for f in features],
    )
    return rows.unpivot(["residual"], ["predicted", *features], "feature", "x").select("feature", "x", "residual")


def residual_bins(long: DataFrame, bins: int = 20) -> DataFrame:
    """Mean residual per equal-width bin of each feature: the chart data without the points."""
    # one row per feature
    ends = long.groupBy("feature").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        long.join(F.broadcast(ends), "feature")
        .groupBy("feature", bin_no.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("residual").alias("residual_mean"))
    )
