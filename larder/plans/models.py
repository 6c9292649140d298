"""Queries that fit models: clusters, regressions, grid search, scoring and the prediction log."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import aggregates as agg
from larder.operators import clusters as clu
from larder.operators import performance
from larder.operators import regression as reg
from larder.operators import splits
from larder.operators.filters import term
from larder.operators.joins import concat_sets
from larder.plans import views
from larder.plans.monitoring import rounded
from larder.plans.registry import FEATURES_SQL, LABELED_SQL, query
from larder.plans.views import Tables
from larder.schemas import FEATURES
from larder.session import fresh_path, materialise
from larder.sources import tables

#: Two values of every parameter; the operator's default is the full grid.
TRIAL_GRID = {
    "n_estimators": [2, 4], "learning_rate": [0.1, 0.3], "max_depth": [2, 3], "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0],
}


def stored_features(t: Tables) -> DataFrame:
    """Labelled feature rows, written once: every fit and every scoring pass reads the flat columns."""
    return materialise(views.labeled_features(t), "features", "label")


# --- clusters -----------------------------------------------------------------------------------------------------


@query("kmeans_clusters")
def kmeans_clusters(t: Tables) -> DataFrame:
    """k-means with ten clusters on the scores: size, range and center of each."""
    scores = materialise(clu.weighted_scores(views.features(t)), "scores")
    cuts = clu.fit_kmeans(scores)
    return scores.groupBy(clu.cluster_of(F.col("score"), cuts).alias("cluster")).agg(
        F.sum("n").cast("bigint").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"),
        F.round(F.sum(F.col("score") * F.col("n")) / F.sum("n"), 6).alias("center"),
    )


@query("cluster_table")
def cluster_table(t: Tables) -> DataFrame:
    """Every training document with its hierarchical and k-means cluster."""
    training = term(stored_features(t), "label", "training")
    return clu.cluster_table(training).select("fid", "description", "cluster_hierarchical", "cluster_cmeans")


WIDE = """wide AS (
  SELECT l_quantity, width_no AS cluster FROM (SELECT l_quantity, floor((l_quantity - 1) / 10)::INTEGER AS width_no FROM lineitem))"""


@query("ward_clusters")
def ward_clusters(t: Tables) -> DataFrame:
    """Ward clustering of all line-item prices into ten clusters: size and range of each."""
    scores = materialise(clu.weighted_scores(t("lineitem"), "l_extendedprice"), "scores")
    cuts = clu.fit_ward(scores, 10, "l_extendedprice")
    return scores.groupBy(clu.cluster_of(F.col("l_extendedprice"), cuts).alias("cluster")).agg(
        F.sum("n").cast("bigint").alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


@query(
    "calinski",
    f"""WITH {WIDE}, per AS (SELECT cluster, count(*) AS w, sum(l_quantity) AS s, sum(l_quantity * l_quantity) AS q FROM wide GROUP BY cluster)
    SELECT count(*) AS k, sum(w)::BIGINT AS n, round(((sum(s * s / w) - sum(s) * sum(s) / sum(w)) / (count(*) - 1)) / (sum(q - s * s / w) / (sum(w) - count(*))), 4) AS calinski FROM per""",
)
def calinski(t: Tables) -> DataFrame:
    """Calinski-Harabasz index of equal-width quantity bands."""
    rows = t("lineitem").select("l_quantity", F.floor((F.col("l_quantity") - 1) / 10).cast("int").alias("cluster"))
    return clu.calinski_harabasz(rows, "cluster", "l_quantity").select("k", "n", F.round("calinski", 4).alias("calinski"))


@query("cluster_sweep")
def cluster_sweep(t: Tables) -> DataFrame:
    """Silhouette and Calinski-Harabasz for k = 2 to 19 and both methods, on the scores of all foods."""
    return clu.sweep(views.features(t).select("score"))


@query("cluster_validation")
def cluster_validation(t: Tables) -> DataFrame:
    """Clusters fitted on the training rows applied to the validation rows: MSE, RMSE, R2."""
    rows = stored_features(t)
    checked = clu.validate_clusters(term(rows, "label", "training"), term(rows, "label", "validation"))
    return clu.validation_measures(checked)


# --- regressions --------------------------------------------------------------------------------------------------


@query(
    "linear_one_feature",
    f"""WITH {FEATURES_SQL} SELECT round(regr_slope(score, sodium), 6) AS slope, round(regr_intercept(score, sodium), 6) AS intercept,
    round(regr_r2(score, sodium), 6) AS r2, count(*) AS n FROM feature_rows""",
)
def linear_one_feature(t: Tables) -> DataFrame:
    """Least squares of the score on sodium, through the estimator."""
    rows = materialise(views.features(t).select("fid", "sodium", "score"), "one-feature")
    model = reg.fit_linear(rows, ["sodium"])
    fitted = reg.predict(model, rows, features=["sodium"])
    return agg.regression_measures(fitted, [], "score", "predictions").select(
        F.round(F.lit(float(model.coefficients[0])), 6).alias("slope"), F.round(F.lit(float(model.intercept)), 6).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n",
    )


@query("linear_r2")
def linear_r2(t: Tables) -> DataFrame:
    """Least squares on the 13 features, R2 on the validation and testing sets."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"))
    scored = reg.predict(model, rows.where(F.col("label") != "training"))
    return rounded(reg.linear_scores(scored, "score", "predictions"), [], 4)


@query("boosted_grid")
def boosted_grid(t: Tables) -> DataFrame:
    """Trial table of a grid with two values of every parameter, best R2 on the validation set first."""
    rows = stored_features(t)
    return reg.grid_search(term(rows, "label", "training"), term(rows, "label", "validation"), TRIAL_GRID)[0]


def fitted_models(t: Tables, rows: DataFrame) -> dict[str, object]:
    """The linear model and the best boosted trial, fitted on the training rows, saved, registered and loaded again."""
    training = term(rows, "label", "training")
    root = fresh_path(t.spark, "models")
    _, best = reg.grid_search(training, term(rows, "label", "validation"), TRIAL_GRID)
    registry, run = f"{root}/registry", "run-1"
    tables.save_model(t.spark, reg.fit_linear(training), f"{root}/linear_regression_model", registry, run, "linear_regression_model")
    tables.save_model(t.spark, reg.fit_boosted(training, best), f"{root}/xgboost_model", registry, run, "xgboost_model")
    kinds = {"linear_regression_model": ("regression", LinearRegressionModel), "xgboost_model": ("xgboost", GBTRegressionModel)}
    stored = tables.scan(t.spark, registry, None).orderBy("name").collect()
    return {kinds[r["name"]][0]: tables.load_model(kinds[r["name"]][1], r["path"]) for r in stored}


@query("predict_all")
def predict_all(t: Tables) -> DataFrame:
    """Saved models loaded and applied to the validation, testing and not-labelled rows in one pass; quality per model and set.

    Every fifth food counts as not labelled yet and takes part in no fit.
    """
    fresh = F.when(F.col("fid") % 5 == 0, "not-labelled").otherwise(F.col("label"))
    rows = materialise(views.labeled_features(t).withColumn("label", fresh), "features", "label")
    scored = reg.predict_all(rows.where(F.col("label") != "training"), fitted_models(t, rows))
    names = {"xgboost_predictions": "xgboost", "regression_predictions": "regression"}
    long = performance.model_rows(scored, names, ["fid", "label", "score"])
    return rounded(performance.regression_quality(long, ["model", "label"], "score", "predictions"), [], 4)


@query("residual_table")
def residual_table(t: Tables) -> DataFrame:
    """Residuals of the linear model against the prediction and every feature, in bins."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"))
    scored = reg.predict(model, term(rows, "label", "validation"))
    return rounded(reg.residual_bins(reg.residual_rows(scored, "score", "predictions")), [], 4)


@query("model_report")
def model_report(t: Tables) -> DataFrame:
    """Performance report of the linear model on 13 features: every measure of every part, per labelled set."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"))
    scored = materialise(reg.predict(model, rows.where(F.col("label") != "training")), "scored")
    report = performance.performance_report(
        scored, ["label"], "score", "predictions", F.col("fid").cast("double"), FEATURES
    )
    parts = [performance.long_part(name, part, ["label"]) for name, part in report.items()]
    return rounded(concat_sets(*parts), [], 4)


@query(
    "linear_predictions",
    f"""WITH {LABELED_SQL}, fit AS (SELECT regr_slope(score, sodium) AS a, regr_intercept(score, sodium) AS b FROM labeled WHERE label = 'training')
    SELECT fid, label, score AS target, round(a * sodium + b, 4) AS prediction FROM labeled, fit WHERE label <> 'training'""",
)
def linear_predictions(t: Tables) -> DataFrame:
    """A saved and loaded model of one feature: the prediction of every validation and testing row."""
    rows = stored_features(t)
    path = fresh_path(t.spark, "models")
    tables.save_model(t.spark, reg.fit_linear(term(rows, "label", "training"), ["sodium"]), f"{path}/linear", f"{path}/registry", "run-1", "linear")
    model = tables.load_model(LinearRegressionModel, f"{path}/linear")
    scored = reg.predict(model, rows.where(F.col("label") != "training"), features=["sodium"])
    return scored.select("fid", "label", F.col("score").alias("target"), F.round("predictions", 4).alias("prediction"))


@query(
    "linear_residual_bins",
    f"""WITH {LABELED_SQL}, fit AS (SELECT regr_slope(score, sodium) AS a, regr_intercept(score, sodium) AS b FROM labeled WHERE label = 'training'),
    r AS (SELECT score - (a * sodium + b) AS residual, sodium AS x FROM labeled, fit WHERE label = 'validation'),
    e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 20 AS w FROM r)
    SELECT least(floor((x - lo) / w), 19)::BIGINT AS bin, count(*) AS n, round(avg(residual), 4) AS residual_mean FROM r, e GROUP BY ALL""",
)
def linear_residual_bins(t: Tables) -> DataFrame:
    """Mean residual of a model of one feature over bins of that feature."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"), ["sodium"])
    scored = reg.predict(model, term(rows, "label", "validation"), features=["sodium"])
    bins = reg.residual_bins(materialise(reg.residual_rows(scored, "score", "predictions", ["sodium"]), "residuals"))
    return bins.where("feature = 'sodium'").select("bin", "n", F.round("residual_mean", 4).alias("residual_mean"))


@query(
    "score_batches",
    f"""WITH {LABELED_SQL}, b AS (SELECT fid, score, (row_number() OVER (ORDER BY fid) - 1) // 100 AS batch FROM labeled WHERE label = 'testing')
    SELECT batch, count(*) AS n, round(sum(score), 5) AS target_sum FROM b GROUP BY batch""",
)
def score_batches(t: Tables) -> DataFrame:
    """Testing rows scored in batches of 100 and appended to the prediction log; the log is read back per batch."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"))
    batches = splits.fixed_batches(term(rows, "label", "testing"), "fid")
    path = fresh_path(t.spark, "prediction-log")
    tables.log_predictions(reg.predict(model, batches), path, "linear_regression_model")
    log = tables.scan(t.spark, path)
    return log.where(F.col("prediction").isNotNull()).join(batches.select("fid", "batch"), "fid").groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("target"), 5).alias("target_sum")
    )


@query(
    "task_batches",
    f"""WITH {LABELED_SQL}, fit AS (SELECT regr_slope(score, sodium) AS a, regr_intercept(score, sodium) AS b FROM labeled WHERE label = 'training')
    SELECT fid, round(score, 6) AS target, round(a * sodium + b, 6) AS prediction, 1 AS in_batch_of_100 FROM labeled, fit WHERE label <> 'training'""",
)
def task_batches(t: Tables) -> DataFrame:
    """Predictions of a model of one feature, scored inside the tasks 100 rows at a time and read back from the log."""
    rows = stored_features(t)
    model = reg.fit_linear(term(rows, "label", "training"), ["sodium"])
    others = rows.where(F.col("label") != "training").select("fid", "score", "sodium")
    scored = materialise(reg.score_in_batches(others, reg.linear_scorer(model), ["sodium"]), "scored-batches")
    path = fresh_path(t.spark, "prediction-log")
    tables.log_predictions(scored, path, "linear_regression_model")
    sizes = scored.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    fits = scored.join(sizes, "batch").select("fid", (F.col("n") <= 100).cast("int").alias("in_batch_of_100"))
    log = tables.scan(t.spark, path).select("fid", F.round("target", 6).alias("target"), F.round("prediction", 6).alias("prediction"))
    return log.join(fits, "fid")
