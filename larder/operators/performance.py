"""Regression performance reports over ``target`` and ``prediction``; error means prediction minus target."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.aggregates import feature_ranges, histogram
from larder.operators.ranks import attach_small, exact_quantiles, prefix_sums
from larder.operators.splits import last_rows


def with_errors(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """Adds ``error`` and ``ape`` (absolute percentage error, null for a zero target)."""
    e = F.col(prediction) - F.col(target)
    ape = F.when(F.col(target) != 0, F.abs(e / F.col(target)) * 100)
    return df.withColumn("error", e.cast("double")).withColumn("ape", ape.cast("double"))


def residual(target: Column, prediction: Column) -> Column:
    return target - prediction


def regression_quality(df: DataFrame, groups: list[str], target: str, prediction: str) -> DataFrame:
    """Mean error, MAE and MAPE with deviations, RMSE and R2 per group, in one aggregate."""
    y, e = F.col(target).cast("double"), F.col("error")
    spread = F.var_pop(y) * F.count(y)
    return with_errors(df, target, prediction).where(F.col("error").isNotNull()).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e).alias("mean_error"),
        F.stddev_samp(e).alias("error_std"),
        F.avg(F.abs(e)).alias("mae"),
        F.stddev_samp(F.abs(e)).alias("abs_error_std"),
        F.avg("ape").alias("mape"),
        F.stddev_samp("ape").alias("ape_std"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(spread > 0, 1 - F.sum(e * e) / spread).alias("r2"),
    )


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 20, groups: list[str] | None = None) -> DataFrame:
    """Two-dimensional counts per group in place of a point cloud: each group's bounds, then its cells."""
    groups = groups or []
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounds = F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).alias("_s")
    ends = rows.groupBy(*groups).agg(bounds)
    rows = attach_small(rows, ends, groups) if groups else rows.withColumn("_s", ends.scalar())

    def cell(c: str, low: str, high: str) -> Column:
        width = (F.col(f"_s.{high}") - F.col(f"_s.{low}")) / bins
        return F.when(width > 0, F.least(F.floor((F.col(c) - F.col(f"_s.{low}")) / width), F.lit(bins - 1))).otherwise(0)

    return rows.groupBy(
        *groups, cell(x, "x0", "x1").cast("bigint").alias("x_bin"), cell(y, "y0", "y1").cast("bigint").alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def over_order(df: DataFrame, groups: list[str], order: Column, columns: list[str], bins: int = 50) -> DataFrame:
    """Mean and deviation of columns along the row order, in bins of equal row count.

    ``order`` must be numeric and unique within a group.
    """
    rows = df.select(*groups, order.alias("_order"), *columns).withColumn("n", F.lit(1))
    ranked = prefix_sums(rows, groups, "_order", ["n"])
    bin_no = F.floor(F.col("before_n") * bins / F.col("all_n")).cast("bigint")
    measures = [m for c in columns for m in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]
    return ranked.groupBy(*groups, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"), *measures)


def qq_points(df: DataFrame, groups: list[str], column: str, points: int = 99) -> DataFrame:
    """Ordered values against normal quantiles on an even grid: ``(groups, point, theoretical, value)``."""
    grid = [i / (points + 1) for i in range(1, points + 1)]
    normal = F.array(*[F.lit(NormalDist().inv_cdf(p)) for p in grid])
    point = F.round(F.col("q") * (points + 1)).cast("int")
    return exact_quantiles(df, groups, column, grid).select(
        *groups, point.cast("bigint").alias("point"), F.get(normal, point - 1).alias("theoretical"), "value"
    )


def qq_line(points: DataFrame, groups: list[str]) -> DataFrame:
    """Fit of the Q-Q points: slope, intercept and correlation (near 1 for normal errors)."""
    x, y = "theoretical", "value"
    return points.groupBy(*groups).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("corr")
    )


def error_groups(df: DataFrame, groups: list[str], tail: float = 0.05) -> DataFrame:
    """Adds ``error_group``: under (lowest errors), over (highest) or majority."""
    if not groups:
        return error_groups(df.withColumn("_every", F.lit(0)), ["_every"], tail).drop("_every")
    cuts = (
        exact_quantiles(df, groups, "error", [tail, 1 - tail])
        .groupBy(*groups)
        .agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    )
    marked = attach_small(df, cuts, groups)
    name = F.when(F.col("error") <= F.col("_low"), "under").when(F.col("error") >= F.col("_high"), "over").otherwise("majority")
    return marked.withColumn("error_group", name).drop("_low", "_high")


def top_errors(df: DataFrame, groups: list[str], tail: float = 0.05) -> DataFrame:
    """Size, mean and deviation of the error in the three error groups."""
    return error_groups(df, groups, tail).groupBy(*groups, "error_group").agg(
        F.count(F.lit(1)).alias("n"), F.avg("error").alias("error_mean"), F.stddev_samp("error").alias("error_std")
    )


def largest_errors(df: DataFrame, ident: str, n: int = 10) -> DataFrame:
    """The rows with the largest absolute error."""
    return df.orderBy(F.desc(F.abs("error")), F.col(ident)).limit(n)


def performance_report(
    df: DataFrame, groups: list[str], target: str, prediction: str, order: Column, features: list[str] | None = None
) -> dict[str, DataFrame]:
    """All parts of the report by name, for every group at once."""
    rows = with_errors(df, target, prediction).where(F.col("error").isNotNull())
    points = qq_points(rows, groups, "error")
    report = {
        "quality": regression_quality(df, groups, target, prediction),
        "predicted_vs_actual": scatter_bins(rows, target, prediction, groups=groups),
        "along_order": over_order(rows, groups, order, [target, prediction, "error", "ape"]),
        "error_distribution": histogram(rows, "error", 30, groups),
        "error_normality": points,
        "error_normality_line": qq_line(points, groups),
        "top_errors": top_errors(rows, groups),
    }
    if features:
        report["top_error_features"] = feature_ranges(error_groups(rows, groups), [*groups, "error_group"], features)
    return report


def long_part(name: str, part: DataFrame, groups: list[str]) -> DataFrame:
    """A part of a report as ``(part, groups, key, measure, value)``: numbers as measures, other columns as the key."""
    numbers = [c for c, kind in part.dtypes if kind == "double" or c == "n"]
    keys = [c for c in part.columns if c not in numbers and c not in groups]
    wide = part.select(
        *groups, F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in keys]).alias("key"),
        *[F.col(c).cast("double").alias(c) for c in numbers],
    )
    return wide.unpivot([*groups, "key"], numbers, "measure", "value").select(F.lit(name).alias("part"), *groups, "key", "measure", "value")


def rolling_report(log: DataFrame, window: int = 3000) -> dict[str, DataFrame]:
    """Performance over the last ``window`` predictions of every model; the row order is that of time."""
    recent = last_rows(log, window)  # rn is 1 for the newest row
    return performance_report(recent, ["model"], "target", "prediction", -F.col("rn").cast("double"))


def rolling_quality(log: DataFrame, window: int = 3000) -> DataFrame:
    return regression_quality(last_rows(log, window), ["model"], "target", "prediction")


def model_rows(scored: DataFrame, models: dict[str, str], keep: list[str]) -> DataFrame:
    """Long form of a scored table: one row per document and model, with ``model`` and ``predictions``."""
    return scored.unpivot(keep, list(models), "_column", "predictions").withColumn(
        "model", F.create_map(*[F.lit(x) for pair in models.items() for x in pair])[F.col("_column")]
    ).drop("_column")
