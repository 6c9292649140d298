"""Search-style aggregations, audits and regression measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.nutrients import is_mapped
from larder.operators.ranks import attach_small, exact_quantiles, value_counts
from larder.schemas import FEATURES


def modal_values(df: DataFrame, column: str, size: int = 1) -> DataFrame:
    """The ``size`` most frequent values with their counts; equal counts: smaller value first."""
    return value_counts(df, column).orderBy(F.desc("n"), F.col(column)).limit(size)


def top_hits(df: DataFrame, column: str, ident: str, size: int = 2, ascending: bool = False) -> DataFrame:
    """First ``size`` documents by a column; ties by id."""
    by = F.asc(column) if ascending else F.desc(column)
    return df.orderBy(by, F.col(ident)).limit(size)


def named_aggregations(docs: DataFrame, ident: str = "fid", score: str = "score", size: int = 2) -> DataFrame:
    """Min, max, modal value and the best and worst documents in one result ``(name, rank, value, n, doc)``.

    Scores are counted once; min, max and mode come from those counts. The two hit lists are top-k scans that keep
    ``size`` rows per task.
    """
    counts = value_counts(docs, score)
    extremes = counts.agg(F.min(score).alias("low"), F.max(score).alias("high"))
    none = F.lit(None).cast("bigint")

    def row(name: str, rank: Column, value: Column, n: Column, doc: Column) -> list[Column]:
        return [
            F.lit(name).alias("name"), rank.cast("bigint").alias("rank"), value.alias("value"), n.alias("n"),
            doc.alias("doc"),
        ]

    def hits(name: str, ascending: bool) -> DataFrame:
        best = top_hits(docs.select(ident, score), score, ident, size, ascending)
        first = F.array_sort(
            F.collect_list(F.struct((F.col(score) if ascending else -F.col(score)).alias("o"), ident, score))
        )
        # at most `size` rows are collected into the array
        listed = best.agg(first.alias("_h")).select(F.posexplode("_h").alias("p", "h"))
        return listed.select(*row(name, F.col("p") + 1, F.col(f"h.{score}"), none, F.col(f"h.{ident}")))

    mode = modal_values(docs, score)
    parts = [
        extremes.select(*row("min_score", F.lit(1), F.col("low"), none, none)),
        extremes.select(*row("max_score", F.lit(1), F.col("high"), none, none)),
        mode.select(*row("zero_score_docs", F.lit(1), F.col(score), F.col("n"), none)),
        hits("highest_score_docs", False),
        hits("lowest_score_docs", True),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def describe(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per group, with exact quartiles."""
    if not groups:
        return describe(df.withColumn("_all", F.lit(0)), ["_all"], column).drop("_all")
    c = F.col(column).cast("double")
    base = df.groupBy(*groups).agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
        F.max(c).alias("max"),
    )
    quartiles = (
        exact_quantiles(df.select(*groups, c.alias("_v")), groups, "_v", [0.25, 0.5, 0.75])
        .groupBy(*groups)
        .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    )
    return base.join(quartiles, groups, "left")


def split_sizes(labeled: DataFrame) -> DataFrame:
    """Planned sizes (thirds of the total, remainder last) beside the real count of every label."""
    counts = labeled.groupBy("label").agg(F.count(F.lit(1)).alias("actual"))
    total = counts.agg(F.sum("actual")).scalar()
    third = F.floor(total / 3).cast("bigint")
    planned = F.when(F.col("label") == "testing", total - third * 2).otherwise(third)
    return counts.select("label", "actual", planned.cast("bigint").alias("planned"))


def regression_measures(df: DataFrame, groups: list[str], target: str, prediction: str) -> DataFrame:
    """MSE, RMSE and R2 per group in one aggregate; R2 is null for a constant target."""
    y = F.col(target).cast("double")
    e = y - F.col(prediction)
    n = F.count(e)
    spread = F.var_pop(y) * n
    return df.where(y.isNotNull() & F.col(prediction).isNotNull()).groupBy(*groups).agg(
        n.alias("n"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(spread > 0, F.lit(1.0) - F.sum(e * e) / spread).alias("r2"),
    )


def unit_audit(docs: DataFrame, bag: Column, terms) -> DataFrame:
    """Scored nutrients whose unit is not the one the score needs: count per nutrient and unit."""
    wanted = F.create_map(*[F.lit(x) for t in terms for x in (t[0], t[1])])
    entries = docs.select(F.explode(F.map_entries(bag)).alias("e")).select(
        F.col("e.key").alias("nutrient"), F.col("e.value.unit_name").alias("unit_name")
    )
    expected = wanted[F.col("nutrient")]
    return (
        entries.where(expected.isNotNull() & ~F.col("unit_name").eqNullSafe(expected))
        .groupBy("nutrient", F.coalesce("unit_name", F.lit("")).alias("unit_name"))
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def distinct_names(docs: DataFrame, bag: Column) -> DataFrame:
    """Nutrient names that occur, with the number of documents."""
    return docs.select(F.explode(F.map_keys(bag)).alias("nutrient")).groupBy("nutrient").agg(F.count(F.lit(1)).alias("docs"))


def unmapped_names(docs: DataFrame, bag: Column, kind: str) -> DataFrame:
    """Names the rename map does not know."""
    return distinct_names(docs, bag).where(~is_mapped(F.col("nutrient"), kind))


def histogram(df: DataFrame, column: str, bins: int = 30, groups: list[str] | None = None) -> DataFrame:
    """Equal-width bins between min and max, the last bin closed; a constant column falls into bin 0.

    Two scans with a combined aggregate each; only bounds and bin counts are shuffled.
    """
    groups = groups or []
    c = F.col(column).cast("double")
    rows = df.select(*groups, c.alias("_v")).where(F.col("_v").isNotNull())
    ends = rows.groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    if groups:
        placed = attach_small(rows, ends, groups)
    else:
        edge = ends.select(F.struct("_lo", "_hi").alias("s")).scalar()
        placed = rows.withColumn("_lo", edge["_lo"]).withColumn("_hi", edge["_hi"])
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        placed.withColumn("bin", bin_no.cast("bigint"))
        .groupBy(*groups, "bin", "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*groups, "bin", (F.col("_lo") + width * F.col("bin")).alias("bin_start"), "n")
    )


def feature_ranges(df: DataFrame, groups: list[str], columns: list[str] = FEATURES) -> DataFrame:
    """Min, mean and max of every feature per group, in long form."""
    long = df.unpivot(groups, columns, "column", "value")
    return long.groupBy(*groups, "column").agg(
        F.min("value").alias("low"), F.avg("value").alias("mean"), F.max("value").alias("high")
    )
