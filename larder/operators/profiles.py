"""Data stability tests and the data quality profile."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.ranks import exact_quantiles
from larder.session import materialise


def schema_tests(reference: DataFrame, current: DataFrame) -> list[tuple[str, str, float, float, str]]:
    """Tests that need no data: number of columns, missing columns, changed types."""
    ref, cur = dict(reference.dtypes), dict(current.dtypes)

    def status(ok: bool) -> str:
        return "pass" if ok else "fail"

    rows = [("column_count", "", float(len(ref)), float(len(cur)), status(len(ref) == len(cur)))]
    for name, kind in ref.items():
        same = cur.get(name) == kind
        rows.append(("column_type", name, 1.0, 1.0 if same else 0.0, status(same)))
    return rows


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value)`` of every cell; the aggregates over it combine on the map side to one row per column."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")


def moments(df: DataFrame, columns: list[str], bounds: Column | None = None) -> DataFrame:
    """``(column, rows, nulls, low, high, mean, std)`` from one aggregate over the rows as they are, a row per column.

    ``bounds`` is a map from column to ``struct<low, high>``; with it ``outside`` is the share of values beyond.
    """
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        parts = [
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.avg(v.isNull().cast("double")).alias("nulls"),
            F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        ]
        if bounds is not None:
            own = bounds[c]
            parts.append(F.avg(((v < own["low"]) | (v > own["high"])).cast("double")).alias("outside"))
        stats.append(F.struct(*parts))
    return df.agg(F.array(*stats).alias("a")).select(F.explode("a").alias("s")).select("s.*").where("rows > 0")


def stability_tests(
    reference: DataFrame, current: DataFrame, columns: list[str], categorical: list[str] | None = None, tolerance: float = 0.1
) -> DataFrame:
    """``(test, column, reference, current, status)``.

    One aggregate per side over rows as they are; the reference's bounds (one entry per column) travel as a scalar.
    Tests: row count within the tolerance, share of nulls, share outside the reference range, mean within two
    reference deviations, and for categorical columns the share of values the reference does not know.
    """
    ref = materialise(moments(reference, columns), "moments")
    bounds = ref.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("low", "high"))))).scalar()
    cur = materialise(moments(current, columns, bounds), "moments")
    both = ref.alias("r").join(cur.alias("k"), "column")

    def test(name: str, was: Column, now: Column, ok: Column) -> Column:
        return F.struct(
            F.lit(name).alias("test"), was.cast("double").alias("reference"), now.alias("current"),
            F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("status"),
        )

    def r(name: str) -> Column:
        return F.col(f"r.{name}")

    def k(name: str) -> Column:
        return F.col(f"k.{name}")

    tests = F.array(
        test("null_share", r("nulls"), k("nulls"), k("nulls") <= r("nulls") + tolerance),
        test("out_of_range", F.lit(0.0), F.col("outside"), F.col("outside") <= tolerance),
        test("mean_in_2_sigma", r("mean"), k("mean"), F.abs(k("mean") - r("mean")) <= r("std") * 2),
    )
    out = both.select("column", F.explode(tests).alias("t")).select("t.test", "column", "t.reference", "t.current", "t.status")
    was, now = F.max(r("rows")).cast("double"), F.max(k("rows")).cast("double")
    counted = both.agg(
        F.lit("row_count").alias("test"), F.lit("").alias("column"), was.alias("reference"), now.alias("current"),
        F.when(F.abs(now - was) <= was * tolerance, "pass").otherwise("fail").alias("status"),
    )
    out = out.unionByName(counted)
    for c in categorical or []:
        out = out.unionByName(_unknown_values(reference, current, c, tolerance))
    return out


def _unknown_values(reference: DataFrame, current: DataFrame, column: str, tolerance: float) -> DataFrame:
    counts = current.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    seen = reference.select(column).distinct().withColumn("_seen", F.lit(1))
    share = F.sum(F.when(F.col("_seen").isNull(), F.col("n")).otherwise(0)) / F.sum("n")
    return (
        counts.join(seen, column, "left")
        .agg(share.alias("current"))
        .select(
            F.lit("unknown_values").alias("test"), F.lit(column).alias("column"), F.lit(0.0).alias("reference"), "current",
            F.when(F.col("current") <= tolerance, "pass").otherwise("fail").alias("status"),
        )
    )


def quality_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, nulls, distinct values, min, quartiles, max, mean, deviation, share of zeros, top value.

    Moments come from one aggregate over the rows as they are. All about values comes from one stored count per
    (column, value).
    """
    long = _long(df, columns)
    stats = moments(df, columns).withColumnRenamed("rows", "n")
    counts = materialise(
        long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts"
    )
    top = F.max(F.struct(F.col("n"), (-F.col("value")).alias("v")))
    values = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        (F.sum(F.when(F.col("value") == 0, F.col("n")).otherwise(0)) / F.sum("n")).alias("zero_share"),
        (-top["v"]).alias("most_common"),
        (top["n"] / F.sum("n")).alias("most_common_share"),
    )
    quartiles = (
        exact_quantiles(counts, ["column"], "value", [0.25, 0.5, 0.75], weight="n")
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(a) for q, a in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    )
    return stats.join(values, "column").join(quartiles, "column")


def quick_profile(df: DataFrame, columns: list[str], error: float = 0.01) -> DataFrame:
    """The approximate form for very wide or very large tables: one pass, sketches only."""
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        q = F.percentile_approx(v, [0.25, 0.5, 0.75], int(1 / error))
        stats.append(
            F.struct(
                F.lit(c).alias("column"), F.count(v).alias("n"), F.approx_count_distinct(v, error).alias("distinct_values"),
                F.avg(v).alias("mean"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
            )
        )
    return df.agg(F.array(*stats).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def text_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: rows, share of nulls, of empty and of blank texts, least, mean and largest length, distinct texts.

    One aggregate over the rows as they are; the distinct texts are counted by 64-bit hash, combined before the shuffle. An
    empty table gives no rows.
    """
    stats = []
    for c in columns:
        v = F.col(c).cast("string")
        n = F.length(v)
        stats.append(
            F.struct(
                F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.avg(v.isNull().cast("double")).alias("nulls"),
                F.avg((n == 0).cast("double")).alias("empty"), F.avg((F.trim(v) == "").cast("double")).alias("blank"),
                F.min(n).cast("bigint").alias("shortest"), F.max(n).cast("bigint").alias("longest"), F.avg(n).alias("mean_length"),
            )
        )
    found = df.agg(F.array(*stats).alias("a")).select(F.explode("a").alias("s")).select("s.*").where("rows > 0")
    hashes = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string"))).alias(c) for c in columns])
    long = hashes.unpivot([], columns, "column", "hash").where("hash IS NOT NULL").distinct()
    distinct = long.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return found.join(distinct, "column", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))


def time_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per timestamp column: rows, share of nulls, first and last, number of days with rows, and rows of the fullest day.

    Rows are counted per column and day before the shuffle.
    """
    plain = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in columns])
    long = plain.unpivot([], columns, "column", "value")
    days = long.groupBy("column", F.to_date("value").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("first"), F.max("value").alias("last")
    )
    empty = F.col("day").isNull()
    return days.groupBy("column").agg(
        F.sum("n").alias("rows"), (F.sum(F.when(empty, F.col("n")).otherwise(0)) / F.sum("n")).alias("nulls"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.count("day").alias("days"),
        F.max(F.when(~empty, F.col("n"))).alias("most_in_a_day"),
    )


#: Sketch entries for each value that may reach the share: the sketch's error is then a sixth of the share at most.
TRACKED = 16


def value_sketches(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """``(column, sketch)``: a mergeable sketch of the frequent values of each column, over 64-bit hashes of the values.

    Sketches of parts of a table, such as days, can be stored and merged by ``merged_sketches``.
    """
    tracked = F.lit(int(TRACKED / share))
    made = [
        F.struct(F.lit(c).alias("column"), F.call_function("approx_top_k_accumulate", F.when(F.col(c).isNotNull(), F.xxhash64(c)), tracked).alias("sketch"))
        for c in columns
    ]
    return df.agg(F.array(*made).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def merged_sketches(sketches: DataFrame, share: float = 0.01) -> DataFrame:
    tracked = F.lit(int(TRACKED / share))
    return sketches.groupBy("column").agg(F.call_function("approx_top_k_combine", "sketch", tracked).alias("sketch"))


def heavy_values(df: DataFrame, columns: list[str], share: float = 0.01, sketches: DataFrame | None = None) -> DataFrame:
    """``(column, value, n)``: all values that at least ``share`` of the rows hold, with their exact counts.

    A first pass (or stored ``sketches`` of the same rows) names the candidates: every value of that share is among the
    2 / share most frequent of a sketch of this size. A second pass counts only these, so no task and no shuffle ever holds a
    count per distinct value, and long texts are moved only if they are frequent. Nulls are not values.
    """
    found = sketches if sketches is not None else value_sketches(df, columns, share)
    top = found.select("column", F.call_function("approx_top_k_estimate", "sketch", F.lit(int(2 / share))).alias("top"))
    named = {r["column"]: [x["item"] for x in r["top"] if x["item"] is not None] for r in top.collect()}
    cells = []
    for c in columns:
        known = F.array(*[F.lit(h) for h in named.get(c, [])]).cast("array<bigint>")
        hit = F.col(c).isNotNull() & F.array_contains(known, F.xxhash64(c))
        cells.append(F.when(hit, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))))
    long = df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.*")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= F.lit(share * df.count()))
