"""Distribution drift between a reference and a current table.

Numeric columns: KS, Wasserstein and PSI. Categorical columns: chi-square and Jensen-Shannon distance. Which test decides
about a column follows from its role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.bind import let
from larder.operators.ranks import exact_quantiles, prefix_sums
from larder.schemas import ColumnRoles
from larder.session import materialise

SERIES_TERMS = 100
#: Coefficients of the asymptotic series of the logarithm of the gamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def side_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, r, c)``: how often each value occurs on either side, in one shuffle of combined counts."""

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        return df.select(F.lit(is_ref).alias("_ref"), *[F.col(c).cast("double").alias(c) for c in columns])

    long = side(reference, 1).unionByName(side(current, 0)).unpivot(["_ref"], columns, "column", "value")
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("_ref").cast("bigint").alias("r"), F.sum(1 - F.col("_ref")).cast("bigint").alias("c"))
    )


def ks_p_value(d: Column, n1: Column, n2: Column, terms: int = SERIES_TERMS) -> Column:
    """Asymptotic two-sample p-value with the small-sample correction; 1 where the series does not converge."""
    root = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (root + 0.12 + 0.11 / root) * d

    def series(x: Column) -> Column:
        total = F.aggregate(
            F.sequence(F.lit(1), F.lit(terms)),
            F.lit(0.0),
            lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
        )
        return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2.0 * total, F.lit(0.0)), F.lit(1.0)))

    return let(lam, series)


def drift_measures(counts: DataFrame, stored: bool = False) -> DataFrame:
    """Per column KS distance with p-value, Wasserstein-1 distance and the shifts of the mean and the quartiles, all in one pass.

    ``stored`` says that the counts are a written table.
    """
    ranked = prefix_sums(counts, ["column"], "value", ["r", "c"], stored)
    gap = F.abs(
        (F.col("before_r") + F.col("r")) / F.col("all_r") - (F.col("before_c") + F.col("c")) / F.col("all_c")
    )

    def quantile(side: str, q: float) -> Column:
        """Smallest value that at least a share ``q`` of the side's rows doesn't exceed."""
        return F.min(F.when(F.col(f"before_{side}") + F.col(side) >= F.col(f"all_{side}") * q, F.col("value")))

    measured = ranked.groupBy("column").agg(
        F.max(gap).alias("ks"),
        F.sum(gap * (F.coalesce("next_value", "value") - F.col("value"))).alias("wasserstein"),
        (F.sum(F.col("value") * F.col("c")) / F.sum("c") - F.sum(F.col("value") * F.col("r")) / F.sum("r")).alias("mean_shift"),
        *[(quantile("c", q) - quantile("r", q)).alias(f"q{int(q * 100)}_shift") for q in (0.25, 0.5, 0.75)],
        F.sum("r").alias("n_ref"),
        F.sum("c").alias("n_cur"),
    )
    return measured.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))


def drift_test(
    reference: DataFrame, current: DataFrame, columns: list[str], drift_share: float = 0.5, alpha: float = 0.05
) -> DataFrame:
    """KS test per column; the data set drifts if at least ``drift_share`` of the columns do."""
    counts = materialise(side_counts(reference, current, columns), "drift-counts")
    tested = drift_measures(counts, stored=True).select(
        "column", "ks", "p_value", (F.col("p_value") < alpha).cast("int").alias("drifted")
    )
    # the table has one row per tested column, so this window is as small as the column list
    share = F.avg("drifted").over(Window.partitionBy(F.lit(0)))
    return tested.withColumn("dataset_drift", (share >= drift_share).cast("int"))


def population_stability(counts: DataFrame, bins: int = 10, floor: float = 0.0001) -> DataFrame:
    """PSI per column on the reference's quantile bins; an empty bin counts as ``floor``."""
    cuts = [i / bins for i in range(1, bins)]
    edges = (
        exact_quantiles(counts.where(F.col("r") > 0), ["column"], "value", cuts, weight="r")
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("_edges"))
    )
    # one row per tested column
    placed = counts.join(F.broadcast(edges), "column").withColumn(
        "bin", F.size(F.filter("_edges", lambda e: e < F.col("value")))
    )
    # the bins of one column are few rows; every bin exists on at least one side
    per_bin = placed.groupBy("column", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    totals = per_bin.groupBy("column").agg(F.sum("r").alias("all_r"), F.sum("c").alias("all_c"))
    share_r = F.greatest(F.col("r") / F.col("all_r"), F.lit(floor))
    share_c = F.greatest(F.col("c") / F.col("all_c"), F.lit(floor))
    return (
        per_bin.join(totals, "column")
        .groupBy("column")
        .agg(F.sum((share_c - share_r) * F.ln(share_c / share_r)).alias("psi"))
    )


def rolling_drift(log: DataFrame, window: int, model: str = "model", ident: str = "fid") -> DataFrame:
    """Drift of the targets and predictions of each model's last ``window`` rows against the rows before them.

    ``column`` is ``model.target`` or ``model.prediction``. Each row of the log is marked once as old or recent by its key.
    """
    from larder.operators.splits import last_rows

    recent = last_rows(log, window).select(model, ident, F.lit(1).alias("_recent"))
    marked = log.join(recent, [model, ident], "left").withColumn("_recent", F.coalesce("_recent", F.lit(0)))
    long = marked.unpivot([model, "_recent"], ["target", "prediction"], "_part", "value").where(F.col("value").isNotNull())
    counts = long.groupBy(F.concat_ws(".", model, "_part").alias("column"), "value").agg(
        F.sum(1 - F.col("_recent")).alias("r"), F.sum("_recent").alias("c")
    )
    return drift_measures(counts)


def drift_report(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """All drift measures per column; the counts are stored, so that both sides are read once."""
    counts = materialise(side_counts(reference, current, columns), "drift-counts")
    return drift_measures(counts, stored=True).join(population_stability(counts), "column")


def ln_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive number, by its asymptotic series at ``z + 10`` and the recurrence."""

    def series(x: Column) -> Column:
        tail = F.lit(0.0)
        for i, b in enumerate(STIRLING):
            tail = tail + F.lit(b) / F.pow(x, F.lit(2 * i + 1))
        return (x - 0.5) * F.ln(x) - x + 0.9189385332046727 + tail

    below = F.lit(0.0)
    for i in range(10):
        below = below + F.ln(z + i)
    return let(z + 10, series) - below


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) of ``a`` > 0 and ``x`` >= 0.

    Below a + 1 by the series of its complement, above by the continued fraction, evaluated from its end. The number of
    terms grows with the root of ``a``, as the width of the distribution does.
    """

    def series(v: Column) -> Column:
        terms = F.sequence(F.lit(1), (60 + 12 * F.sqrt(v["a"])).cast("int"))
        start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

        def add(acc: Column, n: Column) -> Column:
            t = acc["t"] * v["x"] / (v["a"] + n)
            return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

        total = F.aggregate(terms, start, add, lambda acc: acc["s"])
        return 1.0 - F.exp(v["a"] * F.ln(v["x"]) - v["x"] - v["g"]) / v["a"] * total

    def fraction(v: Column) -> Column:
        terms = F.reverse(F.sequence(F.lit(1), (60 + 12 * F.sqrt(v["a"])).cast("int")))
        tail = F.aggregate(
            terms, F.lit(0.0), lambda below, n: n * (n - v["a"]) / (v["x"] - v["a"] + 2 * n + 1 - below), lambda below: v["x"] - v["a"] + 1 - below
        )
        return F.exp(v["a"] * F.ln(v["x"]) - v["x"] - v["g"]) / tail

    given = F.struct(a.cast("double").alias("a"), x.cast("double").alias("x"), ln_gamma(a.cast("double")).alias("g"))

    def chosen(v: Column) -> Column:
        q = F.when(v["x"] <= 0, 1.0).when(v["x"] < v["a"] + 1, series(v)).otherwise(fraction(v))
        return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))

    return let(given, chosen)


def category_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, r, c)`` of categorical columns, values as text, null as a category: one shuffle of combined counts."""

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        return df.select(F.lit(is_ref).alias("_ref"), *[F.col(c).cast("string").alias(c) for c in columns])

    long = side(reference, 1).unionByName(side(current, 0)).unpivot(["_ref"], columns, "column", "value")
    return long.groupBy("column", "value").agg(
        F.sum("_ref").cast("bigint").alias("r"), F.sum(1 - F.col("_ref")).cast("bigint").alias("c")
    )


def category_drift(counts: DataFrame) -> DataFrame:
    """Per column: sizes of both sides, number of categories and of those new in the current side, chi-square statistic of
    homogeneity with its p-value, and Jensen-Shannon distance (base 2, 0 to 1).

    ``counts`` is a written table of ``category_counts``; it is read twice, and each time combined before the shuffle, so a
    column with a huge number of categories is spread over all tasks. A side without rows has no p-value and no distance.
    """
    totals = counts.groupBy("column").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    rows = counts.join(F.broadcast(totals), "column")  # one row per column
    n = F.col("n_ref") + F.col("n_cur")

    def part(seen: str, size: str) -> Column:
        expected = (F.col("r") + F.col("c")) * F.col(size) / n
        return F.coalesce(F.try_divide(F.pow(F.col(seen) - expected, F.lit(2)), expected), F.lit(0.0))

    p, q = F.try_divide("r", "n_ref"), F.try_divide("c", "n_cur")

    def divergence(share: Column, other: Column) -> Column:
        return F.when(share > 0, share * F.log2(2 * share / (share + other))).otherwise(0.0)

    measured = rows.groupBy("column", "n_ref", "n_cur").agg(
        F.count(F.lit(1)).alias("categories"),
        F.sum((F.col("r") == 0).cast("bigint")).alias("new_categories"),
        F.sum(part("r", "n_ref") + part("c", "n_cur")).alias("chi2"),
        F.sqrt(F.greatest(F.sum(divergence(p, q) + divergence(q, p)) / 2, F.lit(0.0))).alias("js_distance"),
    )
    freedom = F.col("categories") - 1
    p_value = F.when(freedom > 0, upper_gamma(freedom / 2, F.col("chi2") / 2)).otherwise(1.0)
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return measured.withColumns({"p_value": F.when(both, p_value), "js_distance": F.when(both, F.col("js_distance"))})


def drift_by_role(reference: DataFrame, current: DataFrame, roles: ColumnRoles, drift_share: float = 0.5, alpha: float = 0.05) -> DataFrame:
    """``(column, role, test, statistic, p_value, drifted, dataset_drift)`` of every column that a report looks at.

    The role decides on the test: KS for numeric columns, chi-square for categorical ones. The data set drifts if at least
    ``drift_share`` of all columns do. Both sides are read once per role; columns that only one side has are left out.
    """
    present = [c for c in roles.report_columns(reference.columns) if c in current.columns]
    numeric, categorical = ([c for c in kind if c in present] for kind in (roles.numeric, roles.categorical))
    parts = []
    if numeric:
        counts = materialise(side_counts(reference, current, numeric), "drift-counts")
        found = drift_measures(counts, stored=True)
        parts.append(found.select("column", F.lit("numeric").alias("role"), F.lit("ks").alias("test"), F.col("ks").alias("statistic"), "p_value"))
    if categorical:
        found = category_drift(materialise(category_counts(reference, current, categorical), "category-counts"))
        parts.append(found.select("column", F.lit("categorical").alias("role"), F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), "p_value"))
    if not parts:
        raise ValueError("no column of either role on both sides")
    tested = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    tested = tested.withColumn("drifted", F.coalesce((F.col("p_value") < alpha).cast("int"), F.lit(0)))
    # one row per tested column
    share = F.avg("drifted").over(Window.partitionBy(F.lit(0)))
    return tested.withColumn("dataset_drift", (share >= drift_share).cast("int"))
