"""Clustering of scores: k-means, Ward linkage, the sweep over k and the validation measures.

Scores are counted per distinct value first; the counts are the weights of every fit. On a line every cluster is an
interval, so a clustering is the list of its inner borders, and both methods give such lists.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.aggregates import regression_measures
from larder.operators.ranks import attach_small, exact_quantiles, number_rows, prefix_sums
from larder.session import materialise

#: Neighbouring clusters that one task merges at a time.
WARD_ROWS = 50_000
LLOYD_STEPS = 50


def weighted_scores(df: DataFrame, column: str = "score") -> DataFrame:
    """``(column, n)``: distinct scores with counts."""
    value = F.col(column).cast("double").alias(column)
    return df.where(F.col(column).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).cast("double").alias("n"))


def cluster_of(value: Column, cuts: list[float]) -> Column:
    """Cluster number by position between the cuts, lowest scores first."""
    out = F.lit(0)
    for i, cut in enumerate(sorted(cuts)):
        out = F.when(value > cut, i + 1).otherwise(out)
    return out.cast("int")


# --- k-means ------------------------------------------------------------------------------------------------------


def kmeans_centers(scores: DataFrame, ks: Iterable[int], column: str = "score", steps: int = LLOYD_STEPS) -> dict[int, list[float]]:
    """Centers of weighted k-means for every k, in ascending order; the same on every cluster and partitioning.

    Lloyd's steps from the exact weighted quantiles (i + 0.5) / k. One pass over the counted scores moves the centers of
    all k at once; at most sum(ks) sums reach the driver. Fewer distinct start values than k give fewer centers.
    """
    wanted = sorted(set(ks))
    at = sorted({(i + 0.5) / k for k in wanted for i in range(k)})
    found = {r["q"]: r["value"] for r in exact_quantiles(scores, [], column, at, weight="n").collect()}
    centers = {k: sorted({found[(i + 0.5) / k] for i in range(k)}) if found else [] for k in wanted}
    moving = [k for k in wanted if centers[k]]
    for _ in range(steps):
        if not moving:
            break
        parts = F.array(*[F.struct(F.lit(k).alias("k"), cluster_of(F.col(column), borders(centers[k])).alias("c")) for k in moving])
        rows = scores.select(column, "n", F.explode(parts).alias("p"))
        sums = rows.groupBy("p.k", "p.c").agg(F.sum(F.col(column) * F.col("n")).alias("s"), F.sum("n").alias("n")).collect()
        new = {k: sorted(r["s"] / r["n"] for r in sums if r["k"] == k) for k in moving}
        moving = [k for k in moving if any(abs(a - b) > 1e-12 for a, b in zip(new[k], centers[k])) or len(new[k]) != len(centers[k])]
        centers |= new
    return centers


def borders(centers: list[float]) -> list[float]:
    """Midpoints between neighbouring centers."""
    return [(a + b) / 2 for a, b in zip(centers, centers[1:])]


def fit_kmeans(scores: DataFrame, k: int = 10, column: str = "score") -> list[float]:
    """Inner borders of the k-means clusters."""
    return borders(kmeans_centers(scores, [k], column)[k])


# --- Ward linkage -------------------------------------------------------------------------------------------------


def merge_run(low: list, high: list, mean: list, weight: list, left_end: bool, right_end: bool):
    """Merge all pairs of neighbours that are each other's cheapest; returns (alive indices, [(border, cost)...]).

    The four lists are changed in place. Unless it is an end of the whole line, the first or last cluster has unknown
    neighbours outside and is left alone.
    """
    n = len(low)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    merges: list[tuple[float, float]] = []

    def cost(i: int) -> float:
        """Cost of merging cluster i with the one after it; infinite beyond the run."""
        if i < 0 or after[i] >= n:
            return float("inf")
        j = after[i]
        return weight[i] * weight[j] / (weight[i] + weight[j]) * (mean[j] - mean[i]) ** 2

    def free(i: int) -> bool:
        return (before[i] >= 0 or left_end) and (after[after[i]] < n or right_end)

    heap = [(cost(i), i, i + 1) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        c, i, j = heapq.heappop(heap)
        if not alive[i] or after[i] != j or j >= n or c != cost(i) or not free(i):
            continue
        if c > cost(before[i]) or c > cost(j):
            continue  # a neighbour is cheaper; the pair comes up again when that neighbour changes
        merges.append(((high[i] + low[j]) / 2, c))
        total = weight[i] + weight[j]
        mean[i] = (mean[i] * weight[i] + mean[j] * weight[j]) / total
        weight[i], high[i], alive[j] = total, high[j], False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in {before[i], i, after[i], before[before[i]] if before[i] >= 0 else -1}:
            if k >= 0 and k < n and after[k] < n:
                heapq.heappush(heap, (cost(k), k, after[k]))
    return [i for i in range(n) if alive[i]], merges


def run_merger(n: int):
    """Function that merges one run of ``n`` numbered clusters, for use per group."""
    columns = ["low", "high", "mean", "weight"]

    def merge(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("rn")
        lists = [run[c].tolist() for c in columns]
        left, merges = merge_run(*lists, run["rn"].iloc[0] == 1, run["rn"].iloc[-1] == n)
        kept = pd.DataFrame({c: [v[i] for i in left] for c, v in zip(columns, lists)}, dtype=float)
        made = pd.DataFrame(merges, columns=["border", "cost"], dtype=float)
        return pd.concat([f for f in (kept, made) if len(f)]).reindex(columns=[*columns, "border", "cost"])

    return merge


def ward_merges(scores: DataFrame, column: str = "score", run_rows: int = WARD_ROWS) -> DataFrame:
    """``(border, cost)`` of every merge of the Ward hierarchy over any number of distinct scores.

    On a line only neighbours merge, so each gap between two scores has exactly one merge. Neighbours that are each
    other's cheapest may merge at any time without changing the hierarchy (Ward's costs are reducible), so runs of
    neighbouring clusters are merged by many tasks at once. The clusters left over are written, numbered and cut into
    runs anew, at shifted places, until one is left.
    """
    run_rows = max(run_rows, 8)  # from 8 rows on, every pair of neighbours is inside a run in one of two rounds
    state = scores.select(
        F.col(column).cast("double").alias("low"), F.col(column).cast("double").alias("high"),
        F.col(column).cast("double").alias("mean"), F.col("n").cast("double").alias("weight"),
    )
    state = materialise(state, "ward-clusters")
    schema = "low double, high double, mean double, weight double, border double, cost double"
    done: list[DataFrame] = []
    n, turn = state.count(), 0
    while n > 1:
        numbered = number_rows(state, [F.col("low")])
        run_no = F.expr(f"(rn - 1 + {(run_rows // 2) * (turn % 2)}) div {run_rows}")
        step = materialise(numbered.withColumn("run", run_no).groupBy("run").applyInPandas(run_merger(n), schema), "ward-round")
        done.append(step.where("border IS NOT NULL").select("border", "cost"))
        state = step.where("border IS NULL").select("low", "high", "mean", "weight")
        n, turn = state.count(), turn + 1
    spark = scores.sparkSession
    out = spark.createDataFrame([], "border double, cost double")
    for part in done:
        out = out.unionByName(part)
    return out


def ward_cuts(merges: DataFrame, ks: Iterable[int]) -> dict[int, list[float]]:
    """Inner borders of the Ward clustering for every k: the k - 1 dearest merges undone, the lower border first in a tie."""
    wanted = sorted(set(ks))
    dearest = merges.orderBy(F.desc("cost"), "border").limit(max(max(wanted) - 1, 0)).collect() if wanted else []
    dearest.sort(key=lambda r: (-r["cost"], r["border"]))
    return {k: sorted(r["border"] for r in dearest[: k - 1]) for k in wanted}


def fit_ward(scores: DataFrame, k: int = 10, column: str = "score") -> list[float]:
    return ward_cuts(ward_merges(scores, column), [k])[k]


def cluster_rows(df: DataFrame, kmeans: list[float], ward: list[float], column: str = "score") -> DataFrame:
    """All rows with ``cluster_hierarchical`` and ``cluster_cmeans``."""
    rows = df.where(F.col(column).isNotNull())
    return rows.withColumns({"cluster_hierarchical": cluster_of(F.col(column), ward), "cluster_cmeans": cluster_of(F.col(column), kmeans)})


def cluster_table(df: DataFrame, k: int = 10, column: str = "score") -> DataFrame:
    """Fit both methods on a table and label it."""
    scores = materialise(weighted_scores(df, column), "scores")
    return cluster_rows(df, fit_kmeans(scores, k, column), fit_ward(scores, k, column), column)


# --- measures -----------------------------------------------------------------------------------------------------


def calinski_harabasz(
    df: DataFrame, cluster: str, value: str, weight: str | None = None, groups: list[str] | None = None
) -> DataFrame:
    """One row ``(k, n, calinski)`` per group from one sum per cluster; with groups the number of clusters is ``clusters``."""
    groups = groups or []
    w = F.col(weight) if weight else F.lit(1.0)
    v = F.col(value).cast("double")
    per = df.groupBy(*groups, cluster).agg(
        F.sum(w).alias("w"), F.sum(w * v).alias("s"), F.sum(w * v * v).alias("q")
    )
    total = F.sum("s") * F.sum("s") / F.sum("w")
    between = F.sum(F.col("s") * F.col("s") / F.col("w")) - total
    within = F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("w"))
    k, n = F.count(F.lit(1)), F.sum("w")
    return per.groupBy(*groups).agg(
        k.alias("clusters" if groups else "k"), n.cast("bigint").alias("n"),
        F.when((within > 0) & (k > 1), (between / (k - 1)) / (within / (n - k))).alias("calinski"),
    )


def silhouette(scores: DataFrame, cluster: str, column: str = "score", groups: list[str] | None = None) -> DataFrame:
    """``(groups, silhouette)``: mean Euclidean silhouette of counted scores whose clusters are intervals, in linear time.

    Running sums inside a cluster give the distances to its members. The nearest other cluster is the one before or
    after, and its mean distance is the distance to its mean. A cluster of one row counts as 0; one cluster gives null.
    """
    groups = groups or []
    rows = scores.withColumn("s", F.col("n") * F.col(column))
    per = rows.groupBy(*groups, cluster).agg((F.sum("s") / F.sum("n")).alias("mean"))
    order = Window.partitionBy(*groups).orderBy("mean")  # as many rows as clusters
    per = per.select(*groups, cluster, F.lag("mean").over(order).alias("mean_below"), F.lead("mean").over(order).alias("mean_above"))
    ranked = prefix_sums(rows, [*groups, cluster], column, ["n", "s"])
    ranked = attach_small(ranked, per, [*groups, cluster])
    v = F.col(column)
    below = v * F.col("before_n") - F.col("before_s")
    above = (F.col("all_s") - F.col("before_s") - F.col("s")) - v * (F.col("all_n") - F.col("before_n") - F.col("n"))
    own = (below + above) / (F.col("all_n") - 1)
    other = F.least(v - F.col("mean_below"), F.col("mean_above") - v)
    width = F.when(F.col("all_n") == 1, 0.0).when(other.isNotNull(), F.when(F.greatest(own, other) > 0, (other - own) / F.greatest(own, other)).otherwise(0.0))
    return ranked.withColumn("width", width).groupBy(*groups).agg((F.sum(F.col("width") * F.col("n")) / F.sum("n")).alias("silhouette"))


def sweep(df: DataFrame, ks: Iterable[int] = range(2, 20), column: str = "score") -> DataFrame:
    """``(k, method, silhouette, calinski)`` for both methods and every k.

    The counted scores are written once; one Ward hierarchy and one run of k-means steps serve all k. All measures
    come from the scores labelled by every (k, method), a fixed number of copies.
    """
    ks = list(ks)
    scores = materialise(weighted_scores(df, column), "scores")
    centers, ward = kmeans_centers(scores, ks, column), ward_cuts(ward_merges(scores, column), ks)
    listed = [(k, m, cuts) for k in ks for m, cuts in (("kmeans", borders(centers[k])), ("ward", ward[k]))]
    labels = F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(m).alias("method"), cluster_of(F.col(column), cuts).alias("cluster")) for k, m, cuts in listed
    ])
    rows = scores.select(column, "n", F.explode(labels).alias("x")).select(column, "n", "x.*")
    rows = materialise(rows, "labelled-scores")
    groups = ["k", "method"]
    return silhouette(rows, "cluster", column, groups).join(calinski_harabasz(rows, "cluster", column, "n", groups).select(*groups, "calinski"), groups)


def validate_clusters(
    training: DataFrame, validation: DataFrame, k: int = 10, column: str = "score", refit: bool = False
) -> DataFrame:
    """Validation rows with both cluster numbers and ``residual`` = hierarchical cluster minus score.

    Clusters are those fitted on the training rows; ``refit`` fits them anew on the validation rows.
    """
    scores = materialise(weighted_scores(validation if refit else training, column), "scores")
    rows = cluster_rows(validation, fit_kmeans(scores, k, column), fit_ward(scores, k, column), column)
    return rows.withColumn("residual", F.col("cluster_hierarchical") - F.col(column))


def validation_measures(validated: DataFrame, column: str = "score") -> DataFrame:
    """MSE, RMSE and R2 with the cluster number as the target and the score as the prediction."""
    return regression_measures(validated, [], "cluster_hierarchical", column)
