"""Operators against brute force on small fixtures, with skewed and degenerate inputs."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import aggregates, categorise, clusters, drift, joins, performance, profiles, ranks, regression, splits


def skewed(seed=3, n=3000):
    """Rows (id, g, v): one group and one value hold a third of the rows each."""
    rnd = random.Random(seed)
    return [
        (i, "hot" if i % 3 == 0 else f"g{rnd.randrange(5)}", 7.0 if rnd.random() < 0.33 else round(rnd.gauss(0, 10), 3))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, g string, v double").repartition(5).cache()


def quantile(values, q):
    values = sorted(values)
    p = q * (len(values) - 1)
    low, high = values[math.floor(p)], values[math.ceil(p)]
    return low + (high - low) * (p - math.floor(p))


def by_group(rows):
    out = {}
    for i, g, v in rows:
        out.setdefault(g, []).append((i, v))
    return out


def test_exact_quantiles(table, rows):
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in ranks.exact_quantiles(table, ["g"], "v", qs).collect()}
    for g, pairs in by_group(rows).items():
        for q in qs:
            assert got[(g, q)] == pytest.approx(quantile([v for _, v in pairs], q))


@pytest.mark.parametrize("buckets", [1, 4, 256])
def test_prefix_sums(table, rows, buckets):
    counts = table.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    for r in ranks.prefix_sums(counts, ["g"], "v", ["n"], buckets).collect():
        values = [v for _, v in by_group(rows)[r["g"]]]
        assert r["before_n"] == sum(v < r["v"] for v in values) and r["all_n"] == len(values)
        later = [v for v in values if v > r["v"]]
        assert r["next_value"] == (min(later) if later else None)


def test_number_rows(table, rows):
    got = ranks.number_rows(table, [F.col("v"), F.col("id")]).orderBy("rn").collect()
    assert [r["rn"] for r in got] == list(range(1, len(rows) + 1))
    assert [(r["v"], r["id"]) for r in got] == sorted((v, i) for i, _, v in rows)


def test_kth_value(spark):
    rnd = random.Random(5)
    values = [rnd.randrange(-10**12, 10**12) for _ in range(400)] + [5] * 200
    df = spark.createDataFrame([(v,) for v in values], "k bigint")
    for k in (1, 2, 199, 200, 350, 600):
        assert ranks.kth_value(df, "k", k) == sorted(values)[k - 1]
    assert ranks.kth_value(df, "k", 601) is None and ranks.kth_value(df.limit(0), "k", 1) is None


def test_top_n_per_group(table, rows):
    got = {}
    for r in ranks.top_n_per_group(table, ["g"], [F.desc("v"), F.col("id")], 50, F.col("id"), salts=4).collect():
        got.setdefault(r["g"], []).append((r["rn"], r["id"]))
    for g, pairs in by_group(rows).items():
        want = [i for i, _ in sorted(pairs, key=lambda p: (-p[1], p[0]))[:50]]
        assert [i for _, i in sorted(got[g])] == want


def test_lookup_join_with_hot_key(spark):
    facts = [(i, "hot" if i < 4000 else f"k{i % 50}") for i in range(6000)] + [(6000, None)]
    lookup = [("hot", 1.0)] + [(f"k{j}", float(j)) for j in range(40)]
    got = ranks.lookup_join(spark.createDataFrame(facts, "id bigint, k string"), spark.createDataFrame(lookup, "k string, x double"), "k")
    want = dict(lookup)
    assert {r["id"]: r["x"] for r in got.collect()} == {i: want.get(k) for i, k in facts}


def loop_cap(scores):
    limit, kept, out = 0.15 * len(scores), 0, []
    for i, s in enumerate(scores):
        if s == 0 and kept > limit:
            continue
        kept += 1
        out.append(i)
    return out


@pytest.mark.parametrize("shape", ["mixed", "zeros", "none", "tail", "one", "empty"])
def test_zero_cap_equals_the_loop(spark, shape):
    rnd = random.Random(shape)
    scores = {
        "mixed": [rnd.choice([0.0, 0.0, 1.5]) for _ in range(137)], "zeros": [0.0] * 40, "none": [1.0] * 9,
        "tail": [1.0] * 20 + [0.0] * 20, "one": [0.0], "empty": [],
    }[shape]
    df = spark.createDataFrame(list(enumerate(scores)), "k bigint, score double")
    assert sorted(r["k"] for r in splits.cap_zero_scores(df, "k").collect()) == loop_cap(scores)


def test_batches(spark):
    df = spark.range(1, 104).withColumnRenamed("id", "k").repartition(6)
    even = {r["k"]: r["batch"] for r in splits.even_batches(df, "k", 10).collect()}
    want = {int(k): i + 1 for i, part in enumerate(np.array_split(np.arange(1, 104), 10)) for k in part}
    assert even == want
    fixed = {r["k"]: r["batch"] for r in splits.fixed_batches(df, "k", 100).collect()}
    assert fixed == {k: (k - 1) // 100 for k in range(1, 104)}
    few = {r["k"]: r["batch"] for r in splits.even_batches(spark.range(1, 4).withColumnRenamed("id", "k"), "k", 10).collect()}
    assert few == {1: 1, 2: 2, 3: 3}


def test_last_rows(spark):
    rnd = random.Random(1)
    rows = [(f"2024-01-{1 + rnd.randrange(9):02d} 10:00:00", "m1" if i % 3 else "m2", i) for i in range(900)]
    log = spark.createDataFrame(rows, "t string, model string, fid bigint").withColumn("ts", F.to_timestamp_ntz("t"))
    got = {(r["model"], r["fid"]): r["rn"] for r in splits.last_rows(log, 100).collect()}
    for m in ("m1", "m2"):
        mine = sorted([r for r in rows if r[1] == m], key=lambda r: r[2])
        mine.sort(key=lambda r: r[0], reverse=True)
        assert [k[1] for k, _ in sorted(((k, v) for k, v in got.items() if k[0] == m), key=lambda p: p[1])] == [r[2] for r in mine[:100]]


def test_named_aggregations(spark):
    docs = spark.createDataFrame([(1, 0.5), (2, 0.0), (3, 0.0), (4, 0.5), (5, -1.0)], "fid bigint, score double")
    got = {(r["name"], r["rank"]): (r["value"], r["n"], r["doc"]) for r in aggregates.named_aggregations(docs).collect()}
    assert got == {
        ("min_score", 1): (-1.0, None, None), ("max_score", 1): (0.5, None, None), ("zero_score_docs", 1): (0.0, 2, None),
        ("highest_score_docs", 1): (0.5, None, 1), ("highest_score_docs", 2): (0.5, None, 4),
        ("lowest_score_docs", 1): (-1.0, None, 5), ("lowest_score_docs", 2): (0.0, None, 2),
    }


def test_histogram(spark, table, rows):
    bins = aggregates.histogram(table, "v").collect()
    values = [v for _, _, v in rows]
    want, _ = np.histogram(values, bins=30)
    assert sum(r["n"] for r in bins) == len(values)
    assert sum(abs(int(want[r["bin"]]) - r["n"]) for r in bins) <= 2  # edges are not computed the same way
    flat = aggregates.histogram(spark.createDataFrame([(1.0,)] * 5, "v double"), "v").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 5)]


def test_describe(table, rows):
    got = aggregates.describe(table, [], "v").first()
    values = [v for _, _, v in rows]
    assert got["n"] == len(values) and got["p50"] == pytest.approx(quantile(values, 0.5))
    assert got["std"] == pytest.approx(statistics.stdev(values)) and got["mean"] == pytest.approx(statistics.fmean(values))


def ks_brute(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def test_drift(spark):
    rnd = random.Random(9)
    a = [(rnd.gauss(0, 1), 1.0, rnd.random()) for _ in range(300)]
    b = [(rnd.gauss(1, 1), 1.0, 2 + rnd.random()) for _ in range(200)]
    schema = "x double, same double, apart double"
    ref, cur = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    got = {r["column"]: r for r in drift.drift_test(ref, cur, ["x", "same", "apart"]).collect()}
    assert got["x"]["ks"] == pytest.approx(ks_brute([r[0] for r in a], [r[0] for r in b]))
    assert got["same"]["ks"] == 0 and got["same"]["p_value"] == 1.0 and got["apart"]["ks"] == 1.0
    assert [got[c]["drifted"] for c in ("x", "same", "apart")] == [1, 0, 1] and got["x"]["dataset_drift"] == 1
    back = {r["column"]: r["ks"] for r in drift.drift_test(cur, ref, ["x"]).collect()}
    assert back["x"] == pytest.approx(got["x"]["ks"])
    report = {r["column"]: r for r in drift.drift_report(ref, cur, ["x", "same", "apart"]).collect()}
    assert report["same"]["psi"] == pytest.approx(0) and report["apart"]["psi"] > 1
    assert report["apart"]["wasserstein"] == pytest.approx(
        statistics.fmean(r[2] for r in b) - statistics.fmean(r[2] for r in a)
    )


def test_stability(spark):
    ref = spark.createDataFrame([(float(i), "a") for i in range(100)], "x double, c string")
    cur = spark.createDataFrame([(float(i + 50) if i % 2 else None, "z" if i < 30 else "a") for i in range(100)], "x double, c string")
    got = {(r["test"], r["column"]): (r["current"], r["status"]) for r in profiles.stability_tests(ref, cur, ["x"], ["c"]).collect()}
    assert got[("row_count", "")] == (100.0, "pass") and got[("null_share", "x")] == (0.5, "fail")
    assert got[("out_of_range", "x")][1] == "fail" and got[("mean_in_2_sigma", "x")][1] == "pass"
    assert got[("unknown_values", "c")] == (0.3, "fail")


def test_quality_profile(table, rows):
    got = profiles.quality_profile(table, ["v"]).first()
    values = [v for _, _, v in rows]
    assert got["n"] == len(values) and got["distinct_values"] == len(set(values)) and got["most_common"] == 7.0
    assert got["p75"] == pytest.approx(quantile(values, 0.75))
    assert profiles.quick_profile(table, ["v"]).first()["n"] == len(values)


def test_error_groups_and_qq(spark):
    nd = statistics.NormalDist(2, 3)
    rows = [(i, 10.0, 10.0 + nd.inv_cdf((i + 0.5) / 2000)) for i in range(2000)]
    df = performance.with_errors(spark.createDataFrame(rows, "fid bigint, target double, prediction double"), "target", "prediction")
    line = performance.qq_line(performance.qq_points(df, [], "error"), []).first()
    assert line["slope"] == pytest.approx(3, rel=0.02) and line["intercept"] == pytest.approx(2, abs=0.02) and line["corr"] > 0.999
    sizes = {r["error_group"]: r["n"] for r in performance.top_errors(df, []).collect()}
    assert sizes["under"] == pytest.approx(100, abs=2) and sum(sizes.values()) == 2000


def test_quality_with_zero_target(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    got = performance.regression_quality(df, [], "y", "p").first()
    assert got["mape"] == 50.0 and got["rmse"] == 1.0 and got["r2"] == 0.0


def test_updates(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None)], "fid bigint, id string, category string")
    updates = spark.createDataFrame([("a", "new"), ("zz", "lost")], "id string, category string")
    got = {r["fid"]: r["category"] for r in joins.update_by_key(docs, updates, "id", "category", "fid").collect()}
    assert got == {1: "new", 2: "y", 3: None}
    assert [r["id"] for r in joins.keys_not_found(updates, docs, "id").collect()] == ["zz"]
    assert joins.known(docs, None, "id").count() == 0 and joins.unknown(docs, None, "id").count() == 3
    kept = joins.known(docs, updates, "id").count() + joins.unknown(docs, updates, "id").count()
    assert kept == docs.count()


def test_categories(spark):
    vectors = [("red", [1.0, 0.0]), ("sour", [0.8, 0.6]), ("leaf", [0.0, 1.0]), ("nil", [0.0, 0.0])]
    words = spark.createDataFrame(vectors, "token string, vector array<double>")
    lexicon = spark.createDataFrame([("fruit", "Red sour"), ("leafy", "leaf")], "category string, keyword string")
    docs = spark.createDataFrame([(1, "a RED thing"), (2, "leaf"), (3, "unknown words"), (4, None), (5, "nil")], "id bigint, text string")
    got = {r["id"]: r["category"] for r in categorise.categorise(docs, "text", lexicon, words).collect()}
    assert got == {1: "fruit", 2: "leafy", 3: None, 4: None, 5: None}


def test_many_categories_in_chunks(spark, monkeypatch):
    rnd = random.Random(2)
    cents = [(f"c{i}", [rnd.gauss(0, 1) for _ in range(4)]) for i in range(20)]
    docs = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(30)], "id bigint, vector array<double>")
    centroids = spark.createDataFrame(cents, "category string, vector array<double>")
    whole = {r["id"]: (r["category"], r["sim"]) for r in categorise.best_category(docs, "id", centroids).collect()}
    ranks_whole = {(r["id"], r["category"]): r["rank"] for r in categorise.rank_categories(docs, "id", centroids).collect()}
    monkeypatch.setattr(categorise, "CATEGORY_BLOCK", 3)
    assert {r["id"]: (r["category"], r["sim"]) for r in categorise.best_category(docs, "id", centroids).collect()} == whole
    assert {(r["id"], r["category"]): r["rank"] for r in categorise.rank_categories(docs, "id", centroids).collect()} == ranks_whole


def test_ward_on_separated_data(spark):
    rnd = random.Random(4)
    values = [(round(c + rnd.random(), 3),) for c in (0, 10, 20, 40) for _ in range(50)]
    scores = clusters.weighted_scores(spark.createDataFrame(values, "score double"))
    for cuts in (clusters.fit_ward(scores, 4), clusters.fit_kmeans(scores, 4)):
        assert len(cuts) == 3 and all(a < c < b for c, (a, b) in zip(cuts, ((1, 10), (11, 20), (21, 40))))


def brute_ward(points, k):
    groups = [[p] for p in sorted(points)]
    while len(groups) > k:
        def cost(a, b):
            return len(a) * len(b) / (len(a) + len(b)) * (statistics.fmean(a) - statistics.fmean(b)) ** 2

        i, j = min(((i, j) for i in range(len(groups)) for j in range(i)), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        groups[j] += groups[i]
        del groups[i]
    return sorted(sorted(g) for g in groups)


def test_ward_equals_all_pairs(spark):
    rnd = random.Random(8)
    points = [rnd.gauss(0, 5) for _ in range(40)]
    scores = clusters.weighted_scores(spark.createDataFrame([(p,) for p in points], "score double"))
    for run_rows in (8, 11, 1000):
        cuts = clusters.ward_cuts(clusters.ward_merges(scores, run_rows=run_rows), [5])[5]
        got = {}
        for p in points:
            got.setdefault(sum(p > c for c in cuts), []).append(p)
        assert sorted(sorted(g) for g in got.values()) == brute_ward(points, 5)


def one_by_one(values):
    """Heights of the Ward merges of weighted sorted values, always the cheapest neighbours next."""
    means, weights = [v for v, _ in values], [w for _, w in values]
    lows, highs, out = list(means), list(means), {}
    while len(means) > 1:
        m, w = np.array(means), np.array(weights)
        cost = w[:-1] * w[1:] / (w[:-1] + w[1:]) * np.diff(m) ** 2
        i = int(np.argmin(cost))
        out[(highs[i] + lows[i + 1]) / 2] = float(cost[i])
        total = weights[i] + weights[i + 1]
        means[i] = (means[i] * weights[i] + means[i + 1] * weights[i + 1]) / total
        weights[i], highs[i] = total, highs[i + 1]
        for rows in (means, weights, lows, highs):
            del rows[i + 1]
    return out


def test_ward_of_many_distinct_values(spark):
    """Far more distinct scores than one run holds: the whole hierarchy equals the one-by-one merge."""
    rnd = random.Random(13)
    counts = {}
    for _ in range(9000):
        v = round(rnd.choice([rnd.gauss(0, 1), rnd.expovariate(0.2), rnd.uniform(30, 31)]), 4)
        counts[v] = counts.get(v, 0) + 1
    assert len(counts) > 5000
    scores = spark.createDataFrame([(v, float(n)) for v, n in counts.items()], "score double, n double")
    want = one_by_one(sorted((v, float(n)) for v, n in counts.items()))
    got = {r["border"]: r["cost"] for r in clusters.ward_merges(scores, run_rows=900).collect()}
    assert got.keys() == want.keys() and all(got[b] == pytest.approx(want[b], rel=1e-6) for b in want)


def test_ward_few_values(spark):
    for values in ([], [(1.0,)], [(1.0,), (1.0,)], [(1.0,), (2.0,), (None,)]):
        scores = clusters.weighted_scores(spark.createDataFrame(values, "score double"))
        distinct = len({v for v, in values if v is not None})
        assert len(clusters.fit_ward(scores, 10)) == max(0, distinct - 1)
        assert len(clusters.fit_kmeans(scores, 10)) == max(0, distinct - 1)


def test_silhouette_equals_all_pairs(spark):
    rnd = random.Random(21)
    points = sorted(round(rnd.gauss(0, 3), 2) for _ in range(120)) + [50.0]
    cuts = [-2.0, 0.5, 20.0]
    label = [sum(p > c for c in cuts) for p in points]
    widths = []
    for p, c in zip(points, label):
        own = [abs(p - q) for q, d in zip(points, label) if d == c]
        if len(own) == 1:
            widths.append(0.0)
            continue
        a = sum(own) / (len(own) - 1)
        b = min(statistics.fmean(abs(p - q) for q, e in zip(points, label) if e == d) for d in set(label) - {c})
        widths.append((b - a) / max(a, b))
    scores = clusters.weighted_scores(spark.createDataFrame([(p,) for p in points], "score double"))
    rows = scores.withColumn("cluster", clusters.cluster_of(F.col("score"), cuts))
    assert clusters.silhouette(rows, "cluster").first()["silhouette"] == pytest.approx(statistics.fmean(widths))


def test_kmeans_is_a_fixed_point(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(500)], "score double")
    a = clusters.kmeans_centers(clusters.weighted_scores(df), [2, 7])
    assert a == clusters.kmeans_centers(clusters.weighted_scores(df.repartition(3)), [2, 7]) or all(
        x == pytest.approx(y) for k in a for x, y in zip(a[k], clusters.kmeans_centers(clusters.weighted_scores(df), [k])[k]))
    rows = [r["score"] for r in df.collect()]
    for k, centers in a.items():
        cuts = clusters.borders(centers)
        for i, c in enumerate(centers):
            assert statistics.fmean(r for r in rows if sum(r > x for x in cuts) == i) == pytest.approx(c, abs=1e-6)


def test_cluster_measures(spark):
    values = [(0.0,), (1.0,), (10.0,), (11.0,)] * 20
    df = spark.createDataFrame(values, "score double")
    table = clusters.sweep(df, [2, 3])
    got = {(r["k"], r["method"]): r for r in table.collect()}
    assert got[(2, "ward")]["silhouette"] > 0.9 and got[(2, "kmeans")]["calinski"] == pytest.approx(got[(2, "ward")]["calinski"])
    # between 4*20*25 = 2000 over 1, within 80 * 0.25 = 20 over 78
    assert got[(2, "ward")]["calinski"] == pytest.approx(2000 / (20 / 78))
    labelled = clusters.cluster_table(df, 2)
    assert labelled.select("cluster_hierarchical").distinct().count() == 2


def test_linear_regression_equals_least_squares(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(200, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + 3 + rnd.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "fid bigint, a double, b double, c double, score double")
    model = regression.fit_linear(df, ["a", "b", "c"])
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(200)]), y, rcond=None)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(want))
    scored = regression.predict(model, df, features=["a", "b", "c"])
    r2 = aggregates.regression_measures(scored, [], "score", "predictions").first()["r2"]
    assert r2 == pytest.approx(1 - ((y - np.column_stack([x, np.ones(200)]) @ want) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_grid_equals_single_fits(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(300, 2))
    y = np.sin(x[:, 0]) + x[:, 1] ** 2
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, score double")
    train, check = df.limit(200).cache(), df.cache()
    grid = {"n_estimators": [2, 5], "learning_rate": [0.1, 0.3], "max_depth": [2], "subsample": [0.8], "colsample_bytree": [1.0]}
    trials, best = regression.grid_search(train, check, grid, ["a", "b"])
    rows = trials.collect()
    assert len(rows) == 4 and [r["r2"] for r in rows] == sorted((r["r2"] for r in rows), reverse=True)
    assert {k: rows[0][k] for k in best} == best
    for r in rows:
        params = {k: r[k] for k in best}
        scored = regression.predict(regression.fit_boosted(train, params, ["a", "b"]), check, features=["a", "b"])
        assert aggregates.regression_measures(scored, [], "score", "predictions").first()["r2"] == pytest.approx(r["r2"], abs=1e-6)


def test_pairs_in_a_hot_block(spark):
    docs = spark.createDataFrame([(i, "hot" if i % 10 else "cold", float(i % 7), float(i)) for i in range(500)], "fid bigint, b string, score double, x double")
    pairs = joins.neighbour_pairs(docs, "fid", "b", "fid")
    got = {r["left_key"]: r["right_key"] for r in pairs.collect()}
    hot = [i for i in range(500) if i % 10]
    assert all(got[a] == b for a, b in zip(hot, hot[1:])) and len(got) == 498
    won = joins.compare_pairs(pairs, docs, "fid", "score", {"x": False}).where("left_key = 1").first()
    assert won["winner"] == 2 and won["reasons"] == "" or won["winner"] == 1
