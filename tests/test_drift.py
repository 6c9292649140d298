"""Drift of categorical columns: the gamma function, odd inputs, and the choice of the test by role."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.operators import drift
from larder.schemas import ColumnRoles


def poisson_tail(k: int, x: float) -> float:
    """Q(k, x) for a whole k: the chance of fewer than k events at rate x."""
    return math.fsum(math.exp(i * math.log(x) - x - math.lgamma(i + 1)) for i in range(k))


def half_tail(k: int, x: float) -> float:
    """Q(k + 1/2, x) by the recurrence from the error function."""
    total = math.erfc(math.sqrt(x))
    for i in range(k):
        total += math.exp((i + 0.5) * math.log(x) - x - math.lgamma(i + 1.5))
    return total


def test_upper_gamma(spark):
    rows = [(float(a), a * r + d) for a in (1, 2, 7, 40, 500, 3000) for r in (0.2, 0.9, 1.0, 1.1, 2.5) for d in (0.0, 3.0)]
    rows += [(k + 0.5, x) for k in (0, 1, 5, 60) for x in (0.01, 0.4, 1.3, 9.0, 70.0)]
    df = spark.createDataFrame([*rows, (1.5, 0.0)], "a double, x double")
    for r in df.select("a", "x", drift.upper_gamma(F.col("a"), F.col("x")).alias("q"), drift.ln_gamma(F.col("a")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.a), rel=1e-11, abs=1e-11)
        if r.x == 0:
            assert r.q == 1
            continue
        want = poisson_tail(int(r.a), r.x) if r.a == int(r.a) else half_tail(int(r.a), r.x)
        assert r.q == pytest.approx(want, abs=1e-9), (r.a, r.x)


def test_category_drift(spark):
    """Against plain counts, with nulls, a category on one side only and a column of one category."""
    ref = [("a", None, "k")] * 40 + [("b", "x", "k")] * 35 + [("c", "x", "k")] * 25
    cur = [("a", None, "k")] * 20 + [("b", "y", "k")] * 60 + [(None, "x", "k")] * 5
    schema = "one string, two string, three string"
    left, right = spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema)
    got = {r.column: r for r in drift.category_drift(drift.category_counts(left, right, ["one", "two", "three"])).collect()}
    for i, name in enumerate(("one", "two", "three")):
        r, c = Counter(x[i] for x in ref), Counter(x[i] for x in cur)
        chi = js = 0.0
        for v in {*r, *c}:
            for seen, size in ((r[v], 100), (c[v], 85)):
                expected = (r[v] + c[v]) * size / 185
                chi += (seen - expected) ** 2 / expected
            p, q = r[v] / 100, c[v] / 85
            js += sum(a * math.log2(2 * a / (p + q)) for a in (p, q) if a) / 2
        row = got[name]
        assert (row.n_ref, row.n_cur, row.categories, row.new_categories) == (100, 85, len({*r, *c}), len(set(c) - set(r)))
        assert row.chi2 == pytest.approx(chi) and row.js_distance == pytest.approx(math.sqrt(js))
    assert got["three"].p_value == 1 and got["three"].js_distance == 0 and got["one"].p_value < 1e-6


def test_empty_side(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    row = drift.category_drift(drift.category_counts(df, df.limit(0), ["k"])).first()
    assert (row.n_ref, row.n_cur, row.p_value) == (2, 0, None)
    assert drift.category_drift(drift.category_counts(df.limit(0), df.limit(0), ["k"])).collect() == []


def test_test_follows_from_the_role(spark):
    """The same numbers as a numeric and as a categorical column; ids and absent columns stay out."""
    left = spark.createDataFrame([(i, i % 7) for i in range(300)], "fid bigint, n bigint")
    right = spark.createDataFrame([(i, i % 5) for i in range(300)], "fid bigint, n bigint")
    numeric = drift.drift_by_role(left, right, ColumnRoles(numeric=["n", "gone"])).collect()
    assert [(r.column, r.role, r.test) for r in numeric] == [("n", "numeric", "ks")]
    text = drift.drift_by_role(left, right, ColumnRoles(numeric=[], categorical=["n"])).collect()
    assert [(r.column, r.role, r.test, r.drifted, r.dataset_drift) for r in text] == [("n", "categorical", "chi2", 1, 1)]
    with pytest.raises(ValueError, match="column"):
        drift.drift_by_role(left, right, ColumnRoles(numeric=["gone"]))
