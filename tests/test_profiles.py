"""Profiles of text and timestamp columns, and frequent values by sketches with an exact second pass."""

import random
from collections import Counter

import pytest

from larder.operators import profiles


def test_text_profile(spark):
    rows = [("a", None), ("", None), ("  ", None), ("a", None), ("long one", None), (None, None)]
    got = {r.column: r for r in profiles.text_profile(spark.createDataFrame(rows, "x string, y string"), ["x", "y"]).collect()}
    x, y = got["x"], got["y"]
    assert (x.rows, x.nulls, x.empty, x.blank) == pytest.approx((6, 1 / 6, 0.2, 0.4))
    assert (x.shortest, x.longest, x.mean_length, x.distinct_values) == (0, 8, pytest.approx(2.4), 4)
    assert (y.rows, y.nulls, y.empty, y.longest, y.distinct_values) == (6, 1, None, None, 0)
    assert profiles.text_profile(spark.createDataFrame([], "x string"), ["x"]).collect() == []


def test_time_profile(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 10:00:00'), (TIMESTAMP_NTZ '2024-01-01 12:00:00'), (TIMESTAMP_NTZ '2024-02-01 00:00:00'), (NULL) AS t(ts)")
    row = profiles.time_profile(df, ["ts"]).first()
    assert (row.rows, row.nulls, str(row["first"]), str(row["last"]), row.days, row.most_in_a_day) == (4, 0.25, "2024-01-01 10:00:00", "2024-02-01 00:00:00", 2, 2)
    assert profiles.time_profile(df.limit(0), ["ts"]).collect() == []


def test_heavy_values(spark):
    """Every value at the share or above, exact, beside very many rare ones; whole or from merged sketches."""
    rng = random.Random(6)
    values = [f"v{min(int(rng.paretovariate(0.7)), 10**6)}" if rng.random() < 0.8 else None for _ in range(30_000)]
    values += [f"rare {i}" for i in range(20_000)]
    rows = [(v, i % 3) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v string, part int").repartition(7)
    for share in (0.01, 0.002):
        counts = Counter(v for v in values if v is not None)
        want = {("v", v, n) for v, n in counts.items() if n >= share * len(rows)}
        want |= {("part", str(p), n) for p, n in Counter(p for _, p in rows).items()}
        assert {tuple(r) for r in profiles.heavy_values(df, ["v", "part"], share).collect()} == want
        parts = None
        for p in range(3):
            one = profiles.value_sketches(df.where(f"part = {p}"), ["v", "part"], share)
            parts = one if parts is None else parts.unionByName(one)
        merged = profiles.merged_sketches(parts, share)
        assert {tuple(r) for r in profiles.heavy_values(df, ["v", "part"], share, merged).collect()} == want
    assert profiles.heavy_values(df.limit(0), ["v"]).collect() == []
