"""Collections in hash partitions: updates touch only their partitions, membership reads only the keys it must."""

import glob
import os
import re

from pyspark.sql import functions as F

from larder.sources import keyed

SCHEMA = "id bigint, name string, category string"


def files(path, part="data"):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/{part}/**/*.parquet", recursive=True)}


def collection(spark, path, n=400, **sizes):
    rows = [(i, f"n{i // 2}", None) for i in range(n)] + [(n, None, "none")]
    keyed.create(spark.createDataFrame(rows, SCHEMA), path, "name", **sizes)
    return rows


def test_update_rewrites_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = collection(spark, path, partitions=32)
    before = files(path)
    patch = spark.createDataFrame([("n3", "a"), ("n3", "b"), ("n7", "c"), ("gone", "x"), (None, "y")], "name string, category string")
    n = keyed.update(spark, path, patch, "category", "id", "first")
    assert 1 <= n <= 3
    after = files(path)
    assert len(before - after) <= n and len(before & after) >= len(before) - n
    want = {(i, name, {6: "b", 14: "c"}.get(i, category)) for i, name, category in rows}
    assert {tuple(r) for r in keyed.scan(spark, path).select("id", "name", "category").collect()} == want
    # again: the staged rows are written once more, with the same result
    keyed.update(spark, path, patch.limit(0), "category", "id", "first")
    assert {tuple(r) for r in keyed.scan(spark, path).select("id", "name", "category").collect()} == want


def test_update_after_a_crash(spark, tmp_path, monkeypatch):
    """A batch that ends after its rows are staged, or before, can be run again."""
    path = str(tmp_path / "c")
    collection(spark, path, n=40, partitions=4)
    patch = spark.createDataFrame([("n3", "a")], "name string, category string")
    with monkeypatch.context() as m:
        m.setattr(keyed, "any_rows", lambda *_: 1 / 0)
        try:
            keyed.update(spark, path, patch, "category", "id", "b1")
        except ZeroDivisionError:
            pass
    assert keyed.scan(spark, path).where("category = 'a'").count() == 0
    os.remove(glob.glob(f"{path}/batches/b1/_SUCCESS")[0])
    assert keyed.update(spark, path, patch, "category", "id", "b1") == 1
    assert [r.id for r in keyed.scan(spark, path).where("category = 'a'").collect()] == [6]
    assert keyed.update(spark, path, patch.limit(0), "category", "id", "b2") == 0 and keyed.scan(spark, path).count() == 41


def test_append_unknown(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = collection(spark, path, n=200, partitions=8, blocks=64)
    batch = [(1000 + i, f"n{i}", "new") for i in range(90, 130)] + [(2000 + i, f"n{i}", "later") for i in range(90, 130)] + [(9, None, None)]
    new = spark.createDataFrame(batch, SCHEMA)
    assert keyed.append_unknown(new, path, "id") == 30
    got = {tuple(r) for r in keyed.scan(spark, path).select("id", "name", "category").collect()}
    assert got == {*rows, *((1000 + i, f"n{i}", "new") for i in range(100, 130))}
    assert keyed.append_unknown(new, path, "id") == 0
    assert keyed.append_unknown(new.limit(0), path, "id") == 0
    keyed.merge_filters(spark, path)
    filters = spark.read.parquet(f"{path}/filters")
    assert filters.count() == filters.select("part_", "block").distinct().count()
    assert keyed.append_unknown(new, path, "id") == 0 and keyed.scan(spark, path).count() == 231


def test_filters_hold_all_keys_and_few_others(spark, tmp_path):
    path = str(tmp_path / "c")
    collection(spark, path, n=8000, partitions=4, blocks=64)
    names = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("name"))
    hits = {r.name for r in keyed.possible(names, path).collect()}
    assert {f"n{i}" for i in range(4000)} <= hits and len(hits) < 4000 + 0.03 * 16_000


def test_keys_of_untouched_partitions_are_not_read(spark, tmp_path):
    """One known key: the key scan is pruned to its partition and to the key column."""
    path = str(tmp_path / "c")
    collection(spark, path, partitions=32)
    one = spark.createDataFrame([(1, "n5", "x")], SCHEMA)
    hits = keyed.possible(one.select("name"), path)
    plan = keyed.known_keys(spark, path, hits)._jdf.queryExecution().toString()
    part = keyed._parts(hits)
    assert len(part) == 1 and re.search(rf"PartitionFilters: \[[^\]]*part_#\d+ = {part[0]}\)", plan)
    assert "category" not in plan.split("/data")[1]
    assert keyed.absent(one, path).count() == 0
    assert keyed.possible(spark.createDataFrame([("never seen",)], "name string"), path).count() == 0
