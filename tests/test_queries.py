"""The registry: every query is registered once, and the flagship query equals its SQL."""

import duckdb

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
TABLES = "orders lineitem part events customer labels documents embeddings pages"


def test_registry():
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names and len(names) > 100


def check(spark, name):
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    df = entry.queries()[name](spark, ROOT)
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in sorted(names)]
    want = sorted(map(repr, (tuple(r[i] for i in order) for r in result.fetchall())))
    assert sorted(df.columns) == sorted(names) and got == want


def test_flagship(spark):
    check(spark, "named_aggs")
    assert entry.entry(spark).count() == 7


def test_some_queries(spark):
    for name in ("score_food", "split_label", "convert_units", "ks_drift", "rolling_quality"):
        check(spark, name)
