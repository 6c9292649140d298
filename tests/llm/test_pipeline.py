"""The stages in a row against their operators, on a small table."""

import random
from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from larder.llm import decontaminate, jaccard, packing, queries
from larder.session import ARROW_BYTES, small_batches

from .conftest import invented
from .test_pairs import brute_components

ROOT = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], ROOT).cache())
        if name != "packed_tokens":
            assert frames[-1].columns == docs.columns
    _, good, distinct, clean, mixed, packed = frames
    assert docs.count() > good.count() > distinct.count() > clean.count() == mixed.count() > 100
    near = corpus_pipeline.NEAR_SHINGLE, corpus_pipeline.NEAR_PERCENT
    groups = {r.component_id for r in jaccard.near_duplicates(good, *near).collect()}
    assert groups == {c for _, _, c in brute_components([(r.doc_id, r.text) for r in good.collect()], *near)}
    assert {r.doc_id for r in distinct.collect()} == groups
    bad = {r.doc_id for r in decontaminate.contamination(distinct, bench).where("contaminated").collect()}
    assert bad and {r.doc_id for r in clean.collect()} == groups - bad
    assert Counter(r.text for r in mixed.collect()) == Counter(r.text for r in clean.collect())
    whole = packing.restored(packed).collect()
    assert {r.doc_id for r in whole} == groups - bad


def test_run_and_registry(spark):
    rows = corpus_pipeline.run(spark, ROOT)
    assert rows.count() > 0 and corpus_pipeline.ORACLE_SQL is None
    assert len(queries.QUERIES) == 13 and all(any(n.startswith(f"op{i}_") for n in queries.QUERIES) for i in range(1, 14))


def test_repeated_and_null_ids(spark, docs):
    """A repeated row goes; so does a text without an id that copies another; texts are never mixed."""
    out = corpus_pipeline.distinct_documents(spark, docs, "")
    ids = Counter(r.doc_id for r in out.collect())
    assert max(ids.values()) == 1 and None not in ids and out.columns == docs.columns
    rng = random.Random(2)
    a, b = (invented(rng, 60, 50_000) for _ in range(2))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " x"), (None, invented(rng, 30, 50_000))]
    kept = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert len(kept) == 3 and {(1, a), (1, b)} <= {(r.doc_id, r.text) for r in kept}


def test_empty_tables(spark, docs, tmp_path):
    """Empty documents, labels and benchmark go through every stage."""
    tables = {name: spark.read.parquet(f"{ROOT}/{name}.parquet") for name in ("documents", "labels", "benchmark")}
    for name, df in tables.items():
        df.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
        (df.limit(0) if name != "documents" else df.limit(40)).write.parquet(f"{tmp_path}/some/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0


def test_near_copies_of_the_stage(spark):
    """The stage links at five words and 0.8: copies with a fifth more text go, those with a third more stay."""
    rng = random.Random(5)
    texts = [invented(rng, 100, 50_000) for _ in range(12)]
    texts += [t + " " + invented(rng, n, 50_000) for t, n in zip(texts, (2, 8, 14, 18, 20, 22, 23, 24, 25, 28, 33, 50), strict=True)]
    plain = list(enumerate(texts))
    out = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(plain, "doc_id bigint, text string"), "")
    kept = {r.doc_id for r in out.collect()}
    assert kept == {c for _, _, c in brute_components(plain, 5, 80)} != {c for _, _, c in brute_components(plain)}


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def wide_batches(spark):
    """Spark's own bound before a test, and after it."""
    spark.conf.unset(BATCH)
    yield
    spark.conf.unset(BATCH)


@pytest.mark.parametrize("stage", [f for name, f in corpus_pipeline.STAGES if name != "source_mixing"])
def test_workers_get_small_batches(spark, wide_batches, stage):
    """Of 24 MB in one partition a worker holds no more than the bound at once, whichever stage runs first."""
    stage(spark, spark.read.parquet(f"{ROOT}/documents.parquet").limit(60), ROOT)
    wide = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 8000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    found = wide.mapInArrow(sizes, "rows bigint, size bigint").collect()
    assert sum(r.rows for r in found) == 3000 and max(r.size for r in found) <= ARROW_BYTES + 16_000


@pytest.mark.parametrize(("before", "after"), [("64m", f"{ARROW_BYTES}b"), ("1k", "1k"), ("1000", "1000"), ("2MB", "2MB"), ("1gb", f"{ARROW_BYTES}b")])
def test_smaller_bounds_stay(spark, wide_batches, before, after):
    spark.conf.set(BATCH, before)
    small_batches(spark)
    assert spark.conf.get(BATCH) == after


def test_batches_change_no_ids(spark, docs, wide_batches, monkeypatch):
    """Batches of a few rows and slices of a few words give the documents' ids all the same."""
    rows = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    whole = {r.doc_id: r.ids for r in packing.restored(packing.packed(rows)).collect()}
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)
    spark.conf.set(BATCH, "1k")
    again = packing.restored(corpus_pipeline.packed_rows(spark, rows, "")).collect()
    assert {r.doc_id: r.ids for r in again} == whole
