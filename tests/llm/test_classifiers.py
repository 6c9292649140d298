"""Classifiers: held-out accuracy, and what labels they may read."""

import zlib

import numpy as np
import pytest

from larder.llm import quality, samples, toxicity

ROOT = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def evaluate(result, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    rows = result.collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    pairs = np.array([(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth])
    order = np.argsort(pairs[:, 0], kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    ones = pairs[:, 2] == 1
    auc = (ranks[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())
    return len(rows), auc, (pairs[:, 1] == pairs[:, 2]).mean()


def test_quality(tables):
    docs, labels = tables
    n, auc, accuracy = evaluate(quality.classify(docs, labels), labels, "quality")
    assert n == docs.count() and auc > 0.96 and accuracy > 0.95


def test_toxicity(tables):
    docs, labels = tables
    n, auc, accuracy = evaluate(toxicity.classify(docs, labels), labels, "toxic")
    assert n == docs.count() and auc > 0.97 and accuracy > 0.95


def test_held_out_labels_are_never_read(spark):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(400)], "doc_id bigint, quality int, toxic int")
    ids = [r.doc_id for r in samples.label_sample(labels, "quality", 1000, "x").collect()]
    assert ids and not any(map(held, ids)) and len(ids) == sum(not held(i) for i in range(400))


@pytest.mark.parametrize("classify", [quality.classify, toxicity.classify])
def test_edge_cases(spark, docs, empty, classify):
    """Null and empty texts and ids, clashing columns, labels of one class, of no class, without documents, repeated."""
    schema = "doc_id bigint, quality int, toxic int, score double"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(i, 1, 1, 0.1) for i in range(0, 60, 3)], schema)
    mixed = spark.createDataFrame([(i, i % 2, i % 2, 0.1) for i in range(0, 200)] * 2 + [(None, 1, 1, 0.0), (3, None, 7, 0.0)], schema)
    for labels in (none, one, mixed):
        rows = classify(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert classify(empty, mixed).collect() == []


def test_same_result_twice(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(0, 200)], "doc_id bigint, quality int, toxic int")
    for classify in (quality.classify, toxicity.classify):
        a, b = (sorted(map(repr, classify(d, labels).collect())) for d in (docs, docs.repartition(3)))
        assert a == b


def test_keep_good(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 200)], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, labels)
    scores = sorted(r.score for r in quality.score(docs, model).collect())
    cut = scores[len(scores) // 2]
    kept = quality.keep_good(docs, model, cut)
    assert kept.columns == docs.columns and kept.count() == sum(s >= cut for s in scores)


def test_non_negative_risk():
    """Toxic words get positive weight though a part of the unlabelled texts is toxic too."""
    rng = np.random.default_rng(0)
    plain = [" ".join(f"w{i}" for i in rng.integers(0, 300, 40)) for _ in range(600)]
    toxic = [t + " vilest" for t in plain[:150]]
    model = toxicity.fit(toxic[:80], plain[150:] + toxic[80:], 0.13)
    import pyarrow as pa

    low, high = toxicity.scores(pa.array([plain[0], plain[0] + " Vilest"]), model)
    assert high > 0.5 > 0.3 > low
