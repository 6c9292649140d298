"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text that resembles good text compresses better with the good dictionary. The difference of the two compressed sizes,
divided by their sum, is calibrated into a probability by a logistic regression, which also reads how far the text
compresses at all (endless repetition compresses well with any dictionary) and its length (short texts are uncertain).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import samples

#: Texts per class for the dictionaries, and the characters taken of each (bounds the training set to some 16 MB).
DICTIONARY_ROWS = 4000
PIECE_CHARS = 2000
DICTIONARY_BYTES = 110 << 10
#: Labelled texts for the calibration; their whole texts are compressed in tasks, three numbers each come back.
CALIBRATION_ROWS = 6000
LEVEL = 3
THRESHOLD = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the plain texts if they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


def compressor(raw: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not raw:
        return zstandard.ZstdCompressor(**plain)
    shared = zstandard.ZstdCompressionDict(raw)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=shared, **plain)


def sizes(column: pa.Array, model: Model) -> np.ndarray:
    """(normalised difference, compressed share, log length) per text."""
    good, bad = compressor(model.good), compressor(model.bad)
    empty_good, empty_bad = len(good.compress(b"")), len(bad.compress(b""))
    out = np.zeros((len(column), 3))
    for i, text in enumerate(column):
        raw = text.as_buffer() if text.is_valid else b""
        g, b = len(good.compress(raw)) - empty_good, len(bad.compress(raw)) - empty_bad
        out[i] = (b - g) / (b + g + 1), (b + g) / (2 * len(raw) + 1), np.log1p(len(raw))
    return out


def features(found: np.ndarray) -> np.ndarray:
    d, r, n = found[:, 0] * 10, found[:, 1], found[:, 2] / 10
    return np.stack([np.ones(len(d)), d, r, n, d * n, r * n, r * r, n * n, d * r, np.minimum(d, 0) ** 2], 1)


def _measured(df: DataFrame, model: Model, columns: str) -> DataFrame:
    """``df``'s columns without the text, then the three sizes. The text is the last column of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sizes(batch.column(batch.num_columns - 1), shared.value)
            names = [*batch.schema.names[:-1], "d", "r", "n"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found.T)], names=names)

    return df.mapInArrow(run, f"{columns}, d double, r double, n double")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Dictionaries and calibration from bounded samples of labelled rows outside the held-out fold.

    Without rows of a class its dictionary is empty; without any labelled row every score is one half.
    """
    raw = {}
    for value in (0, 1):
        ids = samples.label_sample(labels, label, DICTIONARY_ROWS, "dictionary", value)
        texts = samples.with_texts(docs, ids).select("doc_id", samples.piece(F.col("text"), F.col("doc_id"), PIECE_CHARS).alias("t"))
        raw[value] = [row["t"].encode() for row in texts.orderBy("doc_id", "t").collect() if row["t"]]
    model = Model(dictionary(raw[1]), dictionary(raw[0]), [])
    ids = samples.label_sample(labels, label, CALIBRATION_ROWS, "calibration")
    rows = samples.with_texts(docs, ids).select("doc_id", "y", "text")
    found = sorted(map(tuple, _measured(rows, model, "doc_id bigint, y int").collect()))
    table = np.array(found, float).reshape(-1, 5)
    model.weights = samples.logistic(features(table[:, 2:]), table[:, 1]).tolist()
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A null text counts as empty; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = samples.probability(features(sizes(batch.column(2), shared.value)) @ np.array(shared.value.weights))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), samples.held_out(F.col("doc_id").cast("bigint")), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    plain = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(docs.dtypes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = samples.probability(features(sizes(batch.column(at), shared.value)) @ np.array(shared.value.weights))
            yield batch.filter(pa.array(p >= threshold))

    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names).mapInArrow(run, plain).toDF(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Train on the labelled rows outside the held-out fold and score every document (see ``train`` and ``score``)."""
    return score(docs, train(docs, labels, label), threshold)
