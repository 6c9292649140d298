"""Text encoders and batch embedding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.joins import update_by_key
from larder.operators.splits import even_batches


class Encoder(Protocol):
    """Anything that turns texts into vectors of one size; it is built once per Python worker."""

    size: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Seeded hashing encoder: every token adds +1 or -1 at a hashed position; the sum is scaled to length 1.

    Position and sign come from the md5 of token and seed, so any engine can compute the same vectors. Each distinct
    token of a batch is hashed once.
    """

    def __init__(self, size: int = 64, seed: int = 7):
        self.size, self.seed = size, seed
        self._token = re.compile(r"[^\W_]+(?:-[^\W_]+)*")

    def encode(self, texts: list[str]) -> np.ndarray:
        found = [self._token.findall((text or "").lower()) for text in texts]
        rows = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        codes, names = pd.factorize(np.array([t for f in found for t in f], dtype=object))
        digests = [int(hashlib.md5(f"{t}{self.seed}".encode()).hexdigest()[:9], 16) for t in names]
        places = np.array([(d >> 4) % self.size for d in digests], np.int64)
        signs = np.array([1.0 if d & 1 else -1.0 for d in digests])
        out = np.zeros((len(texts), self.size))
        if len(codes):
            np.add.at(out, (rows, places[codes]), signs[codes])
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norms > 0, norms, 1.0)).astype(np.float32)


# Encoders by alias, all hashing ones; register another factory here to use a trained model.
ENCODERS = {
    "hashing-64": lambda: HashingEncoder(64, 1),
    "hashing-64-b": lambda: HashingEncoder(64, 2),
    "hashing-128": lambda: HashingEncoder(128, 3),
    "hashing-128-b": lambda: HashingEncoder(128, 4),
}


def embed(df: DataFrame, ident: str, text: str, model: str = "hashing-64") -> DataFrame:
    """``(id, description, embedding)``; Arrow batches, one encoder per Python worker, no shuffle."""
    factory = ENCODERS[model]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = factory()
        for batch in batches:
            vectors = encoder.encode(batch["description"].tolist())
            yield batch.assign(embedding=list(vectors))

    key_type = df.schema[ident].dataType.simpleString()
    rows = df.select(F.col(ident).alias("id"), F.col(text).alias("description"))
    return rows.mapInPandas(encode, f"id {key_type}, description string, embedding array<float>")


def embed_in_batches(df: DataFrame, ident: str, text: str, model: str = "hashing-64", batches: int = 10) -> DataFrame:
    """The same with the number of the even batch each row belongs to."""
    numbered = even_batches(df.select(ident), ident, batches).select(F.col(ident).alias("id"), "batch")
    return embed(df, ident, text, model).join(numbered, "id")


def write_back(docs: DataFrame, embeddings: DataFrame, key: str = "id", row_key: str = "fid") -> DataFrame:
    """Vectors set on the first document of each id."""
    return update_by_key(docs, embeddings.select(key, "embedding"), key, "embedding", row_key)
