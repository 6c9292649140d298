"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled texts (U) train a linear classifier on word features with the class-prior
corrected risk: prior * E_P[l(f, +)] + max(0, E_U[l(f, -)] - prior * E_P[l(f, -)]). Where the second part falls below
zero, the step goes the other way, which keeps flexible models from calling all of U negative.

Features of a text are the distinct hashes of its lower-cased words and of their first 4 and 5 bytes, so inflected
forms of a stem share weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import samples
from larder.llm.words import ALNUM, Words, find_words, mix, text_slices, word_hashes

#: Bounds of the training sets: confirmed toxic texts, unlabelled texts, and the characters taken of each.
POSITIVE_ROWS = 3000
UNLABELLED_ROWS = 6000
PIECE_CHARS = 6000
#: A feature counts if at least so many training texts, and toxic ones among them, have it.
LEAST_TEXTS, LEAST_TOXIC = 12, 3
STEPS, RATE = 300, 0.02
#: The first fit is held short by a strong penalty and selects features; the second fits those with a weak one.
SELECT_RIDGE, RIDGE, SELECT_SHARE = 5e-3, 1e-4, 0.1
THRESHOLD = 0.3


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def text_features(part) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, document) of every word occurrence in a slice: whole word, first 4 and first 5 bytes."""
    words = find_words(part, ALNUM)
    docs = words.docs()
    found = [word_hashes(part, words, lower=True)]
    for size in (4, 5):
        heads = Words(words.starts, np.minimum(words.ends, words.starts + size), words.bounds)
        found.append(mix(word_hashes(part, heads, lower=True) + np.uint64(size)))
    return np.concatenate(found), np.tile(docs, 3)


def distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first = np.unique(keys.astype(np.uint64) ^ mix(docs.astype(np.uint64) + np.uint64(1)), return_index=True)
    return keys[first], docs[first]


def _presence(texts: list[str], only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) pairs, a slice of texts at a time; with ``only`` just those sorted features, as their indices."""
    keys, docs, first = [np.empty(0, np.uint64 if only is None else np.int64)], [np.empty(0, np.int64)], 0
    for part in text_slices(pa.array(texts, pa.string())):
        k, d = distinct(*text_features(part))
        if only is not None:
            at = np.searchsorted(only, k)
            at[at == len(only)] = 0
            known = only[at] == k if len(only) else np.zeros(len(k), bool)
            k, d = at[known], d[known]
        keys.append(k)
        docs.append(d + first)
        first += len(part)
    return np.concatenate(keys), np.concatenate(docs)


def fit(positive: list[str], unlabelled: list[str], prior: float) -> Model:
    """Full-batch Adam on the non-negative risk with logistic loss; the iterates of the second half are averaged.

    A feature must occur in LEAST_TOXIC toxic texts and in LEAST_TEXTS texts. Without toxic or unlabelled texts all
    scores are the prior.
    """
    prior = min(max(prior, 1e-4), 0.9)
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.empty(0, np.uint64), np.empty(0), start)
    keys, counts = np.unique(_presence(positive)[0], return_counts=True)
    keys = keys[counts >= LEAST_TOXIC]
    (pi, pd), (ui, ud) = _presence(positive, keys), _presence(unlabelled, keys)
    often = np.bincount(pi, minlength=len(keys)) + np.bincount(ui, minlength=len(keys)) >= LEAST_TEXTS
    code = np.cumsum(often) - 1
    pi, pd, ui, ud = code[pi[often[pi]]], pd[often[pi]], code[ui[often[ui]]], ud[often[ui]]
    keys = keys[often]
    n_p, n_u = len(positive), len(unlabelled)
    w, _ = descend(pi, pd, ui, ud, n_p, n_u, len(keys), prior, SELECT_RIDGE)
    large = w >= SELECT_SHARE * w.max(initial=0)
    code = np.cumsum(large) - 1
    pi, pd, ui, ud = code[pi[large[pi]]], pd[large[pi]], code[ui[large[ui]]], ud[large[ui]]
    w, b = descend(pi, pd, ui, ud, n_p, n_u, int(large.sum()), prior, RIDGE)
    return Model(keys[large], w, b)


def descend(pi, pd, ui, ud, n_p: int, n_u: int, n: int, prior: float, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and bias: Adam on the risk of ``n_p`` toxic and ``n_u`` unlabelled texts with features (pi, pd), (ui, ud)."""
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    w_sum, b_sum, summed = np.zeros(n), 0.0, 0
    for step in range(1, STEPS + 1):
        fp = b + np.bincount(pd, w[pi], n_p)
        fu = b + np.bincount(ud, w[ui], n_u)
        sp, su = samples.sigmoid(fp), samples.sigmoid(fu)
        # l(f, +) = log(1 + e^-f), l(f, -) = log(1 + e^f)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp, gu = -prior * sp / n_p, su / n_u
        if negative < 0:
            gp, gu = -gp, -gu
        else:
            gp = gp - prior * (1 - sp) / n_p
        g = np.bincount(pi, gp[pd], n) + np.bincount(ui, gu[ud], n) + ridge * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= RATE * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
        if 2 * step > STEPS:
            w_sum, b_sum, summed = w_sum + w, b_sum + b, summed + 1
    return w_sum / summed, float(b_sum / summed)


def scores(column: pa.Array, model: Model) -> np.ndarray:
    out = np.full(len(column), model.bias)
    for part in text_slices(column):
        keys, docs = text_features(part)
        if not len(model.keys):
            continue
        at = np.searchsorted(model.keys, keys)
        at[at == len(model.keys)] = 0
        ok = model.keys[at] == keys
        at, docs = distinct(at[ok], docs[ok])
        out[part.first : part.first + len(part)] += np.bincount(docs, model.weights[at], len(part))
    return samples.probability(out)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on bounded samples: confirmed toxic rows outside the held-out fold, and documents taken without their labels.

    The class prior is the toxic share of all labelled rows outside the held-out fold.
    """
    known = labels.where(~samples.held_out(F.col("doc_id")) & F.col(label).isin(0, 1))
    prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    short = samples.piece(F.col("text"), F.col("doc_id"), PIECE_CHARS).alias("t")
    toxic = samples.with_texts(docs, samples.label_sample(labels, label, POSITIVE_ROWS, "toxic", 1))
    other = samples.with_texts(docs, samples.document_sample(docs, UNLABELLED_ROWS, "unlabelled"))
    texts = [[r["t"] for r in x.select("doc_id", short).orderBy("doc_id", "t").collect()] for x in (toxic, other)]
    return fit(*texts, prior)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A null text counts as empty, a null id is not held out.

    Labels other than 0 and 1, and labels without a document, are ignored; other columns are too, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = scores(batch.column(2), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), samples.held_out(F.col("doc_id").cast("bigint")), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
