"""Substring removal: word windows that an earlier document already has, by Rabin-Karp hashes counted in buckets.

1. Every task hashes all windows of its texts, sorts them and keeps the smallest document per distinct window.
2. Buckets of the hash space merge these: a window's first document is the smallest that any task saw.
3. A task's later documents get their covered windows back; runs of covered windows merge into maximal intervals.

Window hashes have 64 bits: among n distinct windows about n^2 / 2^65 pairs collide (0.0005 for 140 million).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import exchange
from larder.llm.words import NOT_SPACE, Texts, Words, cover, find_words, joined, mix, text_slices
from larder.llm.words import window_hashes, word_hashes

WINDOW = 13


def _windows(part: Texts, window: int) -> tuple[Words, np.ndarray, np.ndarray]:
    words = find_words(part, NOT_SPACE)
    keys, starts = window_hashes(word_hashes(part, words, lower=False), words, window)
    return words, keys, starts


def _smallest(ids: np.ndarray, keys: np.ndarray):
    """Pairs sorted by key and id, the mask of each key's first pair, and of pairs with a larger id than that."""
    order = np.lexsort((ids, keys))
    ids, keys = ids[order], keys[order]
    first = np.append(True, keys[1:] != keys[:-1])
    return ids, keys, first, ids > ids[first][np.cumsum(first) - 1]


def _send(ids: np.ndarray, keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows of one chunk: the distinct windows with their smallest document, and what is known already."""
    ids, keys, first, later = _smallest(ids, keys)
    direct = exchange.answers(ids[later], keys[later], bits)
    return exchange.sent_rows(ids[first], keys[first], int(ids.min()), direct, bits)


def repeated_windows(docs: DataFrame, bits: int, window: int = WINDOW, id_col: str = "doc_id") -> DataFrame:
    """Packed (document, window hash) pairs whose window occurs in a document with a smaller id, by document group."""

    chunk_keys = exchange.CHUNK_KEYS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held = [], [], 0
        for batch in batches:
            doc_ids = batch.column(0).to_numpy()
            for part in text_slices(batch.column(1)):
                words, found, starts = _windows(part, window)
                if not len(found):
                    continue
                ids.append(doc_ids[part.first + np.searchsorted(words.bounds, starts, "right") - 1])
                keys.append(found)
                held += len(found)
                if held >= chunk_keys:
                    yield _send(np.concatenate(ids), np.concatenate(keys), bits)
                    ids, keys, held = [], [], 0
        if held:
            yield _send(np.concatenate(ids), np.concatenate(keys), bits)

    def merge(table: pa.Table) -> pa.Table:
        known = exchange.pass_direct(table, bits)
        if known is not None:
            return known
        ids, keys, _, later = _smallest(*exchange.unpack(table))
        return exchange.answer_table(exchange.answers(ids[later], keys[later], bits))

    sent = docs.select(exchange.key_of(F.col(id_col)).alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    return sent.mapInArrow(send, exchange.SENT).groupBy("bucket").applyInArrow(merge, exchange.ANSWERS)


def _covered(part: Texts, ids: np.ndarray, found: np.ndarray, window: int) -> tuple[Words, np.ndarray]:
    """Words and the mask of those to remove; ``found`` has the sorted hashes of (document id, window) pairs to remove."""
    words, keys, starts = _windows(part, window)
    doc = np.searchsorted(words.bounds, starts, "right") - 1
    pairs = _pair(ids[part.first + doc], keys)
    at = np.searchsorted(found, pairs)
    at[at == len(found)] = 0
    hit = found[at] == pairs if len(found) else np.zeros(len(pairs), bool)
    return words, cover(len(words.starts), starts[hit], window)


def _pair(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return keys ^ mix(ids.astype(np.uint64))


def _per_document(docs: DataFrame, window: int, id_col: str, result, schema: str) -> DataFrame:
    """``result(ids, part, words, removed)`` for slices of the documents of every group."""
    bits = exchange.bucket_bits(docs)
    found = repeated_windows(docs, bits, window, id_col)
    ident = F.col(id_col).cast("bigint")
    rows = docs.select(ident.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), exchange.key_of(ident).alias("k"))
    rows = rows.withColumn("g", exchange.group_of(F.col("k"), bits))

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        pairs = np.sort(_pair(*exchange.unpack(packed)))
        ids = texts.column("k").to_numpy()
        out = []
        for part in text_slices(texts.column("text")):
            words, gone = _covered(part, ids, pairs, window)
            out.append(result(texts.column("doc_id").slice(part.first, len(part)), part, words, gone))
        return pa.concat_tables(out) if out else empty

    empty = result(pa.array([], pa.int64()), Texts(np.empty(0, np.uint8), np.zeros(1, np.int64), 0), *_NOTHING)
    return rows.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(run, schema)


_NOTHING = Words(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64)), np.zeros(0, bool)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Removed is each word inside a window of ``window`` words that also starts in a document with a smaller id, judged on
    the whole input. Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A null or empty text has no words, and the hash of an
    empty text. A null id counts as larger than every id and stays null; rows that share an id are one document, so they
    don't remove each other's words. Other columns are ignored, whatever their names.
    """

    def result(ids, part, words, gone):
        total = np.concatenate([[0], np.cumsum(gone)])[words.bounds]
        hashes = [hashlib.sha256(x).hexdigest() for x in joined(part, words, ~gone)]
        columns = [ids, pa.array(words.counts()), pa.array(np.diff(total)), pa.array(hashes, pa.string())]
        return pa.table(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _per_document(docs, window, id_col, result, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def removal_intervals(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id") -> DataFrame:
    """The maximal runs of removed words per document: (doc_id, first_word, n_words, kept_text). Cases as above."""
    longs = pa.list_(pa.int64())

    def result(ids, part, words, gone):
        begins, sizes = [], []
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
            begins.append(edge[::2])
            sizes.append(edge[1::2] - edge[::2])
        texts = [x.decode() for x in joined(part, words, ~gone)]
        columns = [ids, pa.array(begins, longs), pa.array(sizes, longs), pa.array(texts, pa.string())]
        return pa.table(columns, names=["doc_id", "first_word", "n_words", "kept_text"])

    schema = "doc_id bigint, first_word array<bigint>, n_words array<bigint>, kept_text string"
    return _per_document(docs, window, id_col, result, schema)
