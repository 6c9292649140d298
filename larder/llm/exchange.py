"""Occurrences of 64-bit keys dealt out to hash buckets as packed arrays, and the answers dealt back to the documents.

A task sorts the keys of many documents at once and sends every bucket one binary row, not one row per key. A key that
a task sees in several documents is sent once, so a key held by a third of all documents reaches its bucket once per
chunk. What the task knows by itself goes along as ``direct`` rows. A bucket's answers are packed by group of documents.
The number of buckets and groups follows the size of the texts, so each stays within a task's memory at any scale.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.words import from_planes, to_planes

#: Keys that a task gathers before it deals them out.
CHUNK_KEYS = 600_000
#: Text bytes per bucket: about 1.6 million keys, some 60 MB in a task that merges them.
BUCKET_BYTES = 8 << 20
#: A null id stands for the largest id.
NO_ID = (1 << 63) - 1


def key_of(ident: Column) -> Column:
    """The id as a sort key: null counts as larger than every id."""
    return F.coalesce(ident.cast("bigint"), F.lit(NO_ID))


def bucket_bits(docs: DataFrame, text: str = "text") -> int:
    """Log2 of the number of buckets for these texts: 16 buckets at least."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(4, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))


def bucket_edges(sorted_keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins among sorted keys; a bucket is the top ``bits`` bits of the key."""
    tops = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(sorted_keys, tops), len(sorted_keys))


def groups(bits: int) -> int:
    """Number of document groups for so many buckets; odd, so that ids in regular steps spread over all."""
    return (1 << bits) + 1


def group_of(k: Column, bits: int) -> Column:
    return F.pmod(k, F.lit(groups(bits)))


SENT = "bucket bigint, direct boolean, base bigint, docs binary, keys binary"
ANSWERS = "g bigint, base bigint, docs binary, keys binary"


def answers(ids: np.ndarray, keys: np.ndarray, bits: int) -> list[tuple]:
    """(group, base, packed ids, packed keys) rows of the given (id, key) pairs."""
    if not len(ids):
        return []
    group = ids % groups(bits)
    order = np.lexsort((keys, ids, group))
    ids, keys, group = ids[order], keys[order], group[order]
    edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)).tolist()
    rows = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        base = int(ids[a])
        rows.append((int(group[a]), base, to_planes((ids[a:b] - base).astype(np.uint64)), to_planes(keys[a:b])))
    return rows


def sent_rows(ids: np.ndarray, keys: np.ndarray, offset: int, direct: list[tuple], bits: int) -> pa.RecordBatch:
    """Rows of one chunk: ``direct`` answers, and sorted distinct ``keys`` with one id each, cut by bucket."""
    rows = [((1 << bits) + g, True, base, d, k) for g, base, d, k in direct]
    edges = bucket_edges(keys, bits)
    for b in np.flatnonzero(np.diff(edges)).tolist():
        cut = slice(edges[b], edges[b + 1])
        rows.append((b, False, offset, to_planes((ids[cut] - offset).astype(np.uint64)), to_planes(keys[cut])))
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
    columns = [pa.array(x, t) for x, t in zip(zip(*rows), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "direct", "base", "docs", "keys"])


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The (id, key) pairs in packed rows."""
    keys = [from_planes(x.as_buffer()) for c in table.column("keys").chunks for x in c]
    bases = table.column("base").to_pylist()
    packed = [x for c in table.column("docs").chunks for x in c]
    ids = [from_planes(x.as_buffer()).astype(np.int64) + b for x, b in zip(packed, bases, strict=True)]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(ids), np.concatenate(keys)


def answer_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    columns = zip(*rows) if rows else ((),) * 4
    arrays = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
    return pa.table(arrays, names=["g", "base", "docs", "keys"])


def pass_direct(table: pa.Table, bits: int) -> pa.Table | None:
    """The answers in a bucket of direct rows; None for a bucket of keys."""
    if not table.num_rows or not table.column("direct")[0].as_py():
        return None
    group = pa.array(np.array(table.column("bucket").to_pylist(), np.int64) - (1 << bits))
    return pa.table([group, *(table.column(c) for c in ("base", "docs", "keys"))], names=["g", "base", "docs", "keys"])
