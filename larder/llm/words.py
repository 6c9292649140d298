"""Words of whole texts as numpy arrays: spans, 64-bit hashes and window hashes, for use inside Arrow tasks.

All functions work on a ``Texts`` slice: the UTF-8 bytes of several documents laid end to end. A word is a run of bytes
that a 256-entry table marks, and never crosses a document's end. UTF-8 makes both word classes used here decidable
byte by byte, because every byte of a non-ASCII character is at least 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at once; a single longer text is still taken whole.
SLICE_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: `[^\x20\x09-\x0D]+`
NOT_SPACE = ~SPACES
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass
class Texts:
    """Bytes of documents ``first`` to ``first + len(offsets) - 2`` of a batch; ``offsets`` start at 0."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of a string column with at most ``limit`` bytes, or one longer text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Texts(whole[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


@dataclass
class Words:
    """Word spans of a slice; ``bounds[d]`` is the index of document d's first word."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def docs(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def find_words(texts: Texts, table: np.ndarray) -> Words:
    inside = table[texts.data]
    n = len(inside)
    if not n:
        return Words(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]  # first byte of every document that has one
    begins[edges] = inside[edges]
    last = edges[1:] - 1
    closes[last] = inside[last]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, texts.offsets))


def word_hashes(texts: Texts, words: Words, lower: bool) -> np.ndarray:
    """64-bit hash of every word: a polynomial over its bytes, then mixed."""
    if not len(words.starts):
        return np.empty(0, np.uint64)
    starts, n = words.starts, len(texts.data)
    values = BYTE_VALUES[LOWER] if lower else BYTE_VALUES
    lengths = words.ends - starts
    powers = np.full(int(lengths.max()), BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    total = np.cumsum(lengths)
    if total[-1] == n:
        picked = texts.data
    else:
        picked = texts.data[np.arange(total[-1]) + np.repeat(starts - total + lengths, lengths)]
    place = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
    sums = np.add.reduceat(values[picked] * powers[place], total - lengths)
    return mix(sums + lengths.astype(np.uint64))


def window_hashes(hashes: np.ndarray, words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``k`` words inside one document: a Rabin-Karp polynomial modulo 2^64."""
    starts = window_starts(words, k)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    n = len(hashes) - k + 1
    rolled = hashes[:n].copy()
    for j in range(1, k):
        rolled *= BASE
        rolled += hashes[j : n + j]
    return mix(rolled[starts]), starts


def window_starts(words: Words, k: int) -> np.ndarray:
    """Indices of the words that start a run of ``k`` words in their document."""
    counts = words.counts()
    left = np.repeat(words.bounds[1:], counts) - np.arange(len(words.starts))
    return np.flatnonzero(left >= k)


def cover(n_words: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Mask of the words inside at least one of the runs; overlapping runs merge into maximal intervals."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def joined(texts: Texts, words: Words, keep: np.ndarray) -> Iterator[bytes]:
    """Per document: its kept words joined by one space."""
    starts, lengths = words.starts[keep], (words.ends - words.starts)[keep]
    ends = np.cumsum(lengths + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    if len(out):
        source = np.arange(len(out)) + np.repeat(starts - (ends - lengths - 1), lengths + 1)
        np.take(texts.data, source, out=out, mode="clip")
        out[ends - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
    edges = np.concatenate([[0], ends])[kept]
    view = out.data
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield bytes(view[a : b - 1]) if b > a else b""


def to_planes(values: np.ndarray) -> bytes:
    """A uint64 array with equal-order bytes side by side: sorted or small values then compress well in a shuffle."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes | memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
