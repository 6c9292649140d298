"""Benchmark decontamination by suffix arrays over the training shards.

A shard is a slice of the documents that one task holds. Its suffix array orders the word positions of the shard by the
words that follow, to the depth of the longest benchmark item. Every suffix of every benchmark item is binary-searched
in it, one word deeper at a time, which gives its longest verbatim match and the places of every match.

The benchmark may have any size: it is taken in blocks of at most ``BLOCK_WORDS`` words (a checked bound), each broadcast
and searched against all rows. Texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StructField, StructType

from larder.llm.words import ALNUM, cover, find_words, text_slices, word_hashes
from larder.session import materialise

WINDOW = 10
#: Words of benchmark text in one broadcast block: about 25 MB with the search tables.
BLOCK_WORDS = 1_000_000


@dataclass
class TestBlock:
    """A block of benchmark items as word codes: ``codes`` of all items end to end, ``bounds`` per item."""

    ids: list[str | None]
    vocabulary: np.ndarray  # sorted word hashes; the code of a word is its index plus one
    codes: np.ndarray
    bounds: np.ndarray

    @property
    def depth(self) -> int:
        return int(np.diff(self.bounds).max(initial=0))


def test_block(ids: list[str | None], texts: list[str]) -> TestBlock:
    hashes, bounds = [], [0]
    for part in text_slices(pa.array(texts, pa.string())):
        words = find_words(part, ALNUM)
        hashes.append(word_hashes(part, words, lower=True))
        bounds.extend((words.bounds[1:] + bounds[-1]).tolist())
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    vocabulary = np.unique(flat)
    return TestBlock(ids, vocabulary, np.searchsorted(vocabulary, flat) + 1, np.array(bounds, np.int64))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int | None = None):
    """The items in blocks of at most ``limit`` words (one longer item makes its own block), read one block at a time.

    Words are those of the search. Items without an id are items like others.
    """
    size = 0
    ids: list[str | None] = []
    texts: list[str] = []
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.coalesce(text_col, F.lit("")).alias("t"))
    for row in rows.dropDuplicates().orderBy("i", "t").toLocalIterator():
        n = 1 + sum(len(find_words(part, ALNUM).starts) for part in text_slices(pa.array([row["t"]], pa.string())))
        if ids and size + n > (limit or BLOCK_WORDS):
            yield test_block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += n
    if ids:
        yield test_block(ids, texts)


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int, top: int) -> np.ndarray:
    """``starts`` ordered by the ``depth`` codes that follow each; ``codes`` are at most ``top`` and padded by zeros.

    Several codes are packed into one 64-bit key; only runs that tie on a key are sorted by the next key.
    """
    bits = max(1, int(top).bit_length())
    per_key = max(1, 63 // bits)
    order, tied = starts.copy(), [np.arange(len(starts))]
    group = np.zeros(len(starts), np.int64)
    for at in range(0, depth, per_key):
        idx = tied[0]
        if not len(idx):
            break
        here = order[idx]
        key = np.zeros(len(here), np.int64)
        for j in range(per_key):
            key = (key << bits) | codes[here + at + j]
        sub = np.lexsort((key, group[idx]))
        order[idx] = here[sub]
        key, groups = key[sub], group[idx]
        new = np.ones(len(idx), bool)
        new[1:] = (key[1:] != key[:-1]) | (groups[1:] != groups[:-1])
        ids = np.cumsum(new)
        group[idx] = ids
        size = np.bincount(ids)
        tied[0] = idx[size[ids] > 1]
    return order


def search(block: TestBlock, codes: np.ndarray, order: np.ndarray, want: np.ndarray):
    """Binary search of all test suffixes at once: (low, high) range at depth ``want[s]``, and the longest match of each.

    A suffix is followed to the depth it wants or, where that is beyond its item, not at all.
    """
    n = len(block.codes)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    kept_low, kept_high, longest = (np.zeros(n, np.int64) for _ in range(3))
    alive = np.flatnonzero(want > 0) if len(order) else np.empty(0, np.int64)
    depth = 0
    while len(alive):
        word = block.codes[alive + depth]
        lo = bound(codes, order, low[alive], high[alive], depth, word, left=True)
        hi = bound(codes, order, lo, high[alive], depth, word, left=False)
        found = hi > lo
        alive, lo, hi = alive[found], lo[found], hi[found]
        depth += 1
        low[alive], high[alive], longest[alive] = lo, hi, depth
        done = want[alive] == depth
        kept_low[alive[done]], kept_high[alive[done]] = lo[done], hi[done]
        alive = alive[~done]
    return kept_low, kept_high, longest


def bound(codes, order, low, high, depth, word, left: bool) -> np.ndarray:
    """First place in [low, high) whose code at ``depth`` is not below (left) or is above (right) ``word``."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        code = codes[order[mid] + depth]
        right = code < word[open_] if left else code <= word[open_]
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
        open_ = open_[low[open_] < high[open_]]
    return low


def scan_shard(part, words, block: TestBlock, window: int, every: bool = False):
    """Search one shard: (mask of covered words, documents, items, (document word, item word, length)) of the matches.

    The matches are those of the items' windows; with ``every`` they are the maximal matches of ``window`` words or more.
    """
    counts = words.counts()
    n, depth = len(words.starts), block.depth
    hashes = word_hashes(part, words, lower=True)
    spot = np.searchsorted(block.vocabulary, hashes)
    known = spot < len(block.vocabulary)
    known[known] = block.vocabulary[spot[known]] == hashes[known]
    # a zero after every document keeps matches inside it; zeros at the end serve reads beyond the last word
    codes = np.zeros(n + len(counts) + depth + 64, np.int64)
    places = np.arange(n) + words.docs()
    codes[places] = np.where(known, spot + 1, 0)
    order = suffix_array(codes, places[known], depth, len(block.vocabulary))
    lengths = np.diff(block.bounds)
    length = np.repeat(lengths, lengths)
    begins = np.arange(len(block.codes)) - np.repeat(block.bounds[:-1], lengths)
    want = np.where(begins + window <= length, window, np.where((begins == 0) & ~np.array(every), length, 0))
    low, high, _ = search(block, codes, order, want)
    hits = high - low
    suffix = np.repeat(np.arange(len(hits)), hits)
    place = order[low[suffix] + np.arange(len(suffix)) - np.repeat(np.cumsum(hits) - hits, hits)]
    doc = np.searchsorted(np.cumsum(counts + 1), place, "right")
    item = np.searchsorted(block.bounds, suffix, "right") - 1
    size = want[suffix]
    covered = cover(n, place - doc, size)
    if every and len(place):
        before = (begins[suffix] > 0) & (place > 0)
        before[before] = codes[place[before] - 1] == block.codes[suffix[before] - 1]
        place, suffix, doc, item, size = (x[~before] for x in (place, suffix, doc, item, size))
        growing = np.arange(len(place))
        while len(growing):
            growing = growing[begins[suffix[growing]] + size[growing] < length[suffix[growing]]]
            more = codes[place[growing] + size[growing]] == block.codes[suffix[growing] + size[growing]]
            growing = growing[more]
            size[growing] += 1
    return covered, doc, item, (place - doc - words.bounds[doc], begins[suffix], size)


def named(items: set[str | None]) -> list[str]:
    """The ids of a set of items, sorted; an item without one has no name."""
    return sorted(x for x in items if x is not None)


def _search_all(docs: DataFrame, text: str, benchmark: DataFrame, window: int, finish, schema) -> DataFrame:
    """Scan ``docs`` once per block of items, then ``finish(columns, part, words, hit, items)`` makes the result rows.

    What earlier blocks found travels beside the text as a bit mask of hit words and a list of item ids.
    """
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(docs.columns))]
    state = docs.toDF(*names).withColumns(
        {
            "text_": F.coalesce(F.col(names[docs.columns.index(text)]), F.lit("")),
            "hit_": F.lit(None).cast("binary"),
            "items_": F.array().cast("array<string>"),
        }
    )
    between = state.schema

    def pass_over(frame: DataFrame, block: TestBlock, last: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *_, texts, hits, found = batch.columns
                for part in text_slices(texts):
                    words = find_words(part, ALNUM)
                    hit, doc, item, _ = scan_shard(part, words, shared.value, window)
                    rows = slice(part.first, part.first + len(part))
                    for d, bits in enumerate(hits[rows].to_pylist()):
                        if bits:
                            a, b = words.bounds[d : d + 2]
                            hit[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).view(bool)
                    items = [set(x) for x in found[rows].to_pylist()]
                    for d, i in np.unique(np.stack([doc, item], 1), axis=0).tolist():
                        items[d].add(shared.value.ids[i])
                    columns = [c.slice(part.first, len(part)) for c in batch.columns]
                    if last:
                        yield finish(columns[:-3], part, words, hit, items)
                    else:
                        masks = [np.packbits(hit[a:b]).tobytes() for a, b in zip(words.bounds, words.bounds[1:])]
                        columns[-2:] = [pa.array(masks, pa.binary()), pa.array([[*named(x), *({None} & x)] for x in items], pa.list_(pa.string()))]
                        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        return frame.mapInArrow(run, schema if last else between)

    waiting: TestBlock | None = None
    for block in blocks(benchmark):
        if waiting is not None:
            state = materialise(pass_over(state, waiting, last=False), "benchmark-hits")
        waiting = block
    return pass_over(state, waiting or test_block([], []), last=True)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id") -> DataFrame:
    """One row per document: its id, n_words, n_hit, n_items, items_sha256 and contaminated.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A null or empty text has no words; repeated
    rows each get their row; a null id stays null; items without words match nothing; items that share an id count as one,
    and so do those without an id, which mark words and count but have no name in ``items_sha256``. Other columns of ``docs`` are ignored, whatever their names. One block of items takes one scan
    without a shuffle; each further block adds a scan.
    """
    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"

    def finish(columns, part, words, hit, items):
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.bounds])
        names = [hashlib.sha256(",".join(named(x)).encode()).hexdigest() for x in items]
        values = [pa.array(words.counts()), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(names)]
        return pa.RecordBatch.from_arrays(
            [columns[0], *values, pa.array(n_hit > 0)],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col("text"))
    return _search_all(narrow, "text", benchmark, window, finish, schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without an occurrence of a benchmark window, all columns unchanged.

    A null or empty text has no words and stays; repeated rows stay or go together; columns may have any names; an empty
    benchmark keeps all rows, an empty table gives no rows. Items without an id count like others.
    """

    def finish(columns, part, words, hit, items):
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.bounds])
        batch = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
        return batch.filter(pa.array(n_hit == 0))

    plain = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    return _search_all(docs, text, benchmark, window, finish, plain).toDF(*docs.columns)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, least: int = WINDOW, id_col: str = "doc_id"
) -> DataFrame:
    """Maximal verbatim matches of at least ``least`` words: (doc_id, item_id, doc_word, item_word, n_words).

    A match that is part of a longer one of the same document and item, at the same distance, is left out. Rows as in
    ``contamination``. Each block of items gives its own rows.
    """
    schema = "doc_id bigint, item_id string, doc_word bigint, item_word bigint, n_words bigint"
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = None
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                for part in text_slices(batch.column(1)):
                    words = find_words(part, ALNUM)
                    _, doc, item, (at, begins, longest) = scan_shard(part, words, shared.value, least, every=True)
                    left = pa.array(doc + part.first)
                    names = pa.array([shared.value.ids[i] for i in item.tolist()], pa.string())
                    columns = [ids.take(left), names, pa.array(at), pa.array(begins), pa.array(longest)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "doc_word", "item_word", "n_words"])

        rows = narrow.mapInArrow(run, schema)
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)
