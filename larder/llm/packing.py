"""Token ids in packed rows of a fixed length, by best-fit decreasing.

Texts are encoded with a public byte-pair vocabulary, whose file is a parameter. Blank space always ends a pre-token
of such vocabularies, so a task cuts its texts there, encodes every distinct piece once and puts the ids together by
array operations. Documents longer than a row are cut into full rows and a rest. The rests of a block of documents, longest
first, go to the row with the least room that still holds them; a segment tree over the room finds it.

Each task packs the documents that it reads, in blocks of bounded size, so nothing is shuffled and a task that is
run again gives the same rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.words import Words, text_slices, word_hashes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's pre-token pattern, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: An id that the vocabulary leaves free: it ends every document and fills the rest of a row.
END = 50256
ROW_TOKENS = 2048
#: Ids packed together: the block that a task holds in memory. Short rests of a block share its last rows.
BLOCK_TOKENS = 2 << 20
#: Distinct pieces of text that a worker remembers with their ids.
REMEMBERED = 100_000
SLICE_BYTES = 1 << 20

#: White space beyond ASCII: a text with it is encoded whole.
WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def read_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}


class Encoder:
    """Ids of whole texts; equal to encoding each text by itself. Remembers pieces it has seen."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.base = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for raw, i in ranks.items():
            self.lengths[i] = len(raw)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.begins, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces. Those from a blank to a non-blank keep their borders when they are laid end to end."""
        joint = [p for p in pieces if _SPACE[p[0]] and not _SPACE[p[-1]] and (p.isascii() or not WIDE_SPACE.search(p.decode()))]
        single = set(pieces).difference(joint)
        ids = np.array(self.base.encode_ordinary(b"".join(joint).decode()), np.int32)
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(p) for p in joint])) + 1 if joint else []
        flat, sizes = [ids], [np.diff(ends, prepend=0)]
        for p in single:
            alone = self.base.encode_ordinary(p.decode())
            flat.append(np.array(alone, np.int32))
            sizes.append([len(alone)])
        self.known.update(zip([*joint, *single], range(len(self.known), len(self.known) + len(pieces)), strict=True))
        sizes = np.concatenate(sizes).astype(np.int64)
        self.begins = np.append(self.begins, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.concatenate([self.flat, *flat])

    def slice(self, part) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, bounds per text) of a slice."""
        data, n = part.data, len(part.data)
        if not n:
            return np.empty(0, np.int32), np.zeros(len(part) + 1, np.int64)
        if len(self.known) > REMEMBERED:
            self.forget()
        blank = _SPACE[data]
        cut = np.zeros(n, bool)
        cut[1:] = blank[1:] & ~blank[:-1]
        cut[part.offsets[:-1][np.diff(part.offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        raw = data.tobytes()
        if (data >= 0x80).any() and WIDE_SPACE.search(raw.decode()):  # no cut inside texts with such blanks
            edges = zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True)
            whole = np.array([bool(WIDE_SPACE.search(raw[a:b].decode())) for a, b in edges])
            owner = np.searchsorted(part.offsets, starts, "right") - 1
            starts = starts[np.isin(starts, part.offsets[:-1]) | ~whole[owner]]
        ends = np.append(starts[1:], n)
        bounds = np.searchsorted(starts, part.offsets)
        hashes = word_hashes(part, Words(starts, ends, bounds), lower=False)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        pieces = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        new = [p for p in pieces if p not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))[which]
        counts = self.sizes[number]
        total = np.cumsum(counts)
        at = np.arange(total[-1]) + np.repeat(self.begins[number] - (total - counts), counts)
        return self.flat[at], np.concatenate([[0], total])[bounds]


class Rooms:
    """Open rows by their room; a segment tree over the room finds the fullest row that still holds a size."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self.change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the least room of at least ``size``; the row is no longer open."""
        at = size + self.leaves
        while not self.count[at]:  # up to the first subtree on the right that has a row
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self.change(room, -1)
        return room, self.rows[room].pop()


@dataclass
class Segment:
    doc: int
    start: int
    size: int


def pack(sizes: list[int], row_tokens: int) -> list[list[Segment]]:
    """Rows of segments: full rows of overlong documents, then best-fit decreasing of the rests; empty documents take none."""
    rows: list[list[Segment]] = []
    rests = []
    for doc, size in enumerate(sizes):
        whole = size // row_tokens
        rows.extend([Segment(doc, i * row_tokens, row_tokens)] for i in range(whole))
        if size % row_tokens:
            rests.append(Segment(doc, whole * row_tokens, size % row_tokens))
    rests.sort(key=lambda s: (-s.size, s.doc))
    rooms = Rooms(row_tokens)
    for rest in rests:
        found = rooms.take(rest.size)
        room, row = found if found else (row_tokens, len(rows))
        if not found:
            rows.append([])
        rows[row].append(rest)
        if room > rest.size:
            rooms.add(room - rest.size, row)
    return rows


SCHEMA = (
    "block bigint, row int, ids array<int>, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


def _block(block: int, ids: list[np.ndarray], docs: list, row_tokens: int, fill: int) -> pa.RecordBatch:
    rows = pack([len(x) for x in ids], row_tokens)
    out = np.full((len(rows), row_tokens), fill, np.int32)
    used, cuts, names, starts = [], [], [], []
    for r, segments in enumerate(rows):
        at = 0
        edges = [0]
        for s in segments:
            out[r, at : at + s.size] = ids[s.doc][s.start : s.start + s.size]
            at += s.size
            edges.append(at)
        used.append(at)
        cuts.append(edges)
        names.append([docs[s.doc] for s in segments])
        starts.append([s.start for s in segments])
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    columns = [
        pa.array(np.full(len(rows), block, np.int64)),
        pa.array(np.arange(len(rows), dtype=np.int32)),
        pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * row_tokens), pa.array(out.reshape(-1))),
        pa.array(used, pa.int32()), pa.array(cuts, ints), pa.array([c[:-1] for c in cuts], ints),
        pa.array(names, longs), pa.array(starts, longs),
    ]
    names = ["block", "row", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_starts"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def packed(
    docs: DataFrame, vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS, end: int = END, pattern: str = PATTERN
) -> DataFrame:
    """One row per packed row of ``row_tokens`` ids.

    ``ids`` holds the segments end to end and then ``end`` as filling; ``cu_seqlens`` the segment bounds, 0 first;
    ``position_resets`` the places where positions start again from 0; ``doc_ids`` and ``doc_starts`` the document of each
    segment and the place of its first id in the document. Every document's ids, with ``end`` after the last, occur once
    (``restored`` gives them back). (block, row) numbers the rows of a task: block is the partition in its high bits.

    A null or empty text is the end id alone; a null doc_id stays null; repeated rows are packed as often as they
    occur; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    block_tokens = BLOCK_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        block, ids, names, held = 0, [], [], 0
        part_id = 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            part_id = batch.column(2)[0].as_py() if batch.num_rows else part_id
            for part in text_slices(batch.column(1), SLICE_BYTES):
                flat, bounds = encoder.slice(part)
                for d in range(len(part)):
                    ids.append(np.append(flat[bounds[d] : bounds[d + 1]], np.int32(end)))
                    names.append(doc_ids[part.first + d])
                    held += len(ids[-1])
                    if held >= block_tokens:
                        yield _block((part_id << 32) + block, ids, names, row_tokens, end)
                        block, ids, names, held = block + 1, [], [], 0
        if ids:
            yield _block((part_id << 32) + block, ids, names, row_tokens, end)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().cast("bigint").alias("p"))
    return rows.mapInArrow(run, SCHEMA)


def restored(rows: DataFrame) -> DataFrame:
    """(doc_id, ids): every document's ids from packed rows, in order, with the end id. Ids must be unique and not null."""
    parts = rows.select(
        "ids", F.explode(F.arrays_zip("doc_ids", "doc_starts", F.col("position_resets").alias("from_"), F.slice("cu_seqlens", 2, 1 << 30).alias("to_"))).alias("s")
    )
    parts = parts.select("s.doc_ids", "s.doc_starts", F.slice("ids", F.col("s.from_") + 1, F.col("s.to_") - F.col("s.from_")).alias("part"))
    whole = parts.groupBy(F.col("doc_ids").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("doc_starts", "part"))).alias("parts"))
    return whole.select("doc_id", F.flatten(F.transform("parts", lambda p: p["part"])).alias("ids"))
