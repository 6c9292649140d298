"""Token ids of two vocabularies aligned on the bytes of a text.

Vocabulary A is a byte-level pair vocabulary, whose merges are the ranks of its tokens, B a piece vocabulary with bytes as its fallback. Both see a space and then
the text. All tokens of both are intervals of bytes; sorted by start, a running maximum of the ends shows where no token
of either side reaches across: there a new group begins. Within a group the overlapping tokens are expanded to pairs; a
pair whose tokens end at the same byte is a link.

Neither vocabulary has a token that goes from something else into a space, so a text is cut before such spaces and each
distinct piece is encoded and aligned once per worker. The groups and links of a text are those of its pieces, end to end.

Two tokens that end at the same byte are such that one ends with the other's bytes. So a token is linked with no more others
than it has suffixes, or is a suffix of them: the table of linked id pairs is bounded by the two vocabularies and not by
the texts, and may be broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.packing import PATTERN, WIDE_SPACE
from larder.llm.words import SPACES, Words, text_slices, word_hashes
from larder.session import materialise

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct pieces that a worker remembers, bytes of text that it turns into rows at once, and pieces encoded together.
REMEMBERED = 100_000
SLICE_BYTES = 1 << 20
ENCODED_TOGETHER = 5_000
#: The id of B in the low half of a link, the id of A in the high half.
HALF = 32


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def ranks_a(file: bytes) -> dict[bytes, int]:
    """Bytes and id of every token of A. Its merges must be in the order of their ids, which are then their ranks."""
    model = json.loads(file)["model"]
    table, vocabulary = byte_of_character(), model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary[m] for m in merged]
    if ids != sorted(ids):
        raise ValueError("merges that aren't in the order of their ids")
    return {bytes(table[c] for c in token): i for token, i in vocabulary.items()}


def token_bytes_b(pieces: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of every id of B: U+2581 is a space, a byte token its byte."""
    out = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def _ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths[ids]) if len(ids) else np.empty(0, np.int64)


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): intervals sorted by start, and each one's group number; a group begins at a start that no
    interval before it reaches beyond."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(new) - 1


def overlaps(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in A, index in B) of all pairs of overlapping intervals; each side is sorted and covers the same line."""
    low = np.searchsorted(ends_b, starts_a, "right")
    counts = np.searchsorted(starts_b, ends_a, "left") - low
    total = np.cumsum(counts)
    a = np.repeat(np.arange(len(starts_a)), counts)
    b = np.arange(len(a)) + np.repeat(low - (total - counts), counts)
    return a, b


class Aligner:
    """Groups and links of texts; remembers the pieces it has seen."""

    def __init__(self, a: bytes, b: bytes):
        ranks = ranks_a(a)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.space = self.b.piece_to_id("▁")
        self.bytes_a, self.bytes_b = [raw for raw, _ in sorted(ranks.items(), key=lambda x: x[1])], token_bytes_b(self.b)
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts: list[str] = []
        #: per piece: ids of A, ids of B, groups, overlaps, links, whether its bytes are lost
        self.counts = np.empty((0, 6), np.int64)
        self.begins, self.links = np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, ids of B, how many each piece has of A and B); none where the joined bytes differ from the piece.

        Pieces that don't end in white space are laid end to end and encoded as one text: they would be cut there anyhow.
        """
        plain = np.array([not SPACES[p[-1]] and not (not p.isascii() and WIDE_SPACE.search(p.decode())) for p in pieces])
        together = [p for p, ok in zip(pieces, plain.tolist(), strict=True) if ok]
        line = b"".join(together)
        ends = np.cumsum([len(p) for p in together])
        ids, counts = [], []
        for encode, lengths, table in ((self._ids_a, self.lengths_a, self.bytes_a), (self._ids_b, self.lengths_b, self.bytes_b)):
            joint = encode(line.decode()) if line else []
            n = np.zeros(len(pieces), np.int64)
            parts: list = [None] * len(pieces)
            if line and b"".join([table[i] for i in joint]) == line:
                joint = np.array(joint, np.int64)
                edges = np.searchsorted(np.cumsum(lengths[joint]), ends) + 1
                alone = np.flatnonzero(~plain)
            else:
                joint, edges, alone = np.empty(0, np.int64), np.zeros(len(together), np.int64), np.arange(len(pieces))
            n[plain] = np.diff(edges, prepend=0)
            for i in alone.tolist():
                one = encode(pieces[i].decode())
                parts[i] = one if b"".join([table[x] for x in one]) == pieces[i] else []
                n[i] = len(parts[i]) or -1
            if len(alone) and len(alone) < len(pieces):
                at = np.append(0, edges)
                places = iter(range(len(together)))
                flat = [parts[i] if parts[i] is not None else joint[at[k := next(places)] : at[k + 1]] for i in range(len(pieces))]
                joint = np.concatenate([np.asarray(x, np.int64) for x in flat])
            elif len(alone):
                joint = np.array([x for part in parts for x in part], np.int64)
            ids.append(joint)
            counts.append(n)
        lost = (counts[0] < 0) | (counts[1] < 0)
        for side in (0, 1):
            counts[side] = np.maximum(counts[side], 0)
            ids[side] = ids[side][np.repeat(~lost, counts[side])]
            counts[side][lost] = 0
        return *ids, *counts

    def _ids_a(self, text: str) -> list[int]:
        return self.a.encode_ordinary(text)

    def _ids_b(self, text: str) -> list[int]:
        """B adds the space that a text begins with, but not to an empty text."""
        return self.b.encode(text[1:], num_threads=1) if len(text) > 1 else [self.space]

    def _learn(self, pieces: list[bytes]) -> None:
        a, b, n_a, n_b = self._encode(pieces)
        lost = (n_a == 0).astype(np.int64)
        ends_a, ends_b = _ends(a, self.lengths_a), _ends(b, self.lengths_b)
        starts_a, starts_b = ends_a - self.lengths_a[a], ends_b - self.lengths_b[b]
        side = np.repeat([0, 1], [len(a), len(b)])
        order, group = coalesced(np.append(starts_a, starts_b), np.append(ends_a, ends_b), side)
        groups = np.empty(len(side), np.int64)
        groups[order] = group
        piece = np.append(np.repeat(np.arange(len(pieces)), n_a), np.repeat(np.arange(len(pieces)), n_b))

        over_a, over_b = overlaps(starts_a, ends_a, starts_b, ends_b)
        together = ends_a[over_a] == ends_b[over_b]
        owner = piece[: len(a)]
        links = (a[over_a[together]] << HALF) | b[over_b[together]]
        n_links = np.bincount(owner[over_a[together]], minlength=len(pieces))
        first = np.append(True, group[1:] != group[:-1]) if len(group) else np.empty(0, bool)
        n_groups = np.bincount(piece[order[first]], minlength=len(pieces))
        n_over = np.bincount(owner[over_a], minlength=len(pieces))

        self.texts.extend(self._written(np.append(a, b), side, groups, piece, n_a + n_b))
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_over, n_links, lost], axis=1)])
        self.begins = np.append(self.begins, len(self.links) + np.cumsum(n_links) - n_links)
        self.links = np.append(self.links, links)

    @staticmethod
    def _written(ids: np.ndarray, side: np.ndarray, groups: np.ndarray, piece: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Groups of every piece as text: ids of A by commas, a bar, ids of B; groups by semicolons."""
        order = np.lexsort((side, groups))  # stable: tokens of a side stay in their order
        g, s, p = groups[order], side[order], piece[order]
        marks = np.full(len(order), ",")
        if len(order):
            marks[1:][s[1:] != s[:-1]] = "|"
            marks[1:][g[1:] != g[:-1]] = ";"
            marks[np.append(True, p[1:] != p[:-1])] = ""
        words = [m + w for m, w in zip(marks.tolist(), map(str, ids[order].tolist()), strict=True)]
        ends = np.cumsum(sizes)
        return ["".join(words[x:y]) for x, y in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]

    def slice(self, part) -> pa.RecordBatch:
        """One row of counts, groups and links per text of a slice; a space stands before every text."""
        if len(self.known) > REMEMBERED:
            self.forget()
        lengths = np.diff(part.offsets)
        here = np.flatnonzero(lengths)
        # a space before every text that isn't empty
        data = np.insert(part.data, part.offsets[:-1][here], 0x20)
        offsets = np.concatenate([[0], np.cumsum(lengths + (lengths > 0))])
        starts = self._cuts(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        number = self._numbers(data, starts, offsets, bounds)
        return self._rows(number, bounds)

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces: of texts, and spaces after something that isn't white space."""
        n = len(data)
        cut = np.zeros(n, bool)
        cut[1:] = (data[1:] == 0x20) & ~SPACES[data[:-1]]
        first = offsets[:-1][np.diff(offsets) > 0]
        cut[first] = True
        starts = np.flatnonzero(cut)
        raw = data.tobytes()
        if (data >= 0x80).any() and WIDE_SPACE.search(raw.decode()):  # white space beyond ASCII: such texts stay whole
            whole = np.array([bool(WIDE_SPACE.search(raw[x:y].decode())) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            owner = np.searchsorted(offsets, starts, "right") - 1
            starts = starts[np.isin(starts, first) | ~whole[owner]]
        return starts

    def _numbers(self, data: np.ndarray, starts: np.ndarray, offsets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The remembered number of every piece; new pieces are encoded together."""
        if not len(starts):
            return np.empty(0, np.int64)
        raw, ends = data.tobytes(), np.append(starts[1:], len(data))
        part = type("Line", (), {"data": data, "offsets": offsets})
        _, first, which = np.unique(word_hashes(part, Words(starts, ends, bounds), lower=False), return_index=True, return_inverse=True)
        pieces = [raw[x:y] for x, y in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        new = [p for p in pieces if p not in self.known]
        for at in range(0, len(new), ENCODED_TOGETHER):
            self._learn(new[at : at + ENCODED_TOGETHER])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))[which]

    def _rows(self, number: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        sums = np.zeros((len(number) + 1, 6), np.int64)
        np.cumsum(self.counts[number], axis=0, out=sums[1:])
        counts = sums[bounds[1:]] - sums[bounds[:-1]]
        good = counts[:, 5] == 0
        counts[~good] = 0
        kept = number[np.repeat(good, np.diff(bounds))]
        n = self.counts[kept, 4]
        total = np.cumsum(n)
        links = self.links[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.begins[kept] - (total - n), n)]
        edges = np.append(0, np.cumsum(counts[:, 4])).astype(np.int32)
        names = number.tolist()
        texts = [
            ";".join([self.texts[i] for i in names[x:y]]) if ok else ""
            for x, y, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), good.tolist(), strict=True)
        ]
        columns = [*(pa.array(counts[:, i]) for i in range(5)), pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(edges), pa.array(links))]
        return pa.RecordBatch.from_arrays(columns, names=["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "groups", "links"])


@lru_cache(maxsize=1)
def aligner_of(a: bytes, b: bytes) -> Aligner:
    """One aligner per worker, which outlives its tasks with the pieces it has seen."""
    return Aligner(a, b)


SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_overlaps bigint, n_links bigint, groups string, links array<bigint>"


def aligned(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """One row per document: numbers of tokens, groups, overlapping pairs and links; ``groups`` as text and the links.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of A, a bar, ids of B, groups by semicolons, in order. ``links`` holds, in order,
    the id of A times 2^32 plus the id of B (``pairs`` takes them apart). No shuffle.

    A null or empty text, or one that a vocabulary can't give back byte by byte, has zeros, an empty string and no links.
    A null doc_id stays null; repeated rows are returned as often as they occur; an empty table gives no rows; other
    columns are ignored. The files are read by the driver and broadcast (2 MB).
    """
    files = []
    for path in (vocabulary_a, vocabulary_b):
        with open(path, "rb") as file:
            files.append(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*shared.value)
        for batch in batches:
            for part in text_slices(batch.column(1), SLICE_BYTES):
                rows = aligner.slice(part)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([ids, *rows.columns], names=["doc_id", *rows.schema.names])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def pairs(rows: DataFrame) -> DataFrame:
    """(link, id_a, id_b, n, best): every linked id pair, how many links hold it, and whether no pair of its B id has more."""
    found = rows.select(F.explode("links").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    found = found.select("link", F.shiftright("link", HALF).alias("id_a"), F.col("link").bitwiseAND((1 << HALF) - 1).alias("id_b"), "n")
    return found.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("id_b")))


def weighed(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """Replaces ``links`` by n_best (links whose pair is a best one of its B id) and count_sum (of the pairs' counts).

    ``counted`` are the ``pairs`` of a corpus that holds the rows; the vocabularies bound its size, so it is broadcast.
    """
    table = counted.select("link", "n", "best").orderBy("link").toArrow()
    keys, counts, best = (np.asarray(table.column(c).combine_chunks().to_numpy(zero_copy_only=False)) for c in ("link", "n", "best"))
    shared = rows.sparkSession.sparkContext.broadcast((keys, counts.astype(np.int64), best.astype(np.int64)))
    others = [f for f in rows.schema.fields if f.name != "links"]
    at = rows.columns.index("links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shared.value
        for batch in batches:
            lists = batch.column(at)
            where = np.searchsorted(keys, lists.flatten().to_numpy(zero_copy_only=False))
            edges = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            sums = [np.append(0, np.cumsum(x[where]))[edges] for x in (best, counts)]
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(np.diff(x)) for x in sums]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in others] + ["n_best", "count_sum"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(run, f"{ddl}, n_best bigint, count_sum bigint")


def alignment(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps.

    Counts of pairs are taken over all rows of ``docs``, repeated ones included. ``groups_sha256`` is empty for a document
    without tokens. Null, empty and repeated input as in ``aligned``.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = aligned(docs, vocabulary_a, vocabulary_b).withColumn("groups_sha256", digest).drop("groups")
    rows = materialise(rows, "aligned")
    return weighed(rows, pairs(rows)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )
