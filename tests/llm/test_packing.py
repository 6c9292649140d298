"""Packed token rows: exact round trip, and the packing itself."""

import random

import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import packing
from larder.llm.words import text_slices


@pytest.fixture(scope="module")
def whole():
    ranks = packing.read_vocabulary(packing.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.read_vocabulary(packing.VOCABULARY))


ALPHABET = "abAB 12\t\n\r.,'é日　\xa0 \x85\x1c😀"


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(ALPHABET, max_size=30), max_size=6))
def test_encoder_equals_whole_text(encoder, whole, texts):
    for part in text_slices(pa.array(texts, pa.string())):
        ids, bounds = encoder.slice(part)
        for d in range(len(part)):
            assert ids[bounds[d] : bounds[d + 1]].tolist() == whole.encode_ordinary(texts[part.first + d])


@settings(max_examples=100, deadline=None)
@given(sizes=st.lists(st.integers(0, 50), max_size=60), row=st.integers(1, 16))
def test_pack_is_lossless_best_fit(sizes, row):
    rows = packing.pack(sizes, row)
    seen = sorted((s.doc, s.start, s.size) for r in rows for s in r)
    for doc, size in enumerate(sizes):
        parts = [(a, n) for d, a, n in seen if d == doc]
        assert sum(n for _, n in parts) == size and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    assert all(sum(s.size for s in r) <= row for r in rows)
    # brute force: rests, longest first, each into the fullest row that holds it
    room = []
    for size in sorted((s % row for s in sizes if s % row), reverse=True):
        fits = [r for r in room if r >= size]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - size)
        else:
            room.append(row - size)
    assert len(rows) == sum(s // row for s in sizes) + len(room)


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 500])
def test_round_trip(docs, plain, whole, block, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    named = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.packed(named, row_tokens=64)
    back = {r.doc_id: r.ids for r in packing.restored(rows).collect()}
    assert back == {d: [*whole.encode_ordinary(t or ""), packing.END] for d, t in plain if d is not None}
    for r in rows.collect():
        assert len(r.ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.position_resets == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.doc_starts) == len(r.position_resets)
        assert set(r.ids[r.n_tokens :]) <= {packing.END}


def test_repeated_null_and_empty(docs, plain, empty):
    rows = packing.packed(docs, row_tokens=64).collect()
    starts = sorted((d is None, d or 0) for r in rows for d, s in zip(r.doc_ids, r.doc_starts, strict=True) if s == 0)
    assert starts == sorted((d is None, d or 0) for d, _ in plain)
    assert packing.packed(empty).collect() == []


def test_rows_are_well_filled(spark):
    rng = random.Random(1)
    texts = [(i, "word " * rng.randrange(1, 900)) for i in range(400)]
    rows = packing.packed(spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1), row_tokens=512).collect()
    assert sum(r.n_tokens for r in rows) / (512 * len(rows)) > 0.97
