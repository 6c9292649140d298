"""Alignment of two vocabularies against whole texts encoded one by one and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import align
from larder.llm.words import text_slices


def read(path):
    with open(path, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def whole():
    a = Tokenizer.from_file(align.VOCABULARY_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=align.VOCABULARY_B)
    table = align.byte_of_character()
    names = [a.id_to_token(i) for i in range(a.get_vocab_size())]
    return a, b, [bytes(table[c] for c in t) for t in names], align.token_bytes_b(b)


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(read(align.VOCABULARY_A), read(align.VOCABULARY_B))


def one(text, whole):
    """(ids of A, ids of B, [(As, Bs)], [(a, b)], overlaps) of one text by loops over its bytes."""
    a, b, bytes_a, bytes_b = whole
    none = [], [], [], [], 0
    if not text:
        return none
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = (" " + text).encode()
    if any(b"".join(t[i] for i in x) != raw for x, t in zip(ids, (bytes_a, bytes_b), strict=True)):
        return none
    spans = []
    for x, table in zip(ids, (bytes_a, bytes_b), strict=True):
        at, out = 0, []
        for i in x:
            out.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(out)
    cuts = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
    sides = []
    for side in spans:
        cut, now = [], []
        for _, e, i in side:
            now.append(i)
            if e in cuts:
                cut.append(now)
                now = []
        sides.append(cut)
    groups = list(zip(*sides, strict=True))
    over, near = [], 0
    for x in spans[0]:
        while spans[1][near][1] <= x[0]:
            near += 1
        at = near
        while at < len(spans[1]) and spans[1][at][0] < x[1]:
            over.append((x, spans[1][at]))
            at += 1
    return *ids, groups, [(x[2], y[2]) for x, y in over if x[1] == y[1]], len(over)


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ALPHABET = "abAB 12\t\n\r.,'éß日　\xa0 \x85\x1c😀▁<>|\x00"
SOME = ["<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "  two   spaces \n\n next", "x", " ", "the thed;\r\n\r\n'll é́ ﬁ 日本語", "word " * 300]


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(ALPHABET, max_size=30) | st.sampled_from(SOME), max_size=5))
def test_slices_equal_whole_texts(aligner, whole, texts):
    for part in text_slices(pa.array(texts, pa.string())):
        for d, row in enumerate(aligner.slice(part).to_pylist()):
            a, b, groups, links, over = one(texts[part.first + d], whole)
            assert (row["n_a"], row["n_b"], row["n_groups"], row["n_overlaps"]) == (len(a), len(b), len(groups), over)
            assert row["groups"] == written(groups)
            assert [(x >> 32, x & 0xFFFFFFFF) for x in row["links"]] == links


def brute(rows, whole):
    found = [one(t, whole) for _, t in rows]
    n = Counter(link for *_, links, _ in found for link in links)
    most = {}
    for (_, b), count in n.items():
        most[b] = max(most.get(b, 0), count)
    out = []
    for (doc, _), (a, b, groups, links, over) in zip(rows, found, strict=True):
        sha = hashlib.sha256(written(groups).encode()).hexdigest() if a else ""
        best = sum(n[x] == most[x[1]] for x in links)
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(n[x] for x in links), sha, over))
    return sorted(out, key=str)


def test_query_equals_brute_force(docs, plain, whole):
    assert sorted((tuple(r) for r in align.alignment(docs).collect()), key=str) == brute(plain, whole)


def test_given_table(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in align.alignment(docs).collect()), key=str)
    assert got == brute(rows, whole)


def test_odd_texts_and_small_memory(spark, whole, monkeypatch):
    rows = [(i, t) for i, t in enumerate([*SOME, None, "", *SOME, "a   b c"])]
    rows.append((None, "x y"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute(rows, whole)
    for remembered, together in ((0, 1), (align.REMEMBERED, align.ENCODED_TOGETHER)):
        monkeypatch.setattr(align, "REMEMBERED", remembered)
        monkeypatch.setattr(align, "ENCODED_TOGETHER", together)
        assert sorted((tuple(r) for r in align.alignment(docs).collect()), key=str) == expected
    lost = next(r for r in align.alignment(docs).collect() if r.doc_id == 1)
    assert (lost.n_a, lost.n_b, lost.n_links, lost.groups_sha256) == (0, 0, 0, "")


def test_empty_table(empty):
    assert align.alignment(empty).collect() == []


def test_groups_break_where_nothing_reaches():
    starts, ends = np.array([0, 2, 3, 0, 1, 3]), np.array([2, 3, 5, 1, 3, 5])
    order, group = align.coalesced(starts, ends, np.array([0, 0, 0, 1, 1, 1]))
    assert [group[order.tolist().index(i)] for i in range(6)] == [0, 0, 1, 0, 0, 1]


def test_linked_pairs_are_bounded_by_the_vocabularies(docs, whole):
    """One token of a linked pair ends with the other's bytes, which bounds the broadcast table."""
    _, _, bytes_a, bytes_b = whole
    for r in align.pairs(align.aligned(docs)).collect():
        a, b = bytes_a[r.id_a], bytes_b[r.id_b]
        assert a.endswith(b) or b.endswith(a)
