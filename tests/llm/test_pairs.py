"""Near duplicates, repeated windows and benchmark windows against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from larder.llm import decontaminate, exchange, graph, jaccard, repeats

from .conftest import LOWER, alnum, invented, not_space

LAST = 1 << 62


def brute_components(plain, size=4, percent=85):
    def shingles(text):
        w = not_space((text or "").translate(LOWER))
        return frozenset(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])

    sets = {LAST if d is None else d: shingles(t) for d, t in plain}
    owners = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            owners[x].append(d)
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in owners[x] if e < d).items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                up[b] = a
    out = []
    for d, _ in plain:
        key = LAST if d is None else d
        out.append((d, len(sets[key]), None if find(key) == LAST else find(key)))
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_near_duplicates(docs, plain):
    want = brute_components(plain)
    assert sum(a != c for a, _, c in want) > 8
    for rare, combined in ((32, 300), (1, 150), (1, 20)):
        got = jaccard.near_duplicates(docs, rare=rare, combined=combined).collect()
        assert same(got, want)


def test_small_chunks(docs, plain, monkeypatch):
    """Tasks that deal out their keys many times, and many buckets, give the same."""
    monkeypatch.setattr(exchange, "CHUNK_KEYS", 700)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 4000)
    whole = docs.coalesce(1)
    assert exchange.bucket_bits(whole) > 4
    assert same(jaccard.near_duplicates(whole).collect(), brute_components(plain))
    assert same(repeats.remove_repeats(whole).collect(), brute_repeats(plain))


def test_near_duplicates_other_sizes(docs, plain):
    assert same(jaccard.near_duplicates(docs, size=2, percent=60).collect(), brute_components(plain, 2, 60))


def test_chain_of_links(spark):
    """Neighbours link, the ends do not: one component through many links, and no member links with all others."""
    rng = random.Random(3)
    words = [f"t{i}" for i in range(400)]
    texts = [" ".join(words[i * 4 : i * 4 + 200]) for i in range(40)] + [invented(rng, 50)]
    plain = list(enumerate(texts))
    df = spark.createDataFrame(plain, "doc_id bigint, text string")
    want = brute_components(plain)
    assert {c for _, _, c in want} == {0, 40}
    for rare in (32, 1):
        assert same(jaccard.near_duplicates(df, rare=rare).collect(), want)


def test_random_groups(spark):
    """Groups of copies with all degrees of editing, some beyond the threshold, that share most of their tokens."""
    rng = random.Random(11)
    plain = []
    for g in range(4):
        base = [f"g{g}x{i}" for i in range(rng.randrange(30, 90))]
        for _ in range(40):
            text = base[:]
            for at in rng.sample(range(len(text)), rng.randrange(0, 5)):
                text[at] = f"e{rng.randrange(3)}"
            plain.append((len(plain), " ".join(text)))
    df = spark.createDataFrame(plain, "doc_id bigint, text string")
    want = brute_components(plain)
    for rare, combined in ((32, 300), (2, 40)):
        assert same(jaccard.near_duplicates(df, rare=rare, combined=combined).collect(), want)


def test_texts_that_share_an_id(spark):
    """Different texts of one id have their own links; a component takes the smallest id of its members."""
    rng = random.Random(8)
    a, b, c = (invented(rng, 100, 50_000) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (1, a), (7, c), (7, c + " more"), (None, c + " other"), (8, ""), (8, "x")]
    df = spark.createDataFrame([(*r, "k", 1, "h") for r in rows], "doc_id bigint, text string, k string, row int, h string").repartition(3)
    got = jaccard.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 1), (1, 1), (7, 7), (7, 7), (None, 7), (8, 8), (8, 8)], key=str
    )
    kept = jaccard.first_documents(df, 4, 85)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) in (
        sorted([(1, a), (1, b), (7, t), (8, ""), (8, "x")]) for t in (c, c + " more")
    )
    assert jaccard.first_documents(df.limit(0), 4, 85).collect() == []


def test_different_texts_without_id(spark):
    """Each text without an id keeps its own links, whatever other such texts there are."""
    rng = random.Random(21)
    a, b, c, d = (invented(rng, n, 50_000) for n in (120, 60, 300, 90))
    rows = [(5, a), (8, b), (None, a + " more"), (None, b + " more"), (None, c), (None, c + " more"), (None, d), (None, ""), (9, "x")]
    rows += [(None, invented(rng, 40, 50_000)) for _ in range(30)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    # the same table with an id for every row; ids from 100 on are those that were null
    named = [(100 + i if d is None else d, t) for i, (d, t) in enumerate(rows)]
    want = [(None if d >= 100 else d, n, None if g >= 100 else g) for d, n, g in brute_components(named)]
    assert sorted(g for d, _, g in want if d is None and g is not None) == [5, 8]
    assert same(got, want)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (8, 9), (None, 3), *((20, i) for i in range(21, 60))]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 60)}}


def brute_repeats(plain, k=13):
    first = {}
    listed = [(LAST if d is None else d, d, not_space(t)) for d, t in plain]
    for key, _, w in listed:
        for j in range(len(w) - k + 1):
            x = tuple(w[j : j + k])
            first[x] = min(first.get(x, LAST), key)
    out = []
    for key, d, w in listed:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < key:
                gone[j : j + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_remove_repeats(docs, plain):
    want = brute_repeats(plain)
    assert sum(r[2] for r in want) > 1000
    assert same(repeats.remove_repeats(docs).collect(), want)


def test_removal_intervals(docs, plain):
    removed = {(d, n): None for d, _, n, _ in brute_repeats(plain)}
    for row in repeats.removal_intervals(docs).collect():
        assert (row.doc_id, sum(row.n_words)) in removed
        edges = list(zip(row.first_word, row.n_words, strict=True))
        assert all(a + n < b for (a, n), (b, _) in zip(edges, edges[1:], strict=False))  # maximal: runs don't touch


def brute_hits(plain, items, k=10):
    windows = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        for j in range(max(1, len(w) - k + 1)) if w else ():
            windows[tuple(w[j : j + k])].add(None if i is None else str(i))
    out = []
    for d, t in plain:
        w = alnum(t)
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (x := tuple(w[j : j + n])) in windows:
                    found |= windows[x]
                    hit[j : j + n] = [1] * n
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(x for x in found if x is not None)).encode()).hexdigest(), sum(hit) > 0))
    return out


def bench_items(plain):
    long = next(t for _, t in plain if t and len(t) > 50_000).split(" ")
    return [
        (1, " ".join(long[100:130])), (2, " ".join(long[120:150])), (3, "X"), (4, "a, b; C"), (5, ""), (6, None), (None, "a b"),
        (7, "same " * 12), (8, " ".join(long[500:509])), (9, " ".join(long[-10:])), (10, "not in any of the texts here at all"),
        (10, " ".join(long[700:712])), (10, " ".join(long[700:712])),
    ]


def test_contamination(spark, docs, plain):
    items = bench_items(plain)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_hits(plain, items)
    assert sum(r[5] for r in want) >= 6
    assert same(decontaminate.contamination(docs, table).collect(), want)
    clean = decontaminate.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, *_, bad in want if not bad)


def test_contamination_in_blocks(spark, docs, plain, monkeypatch):
    """Several blocks of items give what one block gives."""
    items = bench_items(plain)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", 40))
    assert len(list(decontaminate.blocks(table))) > 2
    assert same(decontaminate.contamination(docs, table).collect(), brute_hits(plain, items))


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "q a b c d e f r a b c"), (2, "a b x"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "z a b c d e y")], "item_id bigint, text string")
    got = sorted(map(tuple, decontaminate.longest_matches(docs, items, least=2).collect()))
    assert got == [(1, "7", 1, 1, 5), (1, "7", 8, 1, 3), (2, "7", 0, 1, 2)]


def test_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert jaccard.near_duplicates(empty).collect() == []
    assert repeats.remove_repeats(empty).collect() == []
    assert decontaminate.contamination(empty, items).collect() == []
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items).collect())


def test_items_without_an_id(spark):
    """A benchmark item without an id is searched like others; only its name is missing. Words are those of the search."""
    rng = random.Random(4)
    a, b = (invented(rng, 14, 50_000) for _ in range(2))
    docs = spark.createDataFrame([(1, a), (2, "x " + b), (3, a + " " + b), (4, "clean words")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, a), (None, a), (9, b)], "item_id bigint, text string")
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("", "9")]
    want = {1: (14, 1, sha[0]), 2: (14, 1, sha[1]), 3: (28, 2, sha[1]), 4: (0, 0, sha[0])}
    for limit in (decontaminate.BLOCK_WORDS, 10):
        decontaminate.BLOCK_WORDS, kept = limit, decontaminate.BLOCK_WORDS
        try:
            got = decontaminate.contamination(docs, items).collect()
            assert {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in got} == want
        finally:
            decontaminate.BLOCK_WORDS = kept
    assert [r.doc_id for r in decontaminate.clean_documents(docs, items).collect()] == [4]
    joined = spark.createDataFrame([("i", "-".join(str(i) for i in range(50)))], "item_id string, text string")
    assert [b.bounds.tolist() for b in decontaminate.blocks(joined.unionByName(joined.withColumn("item_id", F.lit("j"))), limit=60)] == [[0, 50]] * 2
