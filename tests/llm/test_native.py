"""Mixing, fingerprints, chat formatting and sharding, and that they stay free of Python workers."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import chat, chat_sql, layout, mixing, sketch

ROOT = "/root/testdata/sf0.001"


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not re.search("Python|Pandas|Arrow", plan)


def check_schedule(rows):
    """Windows are kept, slots have no gap, and each phase stays within one block of its weights."""
    assert all(r.release <= r.slot < r.deadline for r in rows)
    blocks = sorted({(r.slot, r.source, r.phase, r.weight) for r in rows}, key=lambda b: b[0])
    assert [b[0] for b in blocks] == list(range(len(blocks)))
    phases = defaultdict(list)
    for b in blocks:
        phases[b[2]].append(b)
    for served in phases.values():
        weights, counts = {b[1]: b[3] for b in served}, Counter()
        for t, b in enumerate(served, 1):
            counts[b[1]] += 1
            assert all(abs(counts[s] - w * t) < 1 for s, w in weights.items())


def test_mixing(docs):
    found = mixing.mixed(docs)
    assert no_python(found)
    rows = found.collect()
    assert len(rows) == docs.count()
    check_schedule(rows)
    assert Counter((r.doc_id, r.source) for r in rows) == Counter((r.doc_id, r.source) for r in docs.collect())


@pytest.mark.parametrize("shares", [{"a": 3, "b": 5, "c": 1}, {"a": 1}, {"b": 97, "c": 0}])
def test_mixing_targets(spark, shares):
    data = [(i, "a" if i % 2 else "b" if i % 5 else ("c" if i % 3 else None)) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id bigint, source string")
    targets = spark.createDataFrame(list(shares.items()), "source string, share bigint")
    rows = mixing.mixed(df, targets, block_rows=2).collect()
    assert len(rows) == 500
    check_schedule(rows)
    if shares == {"a": 3, "b": 5, "c": 1}:
        assert {(r.source, round(r.weight, 3)) for r in rows if r.phase == 0} == {("a", 0.3), ("b", 0.5), ("c", 0.1), (None, 0.1)}


def test_mixing_edges(spark, empty):
    assert mixing.mixed(empty).collect() == [] and mixing.interleave(empty).collect() == []
    rows = [(i, f"s{i % 3}", i, "a", "b", "c") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, place_ int, place_id_ string, place string, `a.b` string")
    mixed = mixing.interleave(df)
    assert mixed.columns == df.columns and sorted(tuple(r) for r in mixed.collect()) == rows


def test_mixing_any_number(spark):
    """Hundreds of sources, of very unlike sizes, and one with a third of the rows."""
    sizes = [1500, 400, 170, 90, 60] + [1 + i % 37 for i in range(620)]
    data = [(s * 10_000 + i, None if s == 3 else f"d{s}") for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(data, "doc_id bigint, source string").repartition(5)
    found = mixing.mixed(df, block_rows=2)
    assert no_python(found)
    rows = found.collect()
    assert Counter((r.doc_id, r.source) for r in rows) == Counter(data)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert {r.slot for r in rows} == set(range(sum(-(-n // 2) for n in sizes)))
    assert len({(r.slot, r.source, r.block) for r in rows}) == len({r.slot for r in rows})
    assert mixing.interleave(df).count() == len(data)


def test_mixing_phases(spark):
    """Phases against a walk frame by frame: full frames as long as all can serve them, then the frame that one can't."""
    for sources in ([(6, 3), (100, 3)], [(6, 3), (6, 3)], [(2, 2), (4, 2), (6, 2), (9, 2), (8, 1)], [(1, 4), (3, 1), (4, 1), (5, 1), (6, 1), (7, 2)]):
        left, want, t = list(sources), [], 0
        while left := [(b, s) for b, s in left if b > 0]:
            n = min(b // s for b, s in left)
            want += [(t, n)] if n else []
            left, t = [(b - n * s, s) for b, s in left], t + n
            if any(b > 0 for b, _ in left):
                want.append((t, 1))
                left, t = [(b - min(b, s), s) for b, s in left], t + 1
        df = spark.createDataFrame([(str(i), b, s) for i, (b, s) in enumerate(sources)], "source string, blocks bigint, share bigint")
        phases, _ = mixing.schedule(df)
        assert sorted((r.from_frame, r.frames) for r in phases.collect()) == want


def test_interleave(docs):
    mixed = mixing.interleave(docs, files=3)
    assert mixed.columns == docs.columns
    at = {}
    for r in mixing.mixed(docs).collect():
        at[r.doc_id] = min(at.get(r.doc_id, (1 << 60, 0)), (r.slot, r.offset))
    order = [at[r.doc_id] for r in mixed.collect()]
    assert order == sorted(order) and len(order) == docs.count()


def paragraphs(text, m):
    """Digests of the paragraphs at one in ``m`` pairs of words, by a walk over the words."""
    words = re.findall(r"[^ \n]+", text)
    out, now = set(), []
    for i, w in enumerate(words):
        now.append(w)
        pair = 0 if i == len(words) - 1 else xxhash.xxh64_intdigest(words[i + 1].encode(), xxhash.xxh64_intdigest(w.encode(), 42))
        if pair % m == 0:
            for at in range(0, len(now), 4 * m):
                h = 42
                for word in now[at : at + 4 * m]:
                    h = xxhash.xxh64_intdigest(word.encode(), h)
                out.add(h)
            now = []
    return out


def length_class(text):
    return 2 ** max(0, math.floor(math.log2(max(len(text), 30) / 30)))


def like(a, b):
    x, y = paragraphs(a, length_class(a)), paragraphs(b, length_class(b))
    return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0


def check_fingerprints(found, texts):
    """Every row against the texts in order; equal texts have equal fingerprints, stored ones the same likeness or none."""
    found = found.withColumn("stored", F.expr(sketch.stored_likeness("fingerprint", "edited_fingerprint")))
    rows = found.collect()
    assert len(rows) == len(texts)
    prints, wanted, got = defaultdict(set), [], []
    for i, (doc_id, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        wanted.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(like(text, edited), 9), round(like(text, after), 9)))
        prints[(doc_id, wanted[-1][2])] = {text, edited}
    for r in rows:
        got.append((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)))
        assert r.stored is None or r.stored == pytest.approx(r.near_edited)
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert sum(r.stored is not None for r in rows) > 0.9 * len(rows)
    return rows


def test_fingerprints(spark, monkeypatch):
    """Against sets of paragraphs, over several buckets of documents."""
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    for size in (sketch.BUCKET_BYTES, 20_000):
        monkeypatch.setattr(sketch, "BUCKET_BYTES", size)
        found = sketch.edited_fingerprints(docs)
        assert no_python(found)
        rows = check_fingerprints(found, texts)
    by_text = defaultdict(set)
    names = dict(texts)
    for r in rows:
        by_text[names[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values()) and len(by_text) < len(rows)


def test_fingerprint_edges(spark, docs, empty, plain, monkeypatch):
    assert sketch.edited_fingerprints(empty).collect() == []
    hashes = {t: h for t, h in docs.selectExpr("coalesce(text, '')", "xxhash64(coalesce(text, ''))").collect()}
    texts = sorted(((d, t or "") for d, t in plain), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    monkeypatch.setattr(sketch, "BUCKET_BYTES", 5_000)
    check_fingerprints(sketch.edited_fingerprints(docs), texts)
    one = spark.createDataFrame([(5, "only\none")], "doc_id bigint, text string")
    assert [r.near_next for r in sketch.edited_fingerprints(one).collect()] == [1.0]
    lost = spark.createDataFrame([(None, "a b"), (None, "c"), (None, None), (2**62, "x y z")], "doc_id bigint, text string")
    assert sorted(r.n_chars for r in sketch.edited_fingerprints(lost).collect()) == [0, 1, 3, 5]


def test_buckets_of_clustered_ids(spark, monkeypatch):
    """Ids in two far clusters and one outlier: no bucket gets more than its share."""
    monkeypatch.setattr(sketch, "BUCKET_BYTES", 2_000)
    ids = [*range(500), *range(2**50, 2**50 + 500), 2**62]
    rows = sketch.in_buckets(spark.createDataFrame([(i, "some text") for i in ids], "doc_id bigint, text string"))
    sizes = [r["count"] for r in rows.groupBy("bucket").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_cut_by_content(spark):
    """One word inserted near the start of a one-line text changes few paragraphs."""
    rng = random.Random(9)
    texts = [" ".join(f"v{rng.randrange(300)}" for _ in range(rng.randrange(30, 900))) for _ in range(30)]
    data = []
    for i, t in enumerate(texts):
        words = t.split(" ")
        data += [(2 * i, t), (2 * i + 1, " ".join([*words[:3], "inserted", *words[3:]]))]
    near = {r.doc_id: r.near_next for r in sketch.edited_fingerprints(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    copies = sorted(near[2 * i] for i in range(30))
    others = sorted(near[2 * i + 1] for i in range(30))
    assert copies[0] > 0.5 and copies[15] > 0.8 and others[-1] < 0.3
    odd = ["", " ", "\n\n", "  a  b\n\n c\n", "same " * 500, "x" * 3000, "é ü ß\n" * 40, *texts[:5]]
    df = spark.createDataFrame([(t,) for t in odd], "text string")
    df = df.selectExpr("text", f"transform(array({sketch.words('text', 'length(text)')}), t -> {sketch.runs('t')})[0] AS runs")
    for r in df.collect():
        assert [w for run in r.runs for w in run] == r.text.split() and all(r.runs)
        assert not r.text.startswith("same") or len(r.runs) > 1


def test_sketch_retries(spark):
    """Differences beyond the first sketch's size are recovered by larger ones."""
    sets = [(list(range(n)), list(range(n // 2, n + extra))) for n in (0, 4, 30, 90, 400) for extra in (0, 3, 200)]
    df = spark.createDataFrame(sets, "a array<bigint>, b array<bigint>")
    mixed = "transform({0}, v -> xxhash64(v))"
    df = df.selectExpr(f"{mixed.format('a')} a", f"{mixed.format('b')} b", "size(array_except(a, b)) + size(array_except(b, a)) want")
    first = f"transform(array(v.n), n -> aggregate(sequence(0, n - 1), 0, (t, g) -> t + {sketch.peeled(sketch.folded('v.sa', 'n'), sketch.folded('v.sb', 'n'))}))[0]"
    pair = "named_struct('a', a, 'b', b, 'n', least(size(sa), size(sb)), 'sa', sa, 'sb', sb)"
    df = df.selectExpr("*", f"{sketch.sketched('a')} sa", f"{sketch.sketched('b')} sb")
    row = df.selectExpr("want", f"transform(array({pair}), v -> {sketch.difference('v')})[0] got", f"transform(array({pair}), v -> {first})[0] first").collect()
    assert all(r.got == r.want for r in row)
    assert all(r.first in (None, r.want) for r in row)
    assert any(r.first is None for r in row) and any(r.first == r.want > 0 for r in row)


def test_chat_equals_sql(spark):
    found = chat.formatted(spark.read.parquet(f"{ROOT}/conversations.parquet"))
    assert no_python(found)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{ROOT}/conversations.parquet'")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, db.execute(chat_sql.FORMATTED).fetchall()))


def test_chat_faults(spark):
    calls = [
        (1, 1, "a", "search", '{"query": "é\\n", "limit": 3}', []),
        (1, 1, "b", "search", '{"limit": 2.5, "query": "x"}', ["a", "zz"]),
        (1, 2, "c", "search", '{"query": "x", "other": 1}', ["a", "b", "b"]),
        (1, 3, "a", "search", '{"query": "again"}', None),
        (1, 4, "d", "count", "not json \"", None),
        (1, 5, "e", "nothing", "{}", None),
        (1, 6, "p", "count", '{"words": 1}', ["q"]),
        (1, 6, "q", "count", '{"words": 1}', ["p"]),
        (1, 7, "r", "count", '{"words": 1}', ["p"]),
        (1, 8, None, "count", '{"words": 1}', None),
        (2, 1, "a", "count", None, None),
        (2, 2, "n", "count", '{"words": null}', None),
        (None, 1, "a", "count", '{"words": 1}', None),
        (3, 1, "t", "note", '{"text":"z","pinned":false}', None),
        (3, 1, "t", "note", '{"text":"z","pinned":false}', None),
    ]
    results = [(1, 2, "a", "r1"), (1, 5, "a", "r2"), (1, 0, "c", "early"), (1, 9, "zzz", None), (None, 1, "a", "x"), (3, 2, "t", "ok"), (3, 2, "t", "ok")]
    messages = [(1, 0, "user", 'say "hi"\n'), (1, None, None, None)]
    found = chat.format_messages(
        spark.createDataFrame(messages, "conv_id bigint, turn bigint, role string, text string"),
        spark.createDataFrame(calls, "conv_id bigint, turn bigint, call_id string, name string, arguments string, after array<string>"),
        spark.createDataFrame(results, "conv_id bigint, turn bigint, call_id string, text string"),
        chat.TOOLS,
    ).collect()
    assert len(found) == len(calls) + len(results) + len(messages)
    call = [(r.conv_id, r.turn, r.call_id, r.level, r.status) for r in found if r.kind == "call"]
    assert Counter(call) == Counter([
        (1, 1, "a", 0, "ok"), (1, 1, "b", 1, "invalid arguments"), (1, 2, "c", 2, "invalid arguments"), (1, 3, "a", 0, "repeated id"),
        (1, 4, "d", 0, "invalid arguments"), (1, 5, "e", 0, "invalid arguments"), (1, 6, "p", None, "cycle"), (1, 6, "q", None, "cycle"),
        (1, 7, "r", None, "cycle"), (1, 8, None, None, "no result"), (2, 1, "a", 0, "invalid arguments"), (2, 2, "n", 0, "invalid arguments"),
        (None, 1, "a", None, "no result"), (3, 1, "t", 0, "ok"), (3, 1, "t", 0, "ok"),
    ])
    result = Counter((r.conv_id, r.turn, r.call_id, r.linked_turn, r.status) for r in found if r.kind == "result")
    assert result == Counter([
        (1, 2, "a", 1, "ok"), (1, 5, "a", 1, "repeated result"), (1, 0, "c", 2, "before call"), (1, 9, "zzz", None, "no call"),
        (None, 1, "a", None, "no call"), (3, 2, "t", 1, "ok"), (3, 2, "t", 1, "ok"),
    ])
    for r in found:
        value = json.loads(r.json)
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(next(r.json for r in found if r.turn == 0 and r.kind == "message")) == {"content": 'say "hi"\n', "role": "user"}


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, json string")
    assert chat.formatted(none).collect() == []


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve(spark, n, bits):
    cells = [r.cell for r in layout.curve(spark.range(1), n, bits).orderBy("h").collect()]
    assert sorted(cells) == list(range(1 << n * bits))
    points = [[(c >> bits * i) & ((1 << bits) - 1) for i in range(n)] for c in cells]
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(points, points[1:], strict=False))


def test_shards(docs, plain, empty):
    found = layout.shards(docs, 7)
    assert no_python(found)
    rows = found.collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(plain) and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    raw = [(d, (t or "").encode()) for d, t in plain]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len(t) + 16, zlib.crc32(t)) for d, t in raw)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert layout.shards(empty).collect() == []


def test_whole_values_order_the_sources(spark):
    """Sources that begin alike are different levels of the curve."""
    rows = [(i, "x" * (i % 7), "en", f"https://site{i % 20:02d}.org") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    coded = layout.with_codes(df, {"source": "code"}).select("source", "code").distinct().collect()
    assert [r.source for r in sorted(coded, key=lambda r: r.code)] == sorted({r[3] for r in rows}) and len({r.code for r in coded}) == 20
    found = layout.shards(df, 20)
    assert no_python(found)
    spread = defaultdict(set)
    for r in found.collect():
        spread[r.shard].add(rows[r.doc_id][3])
    assert max(len(s) for s in spread.values()) <= 4


def test_more_shards_than_rows(spark):
    df = spark.createDataFrame([(i, "x", "en", "s") for i in range(5)], "doc_id bigint, text string, lang string, source string")
    rows = layout.shards(df, 40).collect()
    assert len({r.shard for r in rows}) == 5 and {r.slot for r in rows} == {0}


def test_shards_prune(spark):
    """A shard covers few sources and languages, unlike a shard of unordered documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = layout.shards(docs, 40).join(docs.select("doc_id", "source"), "doc_id")
    spread = defaultdict(set)
    for r in placed.collect():
        spread[r.shard].add(r.source)
    assert len(spread) == 40 and max(len(s) for s in spread.values()) <= 10


def test_write_shards(docs, tmp_path, spark):
    layout.write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and set(back.columns) == {*docs.columns, "shard_"}
