"""Phrases from a table against a walk over the tokens."""

import random
import re
from collections import Counter

from larder.operators import categorise, phrases

WORDS = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def brute(rows, lexicon):
    wanted = {tuple(WORDS.findall(p.lower())) for p in lexicon if p} - {()}
    out = Counter()
    for key, text in rows:
        w = WORDS.findall((text or "").lower())
        for n in {len(p) for p in wanted}:
            out.update((key, " ".join(w[i : i + n])) for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wanted)
    return {(k, p, n) for (k, p), n in out.items()}


def test_phrase_hits(spark):
    rng = random.Random(5)
    rows = [(i % 90, " ".join(rng.choice("red Blue green low-fat milk the of").lower() if rng.random() < 0.01 else rng.choice(["Red", "blue", "green", "low-fat", "milk", "of"]) for _ in range(rng.randrange(0, 40)))) for i in range(100)]
    rows += [(200, None), (201, ""), (None, "red blue red blue red")]
    lexicon = ["red", "Red  Blue!", "red blue red", "low-fat milk", "of of of of", "missing words", "", None, "red blue", "milk"]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    table = spark.createDataFrame([(p, 1) for p in lexicon], "phrase string, w int")
    assert {tuple(r) for r in phrases.phrase_hits(docs, "id", "text", table).collect()} == brute(rows, lexicon)
    keyed = docs.where("id >= 200")
    assert {tuple(r) for r in phrases.phrase_bonus(keyed, "id", "text", table).collect()} == {(200, 0.0), (201, 0.0)}
    assert phrases.phrase_hits(docs, "id", "text", table.limit(0)).collect() == []
    assert phrases.phrase_hits(docs.limit(0), "id", "text", table).collect() == []


def test_category_lexicon(spark):
    df = spark.createDataFrame([("fruit", "Red apple"), ("fruit", "green APPLE"), (None, "x"), ("empty", None)], "kind string, name string")
    got = sorted(tuple(r) for r in categorise.category_lexicon(df, "kind", "name").collect())
    assert got == [("fruit", "apple"), ("fruit", "green"), ("fruit", "red")]
