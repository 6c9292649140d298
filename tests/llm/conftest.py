import random
import re

import pytest

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def not_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def invented(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary):x}é" if rng.random() < 0.1 else f"W{rng.randrange(vocabulary)}" for _ in range(words))


#: Besides the table's own columns, names that operators use for theirs.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id bigint, "
    "k bigint, g bigint, shard int, slot bigint, n_words bigint, bucket bigint, c0 string, items_ string"
)


def rows():
    """Copies, near copies, shared passages, one very long text, empty and null texts, a repeated row, and null values."""
    rng = random.Random(7)
    texts = [invented(rng, rng.randrange(1, 160), 5000) for _ in range(60)]
    texts += [texts[3]] * 4
    base = invented(rng, 200, 50_000).split(" ")
    for edits in (0, 1, 2, 3, 4, 5, 6, 8, 12, 20):
        near = base[:]
        for at in rng.sample(range(len(near)), edits):
            near[at] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    passage = invented(rng, 40, 50_000)
    texts += [invented(rng, 30, 5000) + "\n" + passage + " " + invented(rng, 10, 5000) for _ in range(8)]
    texts += ["a b c", "a b c", "A B\tC", "same " * 90, "same " * 95, "x", "", None, " \t\n ", invented(rng, 20_000, 10**6)]
    out = [(i * 3, t, "en" if i % 4 else None, "big" if i % 3 else f"s{i % 5}", None if i % 7 == 0 else len(t or "")) for i, t in enumerate(texts)]
    out.append(out[5])  # a repeated row
    out.append((None, texts[2], None, None, None))
    return [(*r, 0.5, 1, 2, 3, 4, 5, 6, 7, "x", "y") for r in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def plain():
    """(doc_id, text) of the same rows."""
    return [(r[0], r[1]) for r in rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
