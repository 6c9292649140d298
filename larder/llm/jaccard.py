"""N-gram Jaccard join by token-combination prefixes.

Tokens are a document's distinct word shingles. The plan keeps every link and never pairs a whole group:

1. Documents with equal shingle sets form a class; the smallest id stands for it.
2. All tokens of all documents meet in hash buckets (packed arrays, see ``exchange``). A token that only one document has
   can't be shared, so each document gets back the tokens that it may share. If these are fewer than the least overlap
   of any link, the document has no link and leaves; this holds for most texts.
3. For the rest, tokens are ordered by their frequency among these documents, rare ones first (unshared ones before all).
   Two sets with overlap o share at least 2 tokens among the first n - o + 2 of each (the prefix extended by one). Rare
   tokens in it are keys by themselves. Two documents without a shared rare token share two frequent ones, so frequent
   tokens are keys as combinations of two, which are far more selective. Sets above ``COMBINED`` tokens also
   index frequent tokens singly, since their combinations would grow with the square of the prefix; sets up to
   COMBINED / t index both ways, so that sets of linkable sizes always share a kind of key.
4. Each key's member with the least distance from the front of its order is its leader. All members are verified against
   the leader first; linked groups, however large, so become one component with as many checks as members.
5. Only pairs in different components that the size and position bounds allow are then verified, for every key.

Verification compares whole sets: unshared tokens only count towards the sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import exchange
from larder.llm.graph import components
from larder.llm.words import NOT_SPACE, Texts, find_words, mix, text_slices, window_hashes, word_hashes
from larder.session import materialise

SHINGLE = 4
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A token in at most this many candidate documents is rare.
RARE = 32
#: Tokens are hashes of 56 bits; the empty low byte costs nothing in a shuffle. Two texts of 10,000 tokens have a false
#: common one with a chance of one in a billion.
TOKEN_BITS = ~np.uint64(0xFF)
#: Keys from here on stand for texts that their id doesn't name, spread by hash; an id among them is taken as it is.
LOST = exchange.NO_ID - (1 << 52)
#: Largest set whose frequent prefix tokens are indexed only as combinations of two.
COMBINED = 300


def keyed(docs: DataFrame, id_col: str = "doc_id", row: bool = False) -> DataFrame:
    """(doc_id, text, k), with all columns as ``row`` if asked for: ``k`` is one per id and text.

    It is the id, or a hash of id and text for texts without an id and for those whose id another text has too (all but the
    one with the least hash). Ids with several texts are found by one aggregate over ids and text hashes.
    """
    text = F.coalesce("text", F.lit(""))
    own = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if row else []
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), *own)
    several = rows.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("doc_id IS NOT NULL AND low < high")
    several = materialise(several.select(F.col("doc_id").alias("id"), "low"), "ids-of-several-texts")
    placed = rows.join(several, F.col("doc_id") == F.col("id"), "left")
    hashed = F.lit(LOST) + F.xxhash64("h", "doc_id").bitwiseAND((1 << 52) - 1)
    k = F.when(F.col("doc_id").isNull() | (F.col("low") != F.col("h")), hashed).otherwise(F.col("doc_id"))
    return placed.select("doc_id", "text", k.alias("k"), *(["row"] if row else []))


def shingle_sets(part: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, document) pairs in document order, tokens ascending, distinct; and the set size per document.

    A document with fewer words than ``size`` has one token for its whole sequence, one without words has none.
    """
    words = find_words(part, NOT_SPACE)
    hashes = word_hashes(part, words, lower=True)
    keys, starts = window_hashes(hashes, words, size)
    docs = np.searchsorted(words.bounds, starts, "right") - 1
    counts = words.counts()
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        rows = np.zeros(len(short), np.uint64)
        for j in range(n):
            rows = mix(rows * np.uint64(31) + hashes[words.bounds[short] + j] + np.uint64(n))
        keys, docs = np.append(keys, rows), np.append(docs, short)
    keys &= TOKEN_BITS
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[new], docs[new]
    return keys, docs, np.bincount(docs, minlength=len(part))


def _signatures(keys: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128-bit hash of each document's sorted tokens."""
    raw = keys.astype("<u8").tobytes()
    edges = np.concatenate([[0], np.cumsum(sizes)]) * 8
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def set_classes(keyed: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, k, rep): ``rep`` is the smallest key of the documents with the same non-empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                keys, _, sizes = shingle_sets(part, size)
                own = [batch.column(c).slice(part.first, len(part)) for c in (0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [own[0], pa.array(sizes), own[1], pa.array(_signatures(keys, sizes), pa.binary())],
                    names=["doc_id", "n_shingles", "k", "sig"],
                )

    rows = keyed.select("doc_id", "text", "k")
    signed = materialise(rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, k bigint, sig binary"), "signatures")
    # written first, so that the join deals out both sides itself and can split a class with very many copies
    classes = materialise(signed.where("n_shingles > 0").groupBy("sig").agg(F.min("k").alias("rep")), "representatives")
    return materialise(signed.join(classes, "sig", "left").select("doc_id", "n_shingles", "k", "rep"), "classes")


def _send(ids: np.ndarray, keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows of one chunk: every distinct token once; tokens of several documents are known to be shared.

    A token that needs no answer goes with an id one below the smallest of the chunk.
    """
    order = np.argsort(keys, kind="stable")
    ids, keys = ids[order], keys[order]
    first = np.append(True, keys[1:] != keys[:-1])
    group = np.cumsum(first) - 1
    many = np.bincount(group) > 1
    direct = exchange.answers(ids[many[group]], keys[many[group]], bits)
    offset = int(ids.min()) - 1
    return exchange.sent_rows(np.where(many, offset, ids[first]), keys[first], offset, direct, bits)


def shared_tokens(keyed: DataFrame, bits: int, size: int = SHINGLE) -> DataFrame:
    """Packed (document, token) pairs whose token another document has too, by document group.

    Of the equal sets in a chunk only the smallest ids so far go on, which always include the class's representative.
    """

    chunk_keys = exchange.CHUNK_KEYS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held, seen = [], [], 0, {}
        for batch in batches:
            doc_ids = batch.column(0).to_numpy()
            for part in text_slices(batch.column(1)):
                tokens, owner, sizes = shingle_sets(part, size)
                own = doc_ids[part.first : part.first + len(part)]
                keep = np.zeros(len(part), bool)
                for d, sig in enumerate(_signatures(tokens, sizes)):
                    if own[d] < seen.get(sig, exchange.NO_ID + 1):
                        seen[sig], keep[d] = own[d], True
                ids.append(own[owner][keep[owner]])
                keys.append(tokens[keep[owner]])
                held += len(keys[-1])
                if held >= chunk_keys:
                    yield _send(np.concatenate(ids), np.concatenate(keys), bits)
                    ids, keys, held, seen = [], [], 0, {}
        if held:
            yield _send(np.concatenate(ids), np.concatenate(keys), bits)

    def merge(table: pa.Table) -> pa.Table:
        known = exchange.pass_direct(table, bits)
        if known is not None:
            return known
        nothing = np.repeat(table.column("base").to_numpy(), [len(x.as_buffer()) // 8 for c in table.column("keys").chunks for x in c])
        ids, keys = exchange.unpack(table)
        order = np.argsort(keys, kind="stable")
        ids, keys, nothing = ids[order], keys[order], nothing[order]
        group = np.cumsum(np.append(True, keys[1:] != keys[:-1])) - 1
        answer = (np.bincount(group) > 1)[group] & (ids != nothing)
        return exchange.answer_table(exchange.answers(ids[answer], keys[answer], bits))

    return keyed.select("k", "text").mapInArrow(send, exchange.SENT).groupBy("bucket").applyInArrow(merge, exchange.ANSWERS)


def least_overlap(n: Column, percent: int) -> Column:
    """Smallest overlap that a set of ``n`` tokens has with any set it links to: ceil(percent * n / 100)."""
    return F.floor((n * percent + 99) / 100).cast("bigint")


def candidates(keyed: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(k, n, list): class representatives that may have a link, with their shared tokens as (frequency, token), rare first."""
    bits = exchange.bucket_bits(keyed)
    sizes = classes.where(F.col("k") == F.col("rep")).groupBy("k").agg(F.max("n_shingles").alias("n"))
    sizes = sizes.withColumn("g", exchange.group_of(F.col("k"), bits))

    def collect(owners: pa.Table, packed: pa.Table) -> pa.Table:
        """The documents of a group that share enough tokens, with those tokens."""
        ids, keys = exchange.unpack(packed)
        order = np.lexsort((keys, ids))
        ids, keys = ids[order], keys[order]
        new = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))[: len(ids)]
        ids, keys = ids[new], keys[new]
        k, n = owners.column("k").to_numpy(), owners.column("n").to_numpy()
        low, high = np.searchsorted(ids, k), np.searchsorted(ids, k, "right")
        enough = np.flatnonzero(high - low >= (n * percent + 99) // 100)
        tokens = [keys[low[i] : high[i]].view(np.int64) for i in enough.tolist()]
        return pa.table([pa.array(k[enough]), pa.array(n[enough]), pa.array(tokens, pa.list_(pa.int64()))], names=["k", "n", "tokens"])

    packed = shared_tokens(keyed, bits, size)
    some = sizes.groupBy("g").cogroup(packed.groupBy("g")).applyInArrow(collect, "k bigint, n bigint, tokens array<bigint>")
    some = materialise(some, "shared-tokens")
    rows = some.select("k", F.explode("tokens").alias("t"))
    counts = rows.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = rows.join(counts, "t").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("list"))
    lists = lists.join(some.select("k", "n"), "k").select("k", "n", "list")
    return materialise(lists.where(F.size("list") >= least_overlap(F.col("n"), percent)), "candidates")


def postings(sets: DataFrame, percent: int, rare: int, combined: int) -> DataFrame:
    """(key, k, n, pos): a document's index keys; ``pos`` tokens stand before the key's first token in its order."""
    unshared = F.col("n") - F.size("list")
    reach = F.col("n") - least_overlap(F.col("n"), percent) + 2 - unshared
    heads = sets.withColumns({"u": unshared, "head": F.slice("list", 1, F.greatest(reach, F.lit(0)).cast("int"))})
    heads = heads.select("k", "n", "u", F.posexplode("head").alias("i", "x"), "head")
    frequent = F.col("x.df") > rare
    alone = heads.where(~frequent | (F.col("n") > combined)).select(F.col("x.t").alias("key"), "k", "n", (F.col("u") + F.col("i")).alias("pos"))
    both = heads.where(frequent & (F.col("n") * percent <= combined * 100))
    later = F.slice("head", F.col("i") + 2, F.size("head"))
    pairs = both.select("k", "n", (F.col("u") + F.col("i")).alias("pos"), F.col("x.t").alias("t"), F.explode(later).alias("y"))
    pairs = pairs.select(F.xxhash64("t", "y.t").alias("key"), "k", "n", "pos")
    return alone.unionByName(pairs)


def possible(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """Can sets of these sizes link if no earlier token is shared? The overlap is at most what follows in either."""
    return F.least(n1 - pos1, n2 - pos2) * (100 + percent) >= (n1 + n2) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    plain = sets.select("k", "n", F.transform("list", lambda x: x["t"]).alias("tokens"))
    left = plain.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = plain.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    linked = both * 100 >= (F.col("na") + F.col("nb") - both) * percent
    return pairs.join(left, "a").join(right, "b").where(linked).select("a", "b")


def links(sets: DataFrame, percent: int = PERCENT, rare: int = RARE, combined: int = COMBINED) -> DataFrame:
    """(node, component) of the candidate sets that have a link to a different set."""
    posted = materialise(postings(sets, percent, rare, combined), "postings")
    heads = posted.groupBy("key").agg(F.min(F.struct("pos", "k", "n")).alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1")
    posted = materialise(posted.join(heads.drop("m"), "key"), "led-postings")
    stars = posted.where((F.col("k") != F.col("lead.k")) & possible(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), percent))
    stars = stars.select(F.least("k", "lead.k").alias("a"), F.greatest("k", "lead.k").alias("b")).distinct()
    first = materialise(verified(stars, sets, percent), "star-links")
    groups = components(first)
    placed = posted.drop("lead").join(groups, posted["k"] == groups["node"], "left").drop("node")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "k")), "placed-postings")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    placed = placed.join(mixed, "key", "left_semi")
    x, y = placed.alias("x"), placed.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.k") < F.col("y.k")) & (F.col("x.component") != F.col("y.component"))
    allowed = possible(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)
    rest = x.join(y, apart & allowed).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
    second = verified(rest, sets, percent)
    return components(first.unionByName(second))


def placed_documents(keyed: DataFrame, size: int, percent: int, rare: int, combined: int) -> DataFrame:
    """(doc_id, k, n_shingles, component_id, first): component and the key that stands for it, per row of ``keyed``.

    The first is that of the smallest id, null ones last.
    """
    classes = set_classes(keyed, size)
    found = links(candidates(keyed, classes, size, percent), percent, rare, combined)
    joined = classes.join(found, classes["rep"] == found["node"], "left")
    root = F.coalesce("component", "rep", "k")
    joined = materialise(joined.select("doc_id", "n_shingles", "k", root.alias("root")), "roots")
    least = joined.groupBy(F.col("root").alias("of")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "k")).alias("first"))
    least = materialise(least, "components")
    return joined.join(least, F.col("root") == F.col("of")).select("doc_id", "k", "n_shingles", F.col("first.doc_id").alias("component_id"), F.col("first.k").alias("first"))


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, rare: int = RARE, combined: int = COMBINED, id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A null or empty text has an empty set and links with nothing.
    A document is an id with a text: rows that share both are one document, each with its row; different texts of one id,
    or without an id, are different documents. The component of a document is the smallest id it reaches, null if none of
    them has one. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    found = placed_documents(keyed(docs, id_col), size, percent, rare, combined)
    return found.select("doc_id", "n_shingles", "component_id")


def first_documents(docs: DataFrame, size: int, percent: int, id_col: str = "doc_id") -> DataFrame:
    """One row of each component of ``near_duplicates``, all columns unchanged: that of the smallest id, null ones last.

    Of rows that share id and text one stays.
    """
    rows = keyed(docs, id_col, row=True)
    found = placed_documents(rows, size, percent, RARE, COMBINED).where("k = first")
    found = materialise(found.groupBy("k").agg(F.count(F.lit(1)).alias("times")), "first-documents")
    kept = rows.join(found, "k").select("k", "times", "row")
    # only repeated rows are brought together; the others aren't moved for it
    repeated = kept.where("times > 1").dropDuplicates(["k"])
    return kept.where("times = 1").unionByName(repeated).select("row.*")
