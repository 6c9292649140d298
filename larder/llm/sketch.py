"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame operations only.

A text is cut into paragraphs, the paragraphs are hashed to 64-bit digests, and the distinct digests are added to the cells
of a sketch: each to one cell in every third of it, with a count, an XOR of the digests and an XOR of check hashes. The
cells of two versions are subtracted, which removes what they share. Cells that hold a single digest are then peeled until
nothing is left, which recovers the differing digests. A sketch that is too small for the difference leaves cells over; it
is then built anew with more parts and so more cells, twice to 1,024 times as many.

Paragraphs are cut by content: after a pair of words whose hash says so, so that a word more or less changes the one or two
paragraphs around it and not all that follow. How often, follows the text's own length in powers of two, for some 5 to 10
paragraphs, and nothing else: a text is cut once, whatever it is compared with. The ends at one in 2 m pairs are among
those at one in m, so two like texts on different sides of a power of two still share about every second paragraph of the
longer kind; their likeness is lower by as much. Digests go to the parts of a sketch by hash; a sketch of 2n parts folds
into one of n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.bind import with_once
from larder.operators.ranks import with_bucket
from larder.session import materialise

#: Cells in a third of a part of a sketch: a power of two.
THIRD = 8
#: Digests per part of a text's own sketch at most.
PER_PART = 4
#: A failed pair is tried again with so many times the parts of the larger sketch.
GROWTH = (2, 8, 64, 1024)
#: Rounds of peeling at most; every round peels all cells that hold one digest.
ROUNDS = 12
#: Text bytes per bucket of consecutive documents, and buckets at most: with more text, buckets grow, and a task sorts with spilling.
BUCKET_BYTES = 1 << 20
MAX_BUCKETS = 1 << 16
#: Buckets of texts without an id, by hash.
LOST = 1 << 10


def run_words(n_chars: str) -> str:
    """SQL: the length class of a text of so many characters: one in so many pairs of words ends a paragraph."""
    return f"shiftleft(1, greatest(0, cast(floor(log2(greatest({n_chars}, 30) / 30)) as int)))"


def words(text: str, n_chars: str) -> str:
    """SQL: a text's words (blanks and line ends apart), the hash of each with the next (0 for the last), and its class."""
    hashes = "transform(w, (x, i) -> if(i = size(w) - 1, 0L, xxhash64(x, get(w, i + 1))))"
    found = f"transform(array(trim(BOTH ' \\n' FROM {text})), x -> if(x = '', cast(array() as array<string>), split(x, '[ \\n]+')))[0]"
    return f"transform(array({found}), w -> named_struct('w', w, 'h', {hashes}, 'm', {run_words(n_chars)}))[0]"


def runs(t: str) -> str:
    """SQL: the paragraphs of ``words`` in order, as arrays of words; the longest have 4 times as many words as the class."""
    ends = f"array_compact(transform({t}.h, (h, i) -> if((h & ({t}.m - 1)) = 0, i, null)))"
    run = f"slice({t}.w, p + 1, least(4 * {t}.m, e - p + 1))"
    cut = f"flatten(transform(b, (e, k) -> transform(sequence(if(k = 0, 0, b[k - 1] + 1), e, 4 * {t}.m), p -> {run})))"
    return f"transform(array({ends}), b -> {cut})[0]"


def digests(text: str, n_chars: str) -> str:
    """SQL: the distinct paragraph digests of a text."""
    return f"transform(array({words(text, n_chars)}), t -> array_distinct(transform({runs('t')}, r -> xxhash64(r))))[0]"


EMPTY = "named_struct('c', 0, 'k', 0L, 'x', 0L)"
#: SQL: the check hash of a digest; the part of a digest among ``n``.
CHECK = "(xxhash64({0}, 1) & 4294967295L)"
PART = "(shiftright({d}, 44) & ({n} - 1)) = {g}"


def cells(ds: str) -> str:
    """SQL: one part of the sketch of an array of digests: three thirds of cells."""
    add = f"named_struct('c', a.c + 1, 'k', a.k ^ d, 'x', a.x ^ {CHECK.format('d')})"
    mine = f"filter(ds, d -> (shiftright(d, s) & {THIRD - 1}L) = j)"
    each = f"transform(sequence(0L, {THIRD - 1}L), j -> aggregate({mine}, {EMPTY}, (a, d) -> {add}))"
    return f"transform(array({ds}), ds -> flatten(transform(array(0, 16, 32), s -> {each})))[0]"


def sketched(ds: str) -> str:
    """SQL: the parts of a sketch of an array of digests: a power of two."""
    parts = f"shiftleft(1, greatest(0, cast(ceil(log2(size({ds}) / {PER_PART})) as int)))"
    mine = f"filter({ds}, d -> {PART.format(d='d', n='n', g='g')})"
    return f"transform(array({parts}), n -> transform(sequence(0, n - 1), g -> {cells(mine)}))[0]"


def folded(parts: str, n: str) -> str:
    """SQL: part ``g`` of ``n`` of a sketch with as many parts or more."""
    both = "named_struct('c', p.c + q.c, 'k', p.k ^ q.k, 'x', p.x ^ q.x)"
    rest = f"sequence(1, size({parts}) div {n} - 1)"
    return f"if(size({parts}) = {n}, {parts}[g], aggregate({rest}, {parts}[g], (f, r) -> zip_with(f, {parts}[cast(g + r * {n} as int)], (p, q) -> {both})))"


def peeled(a: str, b: str) -> str:
    """SQL: how many digests two parts of sketches differ in; null if cells are left over."""
    minus = "named_struct('c', p.c - q.c, 'k', p.k ^ q.k, 'x', p.x ^ q.x)"
    pure = f"array_distinct(filter(s.cells, c -> abs(c.c) = 1 and {CHECK.format('c.k')} = c.x))"
    out = "named_struct('c', e.c - p.c, 'k', e.k ^ p.k, 'x', e.x ^ p.x)"
    here = f"cast(shiftright(p.k, z) & {THIRD - 1}L as int) = j"
    each = f"transform(slice(s.cells, t * {THIRD} + 1, {THIRD}), (c, j) -> aggregate(filter(pure, p -> {here}), c, (e, p) -> {out}))"
    rest = f"flatten(transform(array(0, 16, 32), (z, t) -> {each}))"
    step = f"transform(array({pure}), pure -> if(size(pure) = 0, named_struct('cells', s.cells, 'n', s.n, 'stop', true), named_struct('cells', {rest}, 'n', s.n + size(pure), 'stop', false)))[0]"
    done = "if(forall(s.cells, c -> c.c = 0 and c.k = 0L and c.x = 0L), s.n, null)"
    begin = f"named_struct('cells', zip_with({a}, {b}, (p, q) -> {minus}), 'n', 0, 'stop', false)"
    return f"aggregate(sequence(1, {ROUNDS}), {begin}, (s, round) -> if(s.stop, s, {step}), s -> {done})"


def difference(v: str) -> str:
    """SQL: how many digests differ between ``v.a`` and ``v.b``, by their sketches ``v.sa`` and ``v.sb``, part by part.

    A pair that isn't peeled is built anew from the digests with more parts.
    """
    total = "aggregate(sequence(0, n - 1), 0, (total, g) -> if(total is null, total, total + {0}))"
    mine = "filter({v}.{x}, d -> " + PART.format(d="d", n="n", g="g") + ")"
    stored = total.format(peeled(folded(f"{v}.sa", "n"), folded(f"{v}.sb", "n")))
    again = total.format(peeled(cells(mine.format(v=v, x="a")), cells(mine.format(v=v, x="b"))))
    tries = [f"transform(array(least(size({v}.sa), size({v}.sb))), n -> {stored})[0]"]
    tries += [f"transform(array({k} * greatest(size({v}.sa), size({v}.sb))), n -> {again})[0]" for k in GROWTH]
    return f"coalesce({', '.join(tries)})"


def likeness(p: str, q: str) -> str:
    """SQL: share of the paragraphs that two texts have in common, 0 to 1; two empty ones are alike."""
    pair = f"named_struct('a', {p}.d, 'b', {q}.d, 'sa', {p}.s, 'sb', {q}.s)"
    size = "(size(v.a) + size(v.b))"
    return f"transform(array({pair}), v -> if({size} = 0, 1D, coalesce(1D - ({difference('v')}) / {size}, 0D)))[0]"


def with_sketch(d: str) -> str:
    """SQL: struct of digests ``d`` and their sketch ``s``."""
    return f"transform(array({d}), d -> named_struct('d', d, 's', {sketched('d')}))[0]"


def fingerprint(p: str) -> str:
    """SQL: the number of digests and the cells (count, key, check in hex; - if empty), as a string."""
    cell = "if(c.c = 0 and c.k = 0L and c.x = 0L, '-', concat_ws('.', lower(hex(c.c)), lower(hex(c.k)), lower(hex(c.x))))"
    return f"concat(size({p}.d), ':', array_join(transform(flatten({p}.s), c -> {cell}), ','))"


def read_fingerprint(text: str) -> str:
    """SQL: number of digests ``n`` and sketch ``s`` of a stored fingerprint."""
    number = "(shiftleft(cast(conv(left(lpad({0}, 16, '0'), 8), 16, 10) as bigint), 32) | cast(conv(right(lpad({0}, 16, '0'), 8), 16, 10) as bigint))"
    c, k, x = (number.format(f"f[{i}]") for i in range(3))
    cell = f"if(c = '-', {EMPTY}, transform(array(split(c, '[.]')), f -> named_struct('c', cast({c} as int), 'k', {k}, 'x', {x}))[0])"
    n = 3 * THIRD
    parts = f"transform(array(transform(split(t[1], ','), c -> {cell})), z -> transform(sequence(1, size(z), {n}), i -> slice(z, i, {n})))[0]"
    return f"transform(array(split({text}, ':')), t -> named_struct('n', cast(t[0] as int), 's', {parts}))[0]"


def stored_likeness(left: str, right: str) -> str:
    """SQL: likeness of two stored fingerprints; null if the difference is more than their sketches hold."""
    each = f"aggregate(sequence(0, n - 1), 0, (total, g) -> total + {peeled(folded('v.p.s', 'n'), folded('v.q.s', 'n'))})"
    found = f"transform(array(least(size(v.p.s), size(v.q.s))), n -> {each})[0]"
    both = f"named_struct('p', {read_fingerprint(left)}, 'q', {read_fingerprint(right)})"
    return f"transform(array({both}), v -> if(v.p.n + v.q.n = 0, 1D, 1D - {found} / (v.p.n + v.q.n)))[0]"


def in_buckets(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h, bucket): buckets are runs of consecutive ids with about equal numbers of documents.

    Null ids come last, in buckets by the text's hash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(min(MAX_BUCKETS, 1 + size // BUCKET_BYTES))
    cuts = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    bounds = rows.agg(F.array_distinct(F.percentile_approx("doc_id", cuts, F.lit(4 * n)))).first()[0] or []
    rows = rows.withColumn("h", F.xxhash64("text"))
    placed = with_bucket(rows.withColumn("_bounds", F.lit(bounds or [0])), "doc_id", "_bounds", n + 1)
    lost = F.lit(n + LOST) + F.shiftright("h", 54)
    bucket = F.when(F.col("doc_id").isNull(), lost).otherwise(F.col("_b")).cast("bigint")
    return placed.select("doc_id", "text", "h", bucket.alias("bucket"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, d, next_text, next_d): every document and its digests with those of the next; the first follows the last.

    One exchange of the texts: the first document of every bucket is also put at the end of the bucket before.
    """
    rows = in_buckets(docs)
    key = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "h")
    firsts = rows.groupBy("bucket").agg(F.min(key).alias("first"))  # one row per bucket: a bounded number
    order = Window.orderBy("bucket")
    before = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = materialise(firsts.select("bucket", before.alias("to"), F.col("first.doc_id").alias("id"), F.col("first.h").alias("hash")), "bucket-firsts")
    same = (rows["bucket"] == firsts["bucket"]) & rows["doc_id"].eqNullSafe(firsts["id"]) & (rows["h"] == firsts["hash"])
    guards = rows.join(F.broadcast(firsts), same).select("doc_id", "text", "h", F.col("to").alias("bucket"), F.lit(1).alias("guard"))
    guards = guards.dropDuplicates(["bucket"])
    both = rows.withColumn("guard", F.lit(0)).unionByName(guards)
    both = with_once(both, "d", F.expr(digests("text", "length(text)")))
    window = Window.partitionBy("bucket").orderBy("guard", F.col("doc_id").asc_nulls_last(), "h")
    led = both.withColumns({"next_text": F.lead("text").over(window), "next_d": F.lead("d").over(window)})
    return led.where("guard = 0").select("doc_id", "text", "d", "next_text", "next_d")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the next document. Likeness
    is that of the two fingerprints. A null text counts as empty; a null id comes after all others; of rows that share an id
    the one with the smaller text hash comes first; one document is its own next; an empty table gives no rows. Other columns
    are ignored.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    head = F.expr("substring(text, 1, cast(n_chars as int) - cast(n_chars div 4 as int))")
    edited = F.concat(head, F.expr("substring(next_text, 1, cast(n_chars div 4 as int))"))
    rows = rows.select("doc_id", "n_chars", "d", "next_d", edited.alias("edited"))
    sketches = F.struct(
        F.expr(with_sketch("d")).alias("p"), F.expr(with_sketch("next_d")).alias("q"),
        F.expr(with_sketch(digests("edited", "length(edited)"))).alias("e"),
    )
    rows = with_once(rows, "s", sketches)

    def text(x: str) -> Column:
        return F.expr(fingerprint(x))

    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), text("s.p").alias("fingerprint"), text("s.e").alias("edited_fingerprint"),
        F.expr(likeness("s.p", "s.e")).alias("near_edited"), F.expr(likeness("s.p", "s.q")).alias("near_next"),
    )
