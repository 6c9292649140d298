"""Sharding by a Hilbert curve over document metadata, in DataFrame operations only.

Language, source and length are each cut into equally full levels; the levels are a cell of a grid, and the cell's index
on the Hilbert curve orders the documents. Runs of that order become shards, so every shard covers a compact region in
all dimensions and a filter on any of them skips most files by their minimum and maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.bind import let
from larder.operators.ranks import number_rows
from larder.session import materialise

#: Levels per dimension as a power of two; three dimensions make 32,768 cells, the size of the broadcast curve table.
BITS = 5
SHARDS = 40
#: Largest broadcast curve table, in cells.
MAX_CELLS = 1 << 18


def with_codes(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds for each text column its code: the place of the whole value among the column's sorted values; null comes first.

    The distinct values are numbered by one range sort and stored, so the planner knows whether they can be broadcast.
    """
    for column, name in columns.items():
        values = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        codes = materialise(number_rows(values, [F.asc_nulls_first("value")], name).select("value", name), "codes")
        df = df.join(codes, F.col(column).eqNullSafe(codes["value"])).drop("value")
    return df


def levels(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> dict[str, Column]:
    """Level 0 to 2^bits - 1 of each numeric dimension by its quantiles over all rows; null is level 0."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(d, shares, 10_000).alias(d) for d in dims]).first()

    out = {}
    for d in dims:
        cuts = sorted(set(row[d] or []))
        out[d] = F.coalesce(_tree(F.col(d), cuts, 0, len(cuts)), F.lit(0))
    return out


def _tree(value: Column, cuts: list, low: int, high: int) -> Column:
    """Number of cuts at or below the value, known to lie in [low, high], as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(value >= cuts[mid], _tree(value, cuts, mid + 1, high)).otherwise(_tree(value, cuts, low, mid))


def hilbert_index(axes: Column, n: int, bits: int) -> Column:
    """Index on the Hilbert curve of a cell given as an array of ``n`` coordinates of ``bits`` bits.

    The coordinates are turned into the transposed index by exchanging or inverting their low bits from the highest
    bit down, a Gray code follows, and the bits are interleaved.
    """

    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]
    x = axes
    if steps:
        listed = F.array(*[F.struct(F.lit(q).cast("bigint").alias("q"), F.lit(i).alias("i")) for q, i in steps])

        def turn(x: Column, step: Column) -> Column:
            low = step["q"] - 1
            first, this = x[0], F.get(x, step["i"])
            swap = first.bitwiseXOR(this).bitwiseAND(low)
            inverted = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            exchanged = F.transform(
                x, lambda v, j: F.when((step["i"] > 0) & ((j == 0) | (j == step["i"])), v.bitwiseXOR(swap)).otherwise(v)
            )
            return F.when(this.bitwiseAND(step["q"]) != 0, inverted).otherwise(exchanged)

        x = F.aggregate(listed, x, turn)

    def gray(x: Column) -> Column:
        running = F.transform(
            F.sequence(F.lit(1), F.lit(n)),
            lambda k: F.aggregate(F.slice(x, F.lit(1), k), F.lit(0).cast("bigint"), lambda a, v: a.bitwiseXOR(v)),
        )
        return let(running, lambda g: _flip(g))

    def _flip(g: Column) -> Column:
        last = F.get(g, F.lit(n - 1))
        flips = F.aggregate(
            F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, 0, -1)] or [F.lit(1).cast("bigint")]),
            F.lit(0).cast("bigint"),
            lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return let(flips, lambda t: F.transform(g, lambda v: v.bitwiseXOR(t)))

    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return let(
        gray(x),
        lambda h: F.aggregate(
            places,
            F.lit(0).cast("bigint"),
            lambda t, p: t * 2 + F.when(F.get(h, p["i"]).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), p["b"])) != 0, 1).otherwise(0),
        ),
    )


def curve(df: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """(cell, h): the Hilbert index of every cell of the grid; ``cell`` has the first coordinate in its highest bits."""
    if n * bits > MAX_CELLS.bit_length() - 1:
        raise ValueError("too many cells for a broadcast curve table: take fewer bits or dimensions")
    cells = df.sparkSession.range(1 << (n * bits)).withColumnRenamed("id", "cell")
    axes = F.array(*[F.shiftright("cell", bits * (n - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")) for i in range(n)])
    return cells.select("cell", hilbert_index(axes, n, bits).alias("h"))


def hilbert_order(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``h``, the Hilbert index of the row's cell in the numeric columns ``dims``.

    Null is the lowest level; equal rows have equal indexes; an empty table gives no rows; a column ``cell`` is replaced.
    """
    found = levels(df, dims, bits)
    cell = F.lit(0).cast("bigint")
    for d in dims:
        cell = cell * (1 << bits) + found[d]
    table = curve(df, len(dims), bits)
    return df.withColumn("cell", cell).join(F.broadcast(table), "cell").drop("cell")


def shards(docs: DataFrame, n: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: rank r of N documents on the curve goes to shard floor(r * n / N), so counts differ by one at
    most; ``slot`` counts within the shard. Documents in one cell are ordered by the text's checksum and the id, so a cell
    that holds a third of all rows is cut like any other. A null text is empty, a null language or source is the lowest
    level, a null id stays null and comes first; repeated rows each get their slot; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.length(text).cast("bigint").alias("d_length"),
    )
    rows = with_codes(rows, {"lang": "d_lang", "source": "d_source"})
    placed = hilbert_order(rows, ["d_lang", "d_source", "d_length"], bits)
    placed = number_rows(placed.select("doc_id", "size", "text_crc32", "h"), [F.col(c) for c in ("h", "text_crc32", "doc_id")])
    total = max(1, placed.count())
    placed = placed.withColumn("shard", F.expr(f"(rn - 1) * {n} div {total}L").cast("int"))
    first = F.expr(f"(shard * {total}L + {n - 1}) div {n}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rn") - 1 - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, n: int = SHARDS, bits: int = BITS) -> None:
    """Write all columns of ``docs`` as Parquet, one folder per shard, in curve order inside each file.

    Rows that share an id, repeated or without one, go to the smallest of their shards. The shard is the column ``shard_``,
    which the table itself must not have; an empty table writes no shard.
    """
    places = shards(docs, n, bits).groupBy("doc_id").agg(F.min(F.struct("shard", "slot")).alias("at")).withColumnRenamed("doc_id", "id")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("bigint").alias("own"))
    joined = rows.join(places, F.col("own").eqNullSafe(F.col("id"))).select("row", "at", F.col("at.shard").alias("shard_"))
    ordered = joined.repartition(n, "shard_").sortWithinPartitions("shard_", "at").select("row.*", "shard_")
    ordered.write.partitionBy("shard_").parquet(path)
