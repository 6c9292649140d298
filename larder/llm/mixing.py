"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

The documents of a source, in an order by hash, make blocks. With weight w, block j of a source is released at slot
floor(j / w) and due at slot ceil((j + 1) / w); one block is served per slot, and among the released blocks the one with
the earliest deadline goes first. Every source is then less than one block away from its share at every slot.

Weights are whole shares, so the schedule repeats after as many slots as there are shares in sum: one such frame is
scheduled, and every block finds its slot by arithmetic. When a source runs out, one frame takes its last blocks, and the
others go on with their shares of what is left; these spans of slots are called phases. All documents are placed.

Only sources with several blocks per frame need a schedule; those with one may stand anywhere in the frame and take the
open slots by number. So any number of sources is mixed by a sort and joins of tables with no more rows than blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.ranks import number_rows
from larder.session import materialise

#: Documents per block.
BLOCK_ROWS = 8
#: Shares that the default weights are rounded to.
SHARES = 100


def balanced_shares(counts: DataFrame, power: float = 0.5, shares: int = SHARES) -> DataFrame:
    """(source, share): weights by size to a power below one, which lifts small sources; each has one share at least."""
    total = counts.agg(F.sum(F.pow("n", F.lit(power)))).scalar()
    share = F.greatest(F.lit(1), F.round(F.pow("n", F.lit(power)) / total * shares)).cast("bigint")
    return counts.select("source", share.alias("share"))


#: Slots of the blocks of the sources ``s`` (two blocks or more each) in one frame of ``total`` slots, by earliest deadline;
#: ``jobs`` is their number of blocks. Slots at which none of them is released stay open.
FRAME = """
aggregate(
  sequence(1L, jobs),
  named_struct('t', 0L, 'served', transform(s, x -> 0L), 'out', cast(array() as array<struct<i: int, r: bigint, at: bigint>>)),
  (a, k) -> transform(
    array(greatest(a.t, array_min(zip_with(s, a.served, (x, v) -> if(v < x.quota, (v * total) div x.quota, null))))),
    t -> transform(
      array(array_min(filter(transform(s, (x, i) -> if(
        a.served[i] < x.quota and (a.served[i] * total) div x.quota <= t,
        named_struct('due', ((a.served[i] + 1) * total + x.quota - 1) div x.quota, 'i', i), null)), x -> x is not null)).i),
      c -> named_struct('t', t + 1, 'served', transform(a.served, (v, i) -> if(i = c, v + 1, v)),
                        'out', concat(a.out, array(named_struct('i', c, 'r', a.served[c], 'at', t)))))[0])[0],
  a -> a.out)
"""


def phases_of(sources: DataFrame) -> DataFrame:
    """(phase, from_frame, frames): runs of equal frames. In frame t a source serves its share, or what it has left.

    A phase of full frames ends before the first frame in which a source runs short; that frame is a phase of its own. It is
    no phase start if the sources that end there have used up their last block one frame before, as that one's last. There
    are at most as many distinct ends as the square root of twice the number of blocks, however many sources.
    """
    ends = sources.groupBy(F.expr("blocks div share").alias("q")).agg(F.max(F.expr("blocks % share > 0")).alias("short"))
    order = Window.orderBy("q")
    ends = ends.withColumn("new", F.when(F.col("short") | (F.coalesce(F.lag("q").over(order), F.lit(-2)) < F.col("q") - 1), F.col("q")))
    ends = ends.withColumn("new", F.last("new", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = ends.where((F.col("q") - F.col("new")) % 2 == 0).select("q", F.coalesce(F.lag("q").over(order) + 1, F.lit(0)).alias("low"))
    runs = F.array(F.struct(F.col("low").alias("from_frame"), (F.col("q") - F.col("low")).alias("frames")),
                   F.struct(F.col("q").alias("from_frame"), F.lit(1).cast("bigint").alias("frames")))
    found = last.select(F.explode(runs).alias("x")).select("x.*").where("frames > 0")
    return found.withColumn("phase", F.row_number().over(Window.orderBy("from_frame")) - 1)


def schedule(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Phases and frames of (source, blocks, share) rows, both written to the shared folder.

    Phases: phase, from_frame, frames, total (slots per frame), start (first slot). Frames: phase, source, r (block within
    the frame), at (slot within the frame); they have no more rows in sum than there are blocks.
    """
    runs = materialise(phases_of(sources), "mix-phases")
    parts = sources.join(F.broadcast(runs), F.col("from_frame") * F.col("share") < F.col("blocks"))  # few, see phases_of
    quota = F.least("share", F.expr("blocks - from_frame * share"))
    parts = materialise(parts.select("phase", "source", quota.alias("quota")), "mix-parts")
    totals = parts.groupBy("phase").agg(F.sum("quota").alias("total"))
    before = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)
    phases = runs.join(totals, "phase").withColumn("start", F.coalesce(F.sum(F.expr("frames * total")).over(before), F.lit(0)))
    phases = materialise(phases, "mix-slots")
    # sources of one block per frame may stand at any slot of it: they take, in order, those that the others leave open
    many = parts.where("quota > 1").groupBy("phase").agg(F.sort_array(F.collect_list(F.struct("source", "quota"))).alias("s"), F.sum("quota").alias("jobs"))
    many = many.join(totals, "phase").select("phase", "s", F.expr(FRAME).alias("x"))
    many = materialise(many, "mix-frames")
    frame = many.select("phase", "s", F.explode("x").alias("x"))
    frame = frame.select("phase", F.get("s", F.col("x.i"))["source"].alias("source"), "x.r", "x.at")
    ones = number_rows(parts.where("quota = 1").select("phase", "source"), [F.col("phase"), F.col("source")])
    firsts = ones.groupBy("phase").agg(F.min("rn").alias("rn0"))
    opens = many.select("phase", F.expr("transform(array_sort(x.at), (v, i) -> v - i)").alias("taken"))
    ones = ones.join(F.broadcast(firsts), "phase").join(opens, "phase", "left").withColumn("n", F.col("rn") - F.col("rn0"))
    at = F.col("n") + F.coalesce(F.expr("size(filter(taken, v -> v <= n))"), F.lit(0))
    ones = ones.select("phase", "source", F.lit(0).cast("bigint").alias("r"), at.alias("at"))
    return phases, materialise(frame.unionByName(ones), "mix-slots-of-blocks")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mixed(docs: DataFrame, targets: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, source, block, offset, phase, weight, release, deadline, slot.

    ``targets`` has (source, share) with positive whole shares; a source without one has one share, and without
    ``targets`` the shares follow ``balanced_shares``. ``slot`` orders the blocks and ``offset`` the documents of a block;
    the last block of a source may be short. release <= slot < deadline always holds. A null source is a source of its
    own; null ids come first within a source, repeated rows each get their place; other columns are ignored; an empty table
    gives no rows. There may be any number of sources.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"))
    rows = number_rows(rows, [F.col("source"), F.xxhash64("doc_id"), F.col("doc_id")])
    counts = materialise(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("from_")), "mix-counts")
    if targets is None:
        shares = balanced_shares(counts)
    else:
        shares = targets.select(F.col("source").cast("string").alias("source"), F.col("share").cast("bigint").alias("share"))
        shares = shares.where("share > 0").groupBy("source").agg(F.max("share").alias("share"))
    shares = shares.withColumnRenamed("source", "of_")
    known = counts.join(shares, _same(F.col("source"), F.col("of_")), "left").drop("of_")
    known = known.select("source", "from_", F.coalesce("share", F.lit(1)).alias("share"), F.ceil(F.col("n") / block_rows).alias("blocks"))
    known = materialise(known, "mix-sources")
    phases, frame = schedule(known.select("source", "blocks", "share"))
    # no broadcast hints: the planner knows the sizes of the written tables
    placed = rows.join(known.withColumnRenamed("source", "of_"), _same(F.col("source"), F.col("of_"))).drop("of_")
    at = F.col("rn") - F.col("from_")
    placed = placed.select("doc_id", "source", "share", "blocks", F.floor(at / block_rows).alias("block"), (at % block_rows).alias("offset"))
    placed = placed.withColumn("t", F.expr("block div share"))
    frames = phases.withColumn("t_", F.explode(F.expr("sequence(from_frame, from_frame + frames - 1)"))).drop("frames")
    placed = placed.join(frames, F.col("t") == F.col("t_")).drop("t_")
    placed = placed.withColumns({
        "quota": F.least("share", F.expr("blocks - from_frame * share")),
        "j": F.expr("block - from_frame * share"),
        "r": F.expr("block - t * share"),
        "frame_start": F.expr("start + (t - from_frame) * total"),
    })
    frame = frame.select(F.col("phase").alias("phase_"), F.col("source").alias("of_"), F.col("r").alias("r_"), "at")
    placed = placed.join(frame, (F.col("phase") == F.col("phase_")) & _same(F.col("source"), F.col("of_")) & (F.col("r") == F.col("r_")))
    return placed.select(
        "doc_id", "source", "block", "offset", "phase",
        (F.col("quota") / F.col("total")).alias("weight"),
        (F.col("start") + F.expr("(j * total) div quota")).alias("release"),
        (F.col("start") + F.expr("((j + 1) * total + quota - 1) div quota")).alias("deadline"),
        (F.col("frame_start") + F.col("at")).alias("slot"),
    )


def interleave(docs: DataFrame, targets: DataFrame | None = None, block_rows: int = BLOCK_ROWS, files: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` in mixed order: sorted over the partitions, so files in name order hold the mix.

    Rows that share an id stand together, repeated rows and those with a null id too; columns may have any names; an empty
    table gives no rows.
    """
    places = mixed(docs, targets, block_rows).groupBy("doc_id").agg(F.min(F.struct("slot", "offset")).alias("place"))
    places = places.withColumnRenamed("doc_id", "id")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("bigint").alias("own"))
    joined = rows.join(places, F.col("own").eqNullSafe(F.col("id"))).select("row", "place")
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartitionByRange(n, "place").sortWithinPartitions("place").select("row.*")
