"""Order statistics, numbering and lookups that stay distributed however large or skewed the input is.

Nothing here sorts a whole table in one task: values are first counted per distinct value, then cut into range
buckets, and only bucket totals are ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import cut, materialise

#: Range buckets per shuffle partition of the session, and their bounds' largest number: the size of one sketch.
BUCKETS_PER_PARTITION = 4
MAX_BUCKETS = 4096


def value_counts(df: DataFrame, column: str, order: bool = False) -> DataFrame:
    """Count per distinct value; largest first if ``order``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col(column)) if order else counts


def kth_value(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th smallest value (1-based) of an integer column, by counting instead of sorting.

    Each round counts rows in at most 4096 equal ranges (combined on the map side, so 4096 rows reach the driver)
    and keeps the range that holds the k-th row; the rest is a pushed-down range filter for the next scan.
    """
    col = F.col(column)
    low, high, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if n < k or k < 1:
        return None
    left = k
    while low < high:
        inside = df.where(col.between(low, high))
        width = max(1, -(-(high - low + 1) // 4096))
        ranges = inside.groupBy(F.expr(f"({column} - {low}L) div {width}L").alias("r")).count().orderBy("r").collect()
        for r, count in ranges:
            if left <= count:
                low, high, n = low + r * width, min(high, low + r * width + width - 1), count
                break
            left -= count
    return low


def number_rows(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """1-based row number in a total order.

    One range-partitioned sort, kept in the shared folder so that both passes see the same partitions; then one
    count per partition, and the running total of those few counts is added to the position inside the partition.
    """
    ordered = cut(df.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id())
    ordered = ordered.withColumn("_part", F.shiftright("_at", 33)).withColumn("_pos", F.col("_at").bitwiseAND((1 << 33) - 1))
    per_part = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row per partition of the sort, so the broadcast side is as small as the task count
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_at", "_part", "_pos", "_before")
    )


def with_bucket(df: DataFrame, value: str, bounds: str, buckets: int) -> DataFrame:
    """Adds ``_b``: how many entries of a sorted array (fewer than ``buckets``) lie below a value.

    A binary search written as one projection per step. Each step uses the one before twice, so the optimizer keeps
    them apart, and all of them run as generated code.
    """
    step = 1 << (max(2, buckets) - 1).bit_length()
    out = df.withColumn("_b", F.lit(0))
    while step > 1:
        step //= 2
        below = F.get(F.col(bounds), F.col("_b") + (step - 1)) < F.col(value)
        out = out.withColumn("_b", F.col("_b") + F.when(below, step).otherwise(0))
    return out


def attach_small(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Join a per-group summary to the rows it summarises.

    The summary is stored, so the planner knows its size: below the session's broadcast threshold it is broadcast and
    no row moves; beyond, both sides are shuffled and adaptive execution splits the large groups.
    """
    return df.join(materialise(small, "summary"), keys)


def _in_buckets(
    counts: DataFrame, groups: list[str], value: str, sums: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows with a range bucket ``_b``, and one row per (group, bucket) with running and whole sums.

    The bounds come from an approximate sketch; they only decide how even the buckets are, never a result. Their
    number follows the session's shuffle partitions, which are set for the size of the data; a task sorts with spilling.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, BUCKETS_PER_PARTITION * partitions)
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    rows = counts.where(F.col(value).isNotNull())
    bounds = rows.groupBy(*groups).agg(
        F.array_distinct(F.percentile_approx(value, cuts, F.lit(4 * buckets))).alias("_bounds")
    )
    placed = with_bucket(attach_small(rows, bounds, groups), value, "_bounds", buckets).drop("_bounds")
    totals = placed.groupBy(*groups, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums], F.min(value).alias("_first"))
    by_bucket = Window.partitionBy(*groups).orderBy("_b")
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        *groups,
        "_b",
        F.lead("_first").over(by_bucket).alias("_next"),
        *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.col(f"_t_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    return placed, offsets


def prefix_sums(
    counts: DataFrame, groups: list[str], value: str, sums: list[str], stored: bool = False
) -> DataFrame:
    """Running sums over ordered distinct values, per group.

    ``counts`` has one row per (group, value). For every column s of ``sums`` the result has ``before_s`` (sum over
    smaller values) and ``all_s`` (sum of the group), plus ``next_value``. Values are cut into range buckets of
    about equal row count, so a group with most of the rows is spread over many tasks. The counts are read more than
    once; they are written first unless ``stored`` says that they are a written table already.
    """
    if not groups:
        alone = counts.withColumn("_no_group", F.lit(0))
        return prefix_sums(alone, ["_no_group"], value, sums, stored).drop("_no_group")
    counts = counts if stored else materialise(counts, "counts")
    placed, offsets = _in_buckets(counts, groups, value, sums)
    # one exchange on (group, bucket) serves the join and the window below; a partitioning by group alone would
    # satisfy the window too and leave a large group in one task
    placed = placed.repartition(*groups, "_b")
    inside = Window.partitionBy(*groups, "_b").orderBy(value)
    up_to = inside.rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, [*groups, "_b"]).select(
        *[c for c in placed.columns if c != "_b"],
        F.coalesce(F.lead(value).over(inside), F.col("_next")).alias("next_value"),
        *[(F.col(f"_o_{s}") + F.coalesce(F.sum(s).over(up_to), F.lit(0))).alias(f"before_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums],
    )


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, qs: list[float], weight: str | None = None
) -> DataFrame:
    """Interpolated quantiles per group: rows ``(groups, q, value)``.

    Values are counted, and the counts summed per range bucket. Only the buckets in which a wanted position lies (at
    most two per quantile) are sorted; all other rows are never shuffled again.
    """
    if not groups:
        alone = df.withColumn("_no_group", F.lit(0))
        return exact_quantiles(alone, ["_no_group"], value, qs, weight).drop("_no_group")
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(n.alias("n"))
    counts = materialise(counts, "counts")
    placed, offsets = _in_buckets(counts, groups, value, ["n"])
    wanted = F.array(*[F.lit(float(q)) for q in qs])

    def position(q: Column) -> Column:
        return q * (F.col("all_n") - 1)

    def hits(start: Column, size: Column) -> Column:
        def covers(p: Column) -> Column:
            return (p >= start) & (p < start + size)

        return F.filter(wanted, lambda q: covers(F.floor(position(q))) | covers(F.ceil(position(q))))

    needed = offsets.where(F.size(hits(F.col("_o_n"), F.col("_t_n"))) > 0).select(*groups, "_b", "_o_n", "all_n")
    # at most two buckets per group and quantile
    close = attach_small(placed, needed, [*groups, "_b"])
    inside = Window.partitionBy(*groups, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = close.select(
        *groups, value, "n", "all_n", (F.col("_o_n") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("_at")
    )
    rows = ranked.withColumn("q", F.explode(hits(F.col("_at"), F.col("n"))))
    low, high = F.floor(position(F.col("q"))), F.ceil(position(F.col("q")))

    def value_at(p: Column) -> Column:
        return F.max(F.when((p >= F.col("_at")) & (p < F.col("_at") + F.col("n")), F.col(value)))

    picked = rows.groupBy(*groups, "q").agg(
        value_at(low).alias("_low"), value_at(high).alias("_high"), F.max(position(F.col("q")) - low).alias("_frac")
    )
    at = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")
    return picked.select(*groups, "q", at.alias("value"))


def top_n_per_group(
    df: DataFrame, groups: list[str], order: list[Column], n: int, spread: Column, salts: int = 64, name: str = "rn"
) -> DataFrame:
    """First ``n`` rows of every group, numbered.

    Each group is first cut into ``salts`` parts by ``spread`` (a row key), which keep their own first n; a group
    with a third of all rows is therefore ranked by many tasks, and the last ranking sees at most n x salts rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    part = Window.partitionBy(*groups, "_salt").orderBy(*order)
    # the explicit exchange keeps an earlier partitioning by group alone from being reused
    kept = salted.repartition(*groups, "_salt").withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= n).drop("_r", "_salt")
    whole = Window.partitionBy(*groups).orderBy(*order)
    return kept.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= n)


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Join facts to a lookup table with unique keys, keeping facts without a match.

    The planner broadcasts a lookup below its size threshold. A larger one meets the facts by a shuffle on the key, which
    adaptive execution splits where single keys hold a large part of the facts.
    """
    return facts.join(lookup, key, "left")
