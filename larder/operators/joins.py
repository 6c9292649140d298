"""Keyed joins between collections: membership, ingest, updates, enrichment and comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.nutrients import is_filled


def unlabeled(docs: DataFrame, labeled: DataFrame, key: str = "fid") -> DataFrame:
    """Documents whose key is not in the labelled set."""
    return docs.join(labeled.select(key), key, "left_anti")


def known(docs: DataFrame, collection: DataFrame | None, key: str = "fdc_id") -> DataFrame:
    """Documents whose key is already in the collection; a collection that does not exist knows nothing."""
    return docs.limit(0) if collection is None else docs.join(collection.select(key), key, "left_semi")


def unknown(docs: DataFrame, collection: DataFrame | None, key: str = "fdc_id") -> DataFrame:
    """Documents whose key is not yet in the collection."""
    return docs if collection is None else docs.join(collection.select(key), key, "left_anti")


def one_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key, found by a combined aggregate, not by sorting a group."""
    others = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.min_by(F.struct(order, *others), order).alias("_row"))
    return best.select(key, F.col(f"_row.{order}").alias(order), *[F.col(f"_row.{c}").alias(c) for c in others])


def update_by_key(docs: DataFrame, updates: DataFrame, key: str, column: str, row_key: str) -> DataFrame:
    """Set ``column`` on the first document (smallest ``row_key``) of each updated key.

    The first row of each key comes from a combined aggregate, and the patch is joined back on the unique
    ``row_key``; a key held by a third of the documents never meets in one task.
    """
    patch = updates.groupBy(key).agg(F.max(column).alias("_new"))
    first = docs.groupBy(key).agg(F.min(row_key).alias(row_key))
    patched = first.join(patch, key).select(row_key, "_new")
    old = F.col(column) if column in docs.columns else F.lit(None)
    return docs.join(patched, row_key, "left").withColumn(column, F.coalesce("_new", old)).drop("_new").select(
        *[c for c in docs.columns if c != column], column
    )


def keys_not_found(updates: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Updates whose key has no document."""
    return updates.join(docs.select(key), key, "left_anti")


def enrich(docs: DataFrame, facts: DataFrame, key: str = "fdc_id") -> DataFrame:
    """Attach label facts when known; ``labelNutrients`` keeps the document's own bag otherwise.

    ``facts`` has one row per key with the columns ``key`` and ``label``.
    """
    joined = docs.join(facts.select(key, F.col("label").alias("_facts")), key, "left")
    own = F.col("labelNutrients") if "labelNutrients" in docs.columns else F.col("nutrients")
    bag = F.when(is_filled(F.col("_facts")), F.col("_facts")).when(is_filled(own), own).otherwise(F.col("nutrients"))
    return joined.withColumn("labelNutrients", bag).drop("_facts")


def attach_predictions(rows: DataFrame, predictions: DataFrame, key: str = "fid") -> DataFrame:
    """Predictions joined by key (not by position)."""
    return rows.join(predictions, key, "left")


def compare_pairs(pairs: DataFrame, docs: DataFrame, key: str, score: str, reasons: dict[str, bool]) -> DataFrame:
    """Winner of each given pair ``(left_key, right_key)`` with the columns in which the winner is better.

    ``reasons`` maps a column to whether higher is better. Only the listed pairs are compared.
    """
    cols = [score, *[c for c in reasons if c != score]]

    def side(name: str) -> DataFrame:
        return docs.select(F.col(key).alias(f"{name}_key"), *[F.col(c).alias(f"{name}_{c}") for c in cols])

    joined = pairs.join(side("left"), "left_key").join(side("right"), "right_key")
    left_wins = F.col(f"left_{score}") >= F.col(f"right_{score}")

    def reason(c: str, up: bool) -> Column:
        gap = F.col(f"left_{c}") - F.col(f"right_{c}")
        gap = gap if up else -gap
        return F.when(F.when(left_wins, gap > 0).otherwise(gap < 0), F.lit(c))

    why = F.concat_ws(",", *[reason(c, up) for c, up in reasons.items()])
    return joined.select(
        "left_key", "right_key", F.when(left_wins, F.col("left_key")).otherwise(F.col("right_key")).alias("winner"),
        why.alias("reasons"),
    )


def neighbour_pairs(docs: DataFrame, key: str, block: str, order: str) -> DataFrame:
    """Each document paired with the next one of its block: a linear number of pairs, however large the block.

    The position within a block comes from range buckets, so a block with most rows is not one task.
    """
    from larder.operators.ranks import prefix_sums

    rows = docs.select(block, order, F.col(key).alias("left_key"), F.lit(1).alias("n"))
    following = prefix_sums(rows, [block], order, ["n"]).select(block, order, "left_key", "next_value")
    targets = docs.select(F.col(block).alias("_block"), F.col(order).alias("_order"), F.col(key).alias("right_key"))
    return following.join(
        targets, (F.col(block) == F.col("_block")) & (F.col("next_value") == F.col("_order"))
    ).select("left_key", "right_key")


def concat_sets(*sets: DataFrame) -> DataFrame:
    """Rows of all sets, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), sets)
