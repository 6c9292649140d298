"""Category lexicon, centroids and the assignment of every document to its nearest category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import tokens
from larder.functions.vectors import dot, mean_vectors, unit_vector
from larder.operators.ranks import lookup_join, number_rows
from larder.session import materialise

#: Categories compared in one scan of the documents.
CATEGORY_BLOCK = 512


def category_lexicon(rows: DataFrame, category: str, text: str) -> DataFrame:
    """``(category, keyword)``: the distinct tokens of the texts of each category; rows without a category are left out."""
    words = rows.where(F.col(category).isNotNull()).select(F.col(category).alias("category"), F.explode(tokens(F.col(text))).alias("keyword"))
    return words.distinct()


def token_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, token, n)``: every distinct token of a text with its number of uses, counted before any shuffle."""
    words = tokens(F.col(text))
    return (
        df.select(key, F.explode(words).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    )


def text_vectors(rows: DataFrame, key: str, token_vectors: DataFrame) -> DataFrame:
    """Mean vector of the known tokens of every key, of any length; a key without known tokens has no row.

    ``rows`` is ``(key, token, n)``. One aggregate of whole vectors, weighted by ``n`` and combined on the map side.
    """
    return mean_vectors(lookup_join(rows, token_vectors, "token"), [key], "vector", "n")


def category_centroids(lexicon: DataFrame, token_vectors: DataFrame) -> DataFrame:
    """``(category, vector)``: mean vector of the tokens of all keywords; repeated tokens count again."""
    return text_vectors(token_rows(lexicon, "category", "keyword"), "category", token_vectors)


def group_centroids(vectors: DataFrame, group: str, column: str) -> DataFrame:
    """``(category, vector)`` as the mean of labelled vectors."""
    named = vectors.select(F.col(group).cast("string").alias("category"), F.col(column).alias("vector"))
    return mean_vectors(named, ["category"], "vector")


def similarities(docs: DataFrame, key: str, centroids: DataFrame) -> list[DataFrame]:
    """``(key, sims)`` with arrays of ``struct<sim, category>``, a frame for every block of CATEGORY_BLOCK categories.

    Similarities are rounded to nine places, so that equal categories tie whatever the order of summation was. The
    categories are stored once; a block of them travels to the documents as one scalar array of bounded size.
    """
    units = centroids.select("category", unit_vector(F.col("vector")).alias("unit")).where(F.col("unit").isNotNull())
    units = number_rows(units, [F.col("category")]).withColumn("block", F.expr(f"(rn - 1) div {CATEGORY_BLOCK}"))
    units = materialise(units.select("block", "category", "unit"), "centroids")
    # the exploded array gives one row per usable vector and scales it once, not once per category
    own = docs.select(key, F.explode(F.array_compact(F.array(unit_vector(F.col("vector"))))).alias("_u"))

    def compare(packed):
        return F.transform(
            packed,
            lambda c: F.struct(F.round(dot(F.col("_u"), c["unit"]), 9).alias("sim"), c["category"].alias("category")),
        )

    last = units.agg(F.max("block")).first()[0] or 0
    out = []
    for block in range(last + 1):
        packed = units.where(F.col("block") == block).agg(F.collect_list(F.struct("category", "unit")).alias("c")).scalar()
        out.append(own.withColumn("_pack", packed).select(key, compare(F.col("_pack")).alias("sims")))
    return out


def _ordered() -> Column:
    return F.transform("sims", lambda s: F.struct((-s["sim"]).alias("o"), s["category"].alias("category")))


def rank_categories(docs: DataFrame, key: str, centroids: DataFrame) -> DataFrame:
    """``(key, category, sim, rank)``: every category of every document, best first, ties by name."""
    blocks = similarities(docs, key, centroids)
    if len(blocks) == 1:
        rows = blocks[0].select(key, F.posexplode(F.array_sort(_ordered())).alias("_p", "s"))
        rank = F.col("_p") + 1
    else:
        rows = reduce(DataFrame.unionByName, [b.select(key, F.explode(_ordered()).alias("s")) for b in blocks])
        rank = F.row_number().over(Window.partitionBy(key).orderBy("s"))
    return rows.select(
        key, F.col("s.category").alias("category"), (-F.col("s.o")).alias("sim"), rank.cast("bigint").alias("rank")
    )


def best_category(docs: DataFrame, key: str, centroids: DataFrame) -> DataFrame:
    """``(key, category, sim)`` of the nearest category: the best of each block, then of all blocks."""
    best = [b.select(key, F.array_min(_ordered()).alias("s")) for b in similarities(docs, key, centroids)]
    found = best[0] if len(best) == 1 else reduce(DataFrame.unionByName, best).groupBy(key).agg(F.min("s").alias("s"))
    return found.where(F.col("s").isNotNull()).select(key, F.col("s.category").alias("category"), (-F.col("s.o")).alias("sim"))


def categorise(docs: DataFrame, text: str, lexicon: DataFrame, token_vectors: DataFrame) -> DataFrame:
    """All documents with ``category``; it is null where no token has a vector. Every distinct text is compared once."""
    words = materialise(token_vectors, "token-vectors")
    texts = docs.select(text).where(F.col(text).isNotNull()).distinct()
    vectors = text_vectors(token_rows(texts, text, text), text, words)
    best = best_category(vectors, text, category_centroids(lexicon, words)).select(text, "category")
    return docs.drop("category").join(best, text, "left")
