"""Phrases of several words from a table of any size, found in texts by joins on runs of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import dims
from larder.functions.bind import with_once
from larder.functions.text import tokens
from larder.session import materialise


def phrase_lexicon(phrases: DataFrame, column: str = "phrase") -> DataFrame:
    """``(phrase, size)``: distinct phrases as lower-case tokens joined by blanks, and their number of tokens."""
    words = with_once(phrases.select(column), "w", tokens(F.col(column))).where(F.size("w") > 0)
    return words.select(F.concat_ws(" ", "w").alias("phrase"), F.size("w").alias("size")).distinct()


def _runs(size: int) -> Column:
    """All runs of ``size`` tokens of the column ``w``, joined by blanks."""
    if size == 1:
        return F.col("w")
    return F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.concat_ws(" ", F.slice("w", i, F.lit(size))))


def phrase_hits(df: DataFrame, key: str, text: str, phrases: DataFrame, column: str = "phrase") -> DataFrame:
    """``(key, phrase, n)``: how often the tokens of each phrase stand in a row in each text, overlaps included.

    Only the lengths that the lexicon has are looked at: each text gives one run of tokens per place and length. The runs
    meet the lexicon in a hash join, so the work doesn't grow with the number of phrases; the planner broadcasts the stored
    lexicon if it is small. Rows that share a key count together; null and empty texts, and an empty lexicon, have no hits.
    """
    lexicon = materialise(phrase_lexicon(phrases, column), "phrases")
    sizes = sorted(r["size"] for r in lexicon.select("size").distinct().collect())  # the lengths, not the phrases
    words = with_once(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "w", tokens(F.col("text"))).drop("text")
    runs = [F.when(F.size("w") >= size, _runs(size)).otherwise(F.array().cast("array<string>")) for size in sizes]
    found = F.flatten(F.array(*runs)) if runs else F.array().cast("array<string>")
    long = words.select("key", F.explode(found).alias("phrase"))
    hits = long.join(lexicon.select("phrase"), "phrase")
    return hits.groupBy(F.col("key").alias(key), "phrase").agg(F.count(F.lit(1)).alias("n"))


def phrase_bonus(df: DataFrame, key: str, text: str, phrases: DataFrame, column: str = "phrase") -> DataFrame:
    """``(key, bonus)`` of every row: 0.2 for each occurrence of a phrase, 0 without one."""
    hits = phrase_hits(df, key, text, phrases, column).groupBy(F.col(key).alias("_key")).agg(F.sum("n").alias("_n"))
    joined = df.select(key).join(hits, F.col(key) == F.col("_key"), "left")
    return joined.select(key, (F.coalesce("_n", F.lit(0)) * F.lit(dims.SUPERFOOD_BONUS)).alias("bonus"))
