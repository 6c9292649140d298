"""Food and recipe score: a weighted sum of shares of daily values plus a bonus per superfood token."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import dims
from larder.functions.bind import let, with_once
from larder.functions.nutrients import prefer
from larder.functions.text import tokens

Scorer = Callable[[Column, Column], Column]
Term = tuple[str, str, float, float]


def _phrase_hits(size: int, listed: Column) -> Callable[[Column], Column]:
    """Number of runs of ``size`` tokens that are listed phrases."""

    def count(row: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(row) - size + 1, F.lit(1)))
        runs = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(row, i, F.lit(size))))
        return F.size(F.filter(runs, lambda r: F.array_contains(listed, r)))

    return count


def superfood_bonus(description: Column, lexicon: Iterable[str] | None = None, phrases: bool = False) -> Column:
    """0.2 for every token that is a superfood; repeated tokens count again, no description gives 0.

    With ``phrases`` entries of several words count too, wherever their tokens stand in a row.
    """
    entries = [w.lower() for w in (lexicon or (dims.SUPERFOODS if phrases else dims.one_word_superfoods()))]
    words = F.array(*[F.lit(w) for w in entries if " " not in w]).cast("array<string>")
    found = tokens(description)
    hits = F.size(F.filter(found, lambda t: F.array_contains(words, t)))
    for size in sorted({w.count(" ") + 1 for w in entries if " " in w}) if phrases else ():
        listed = F.array(*[F.lit(w) for w in entries if w.count(" ") + 1 == size])
        hits = hits + let(found, _phrase_hits(size, listed))
    return F.coalesce(F.when(description.isNotNull(), hits), F.lit(0)) * F.lit(dims.SUPERFOOD_BONUS)


def term_value(bag: Column, term: Term) -> Column:
    """Contribution of one nutrient; 0 if it is missing or has another unit than the term asks for."""
    nutrient, unit, weight, divisor = term
    entry = bag[nutrient]
    return F.when(entry["unit_name"] == unit, F.coalesce(entry["amount"], F.lit(0.0)) / divisor * weight).otherwise(0.0)


def nutrient_score(
    bag: Column,
    description: Column,
    terms: Iterable[Term] = tuple(dims.SCORE_TERMS),
    superfoods: Iterable[str] | None = None,
    fix_mono: bool = False,
) -> Column:
    """Score of one bag. ``fix_mono`` reads the correctly spelled monounsaturated fat."""
    if fix_mono:
        terms = [("monounsaturatedFat", *t[1:]) if t[0] == "manounsaturatedFat" else t for t in terms]
    parts = [term_value(bag, t) for t in terms]
    parts.insert(2, superfood_bonus(description, superfoods))
    return reduce(lambda total, part: total + part, parts, F.lit(0.0))


def score_foods(docs: DataFrame, scorer: Scorer = nutrient_score) -> DataFrame:
    """Adds ``score``; label facts are used when present, else the food's own nutrients, else an empty bag.

    ``scorer`` is the place for another scoring function: it gets the chosen bag and the description.
    """
    chosen = docs.withColumn("_bag", prefer(F.col("labelNutrients"), F.col("nutrients")))
    return with_once(chosen, "score", scorer(F.col("_bag"), F.col("description"))).drop("_bag")


def score_recipes(docs: DataFrame, scorer: Scorer = nutrient_score) -> DataFrame:
    """Adds ``score`` from the recipe's ``nutrients``."""
    return with_once(docs, "score", scorer(F.col("nutrients"), F.col("description")))
