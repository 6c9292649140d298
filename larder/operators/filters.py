"""Filters, projections and row repairs over food documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.nutrients import prefer
from larder.schemas import FEATURES


def term(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose keyword column equals one value."""
    return df.where(F.col(column) == F.lit(value))


def any_exists(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where at least one of the columns is present."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))


def source_fields(df: DataFrame, includes: list[str]) -> DataFrame:
    """Projection by field name or ``struct.*``; ``map.prefix*`` keeps the map entries with that prefix."""
    out: list[Column] = []
    for item in includes:
        head, _, tail = item.partition(".")
        if tail and df.schema[head].dataType.typeName() == "map":
            prefix = tail.rstrip("*")
            out.append(F.map_filter(head, _starts_with(prefix)).alias(head))
        else:
            out.append(F.col(item))
    return df.select(*out)


def _starts_with(prefix: str):
    return lambda key, _value: key.startswith(prefix)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_if_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def feature_rows(docs: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One flat row per document: ids, score and the model features in their fixed order.

    Label facts are used when present, else the nutrients; documents with neither are left out. A missing nutrient
    or amount is 0.
    """
    keep = [c for c in ("fid", "description", "score", "label") if c in docs.columns]
    bag = prefer(F.col("labelNutrients"), F.col("nutrients"))
    # one row per bag that is there: chooses the bag once and leaves out the documents that have none
    chosen = docs.select(*keep, F.explode(F.array_compact(F.array(bag))).alias("_bag"))
    values = [F.coalesce(F.col("_bag")[f]["amount"], F.lit(0.0)).alias(f) for f in features]
    return chosen.select(*keep, *values)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def without_category(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("category").isNull() | (F.col("category") == ""))


def nonblank(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(F.trim(F.col(column)) != "")


def is_missing(column: Column) -> Column:
    return column.isNull() | (F.size(column) == 0)


def missing_audit(docs: DataFrame, maps: list[str], by: list[str]) -> DataFrame:
    """How many documents of each kind lack each of the map fields."""
    counts = [F.sum(is_missing(F.col(m)).cast("bigint")).alias(f"no_{m}") for m in maps]
    return docs.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"), *counts)


def before_ingest(docs: DataFrame) -> DataFrame:
    """Raw bag off, absent nutrients as an empty map."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<amount:double,unit_name:string>>"))
    return docs.drop("food_nutrients").withColumn("nutrients", F.coalesce(F.col("nutrients"), empty))


def preview(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
