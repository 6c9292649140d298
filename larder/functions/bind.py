"""Naming an intermediate value inside an expression, so that it is computed once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed exactly once per row.

    A plain column is copied into every later filter and projection that uses it; the output of a generator is not.
    Meant for expensive expressions that several later steps read.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
