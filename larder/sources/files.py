"""File listings and the readers of raw food and recipe lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import schemas
from larder.functions.bind import let, with_once
from larder.functions.nutrients import fix_nutrition_labels, fix_recipes_labels, is_filled
from larder.functions.text import flatten_map, processed_sibling, repair_json_line
from larder.operators.filters import nonblank


def list_files(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """``(folder, file_name, length, path)`` below a prefix; file contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(prefix)
    )
    return found.select(
        F.regexp_extract("path", r"([^/]+)/[^/]*$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
        "length",
        "path",
    ).where(F.col("file_name") != "")


def prefer_processed(files: DataFrame, name: str = "file_name") -> DataFrame:
    """For every ``*_processed.json`` the ``*_davinci.json`` of the same stem if it is listed, else the file itself.

    Files with other names are left out.
    """
    inputs = files.where(F.col(name).endswith("_processed.json")).select(F.col(name).alias("input"))
    done = files.select(F.col(name).alias("_other")).distinct()
    wanted = inputs.withColumn("_other", processed_sibling(F.col("input")))
    marked = wanted.join(done.withColumn("_has", F.lit(True)), "_other", "left")
    return marked.select("input", F.when(F.col("_has"), F.col("_other")).otherwise(F.col("input")).alias("chosen"))


def parse_lines(
    lines: DataFrame, schema: str, column: str = "value", only_damaged: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Repaired and parsed documents, and a quarantine ``(line, reason)`` of those that are not JSON.

    The repair also changes ``=`` inside values. With ``only_damaged`` a line that parses as it is stays as it is.
    """
    probe = T.StructType.fromDDL(schema).add("_bad", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    # parsed once per line, though the filter and every field read the result
    kept = nonblank(lines, column).select(F.col(column).alias("_line"))
    repaired = F.from_json(repair_json_line("_line"), probe, options)
    if only_damaged:
        plain = F.from_json("_line", probe, options)
        fits = let(plain, lambda d: F.when(d.isNotNull() & d["_bad"].isNull(), d))
        parsed = with_once(kept, "d", F.coalesce(fits, repaired))
    else:
        parsed = with_once(kept, "d", repaired)
    good = F.col("d").isNotNull() & F.col("d._bad").isNull()
    docs = parsed.where(good).select("d.*").drop("_bad")
    bad = parsed.where(~good).select(F.col("_line").alias("line"), F.lit("not valid JSON after repair").alias("reason"))
    return docs, bad


def food_documents(raw: DataFrame) -> DataFrame:
    """Canonical ``nutrients`` beside the raw bag, ``_id`` as ``id``; no nutrients give an empty map."""
    fixed = F.when(is_filled(F.col("food_nutrients")), fix_nutrition_labels(F.col("food_nutrients")))
    empty = F.create_map().cast(schemas.BAG)
    return raw.withColumn("nutrients", F.coalesce(fixed, empty)).withColumnRenamed("_id", "id")


def recipe_documents(raw: DataFrame) -> DataFrame:
    """Canonical nutrients; ingredients, directions and tips as text, ``""`` when missing."""
    fixed = F.when(is_filled(F.col("nutrients")), fix_recipes_labels(F.col("nutrients")))

    def text(column: str, nested: bool) -> Column:
        return F.when(is_filled(F.col(column)), flatten_map(column, nested)).otherwise("")

    return (
        raw.withColumn("nutrients", F.coalesce(fixed, F.create_map().cast(schemas.BAG)))
        .withColumn("ingredients", text("ingredients", True))
        .withColumn("directions", text("directions", False))
        .withColumn("tips", text("tips", False))
        .withColumnRenamed("_id", "id")
    )


def read_documents(spark: SparkSession, paths: str | list[str], tag: str = "recipes") -> tuple[DataFrame, DataFrame]:
    """Documents of JSON-lines files and their quarantine; one read over all files, split by Spark."""
    lines = spark.read.text(paths)
    if tag == "nutrients":
        docs, bad = parse_lines(lines, schemas.FOOD_LINE)
        return food_documents(docs), bad
    docs, bad = parse_lines(lines, schemas.RECIPE_LINE)
    return recipe_documents(docs), bad
