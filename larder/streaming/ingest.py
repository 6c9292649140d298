"""Incremental ingest: new line files become scored documents, each key once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder import schemas
from larder.functions.scoring import Scorer, nutrient_score, score_foods
from larder.operators.filters import before_ingest
from larder.operators.joins import enrich
from larder.sources import keyed
from larder.sources.files import food_documents, parse_lines
from larder.sources.tables import append_new, keyless


def scored_documents(lines: DataFrame, facts: DataFrame | None = None, scorer: Scorer = nutrient_score) -> DataFrame:
    """Raw lines -> repaired, renamed, enriched and scored documents ready for the collection."""
    return scored(parse_lines(lines, schemas.FOOD_LINE)[0], facts, scorer)


def scored(parsed: DataFrame, facts: DataFrame | None = None, scorer: Scorer = nutrient_score) -> DataFrame:
    """Parsed food lines -> renamed, enriched and scored documents."""
    docs = food_documents(parsed)
    if facts is None:
        docs = docs.withColumn("labelNutrients", F.col("nutrients"))
    else:
        docs = enrich(docs, facts)
    return score_foods(before_ingest(docs), scorer)


def write_batch(
    collection: str, key: str = "fdc_id", facts: DataFrame | None = None, quarantine: str | None = None, filtered: bool = False
) -> Callable[[DataFrame, int], None]:
    """Batch writer that adds only unknown keys, so a repeated batch changes nothing.

    Lines that can't be parsed and documents without a key go to the ``quarantine`` folder, one folder per batch. With
    ``filtered`` the collection is one of ``sources.keyed`` and keeps filters of its keys; the first batch creates it.
    """

    def write(lines: DataFrame, batch: int) -> None:
        parsed, bad = parse_lines(lines, schemas.FOOD_LINE)
        docs = scored(parsed, facts)
        if quarantine:
            bad.unionByName(keyless(docs, key)).write.mode("overwrite").parquet(f"{quarantine}/batch={batch}")
        if filtered:
            keyed.append_or_create(docs, collection, key, "id")
        else:
            append_new(docs, collection, key)

    return write


def ingest_stream(
    spark: SparkSession, source: str, collection: str, checkpoint: str, facts: DataFrame | None = None,
    quarantine: str | None = None, filtered: bool = False,
) -> StreamingQuery:
    """Take in all files not seen before, then stop."""
    lines = spark.readStream.schema("value string").text(source)
    return (
        lines.writeStream.foreachBatch(write_batch(collection, facts=facts, quarantine=quarantine, filtered=filtered))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
