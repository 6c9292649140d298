"""Queries on stored collections in hash partitions: updates in place and ingest by filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.plans.registry import query
from larder.plans.views import Tables
from larder.session import fresh_path
from larder.sources import keyed

PARTITIONS = 16


@query(
    "stored_update",
    """WITH one AS (SELECT p_name, max(p_brand) AS c FROM part WHERE p_size < 10 GROUP BY p_name),
    two AS (SELECT p_name, max(p_type) AS c FROM part WHERE p_size BETWEEN 5 AND 15 GROUP BY p_name),
    firsts AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name)
    SELECT p_partkey AS fid, p.p_name AS description, CASE WHEN p_partkey = k THEN coalesce(two.c, one.c) END AS category
    FROM part p JOIN firsts USING (p_name) LEFT JOIN one USING (p_name) LEFT JOIN two USING (p_name)""",
)
def stored_update(t: Tables) -> DataFrame:
    """Parts as a collection by name; two batches set the category of the first document of each of their names.

    The last batch is run twice, as after a crash. The rows are those read back from the collection.
    """
    parts = t("part")
    docs = parts.select(F.col("p_partkey").alias("fid"), F.col("p_name").alias("description"), F.lit(None).cast("string").alias("category"))
    path = fresh_path(t.spark, "stored-update")
    keyed.create(docs, path, "description", PARTITIONS)
    small = parts.where("p_size < 10").select(F.col("p_name").alias("description"), F.col("p_brand").alias("category"))
    middle = parts.where("p_size BETWEEN 5 AND 15").select(F.col("p_name").alias("description"), F.col("p_type").alias("category"))
    keyed.update(t.spark, path, small, "category", "fid", "small")
    for _ in range(2):
        keyed.update(t.spark, path, middle, "category", "fid", "middle")
    return keyed.scan(t.spark, path)


@query(
    "filtered_ingest",
    """SELECT o_orderkey AS fid, o_orderpriority AS description, CASE WHEN o_orderstatus = 'F' THEN 'stored' ELSE 'added' END AS origin,
    (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS first_run, 0::BIGINT AS second_run FROM orders""",
)
def filtered_ingest(t: Tables) -> DataFrame:
    """All orders taken into a collection that holds the finished ones, twice; the second run adds nothing."""
    orders = t("orders").select(F.col("o_orderkey").alias("fid"), F.col("o_orderpriority").alias("description"), "o_orderstatus")
    path = fresh_path(t.spark, "filtered-ingest")
    finished = orders.where("o_orderstatus = 'F'").select("fid", "description", F.lit("stored").alias("origin"))
    keyed.create(finished, path, "fid", PARTITIONS)
    batch = orders.select("fid", "description", F.lit("added").alias("origin"))
    added = [keyed.append_unknown(batch, path, "description") for _ in range(2)]
    return keyed.scan(t.spark, path).select("*", F.lit(added[0]).cast("bigint").alias("first_run"), F.lit(added[1]).cast("bigint").alias("second_run"))
