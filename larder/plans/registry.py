"""Registry of the queries and of the SQL text that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.plans.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with its SQL form if there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# --- SQL building blocks: the same views as larder.plans.views, as common table expressions ---

WORD = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"

FACTS = """items AS (
  SELECT l_orderkey, max(l_quantity) hi_qty, min(l_quantity) lo_qty, max(l_discount) hi_disc, min(l_discount) lo_disc,
         max(l_tax) hi_tax, min(l_tax) lo_tax, max(l_extendedprice) hi_price, min(l_extendedprice) lo_price,
         max(l_linenumber) hi_line, min(l_linenumber) lo_line, min(l_partkey) partkey, count(*) lines
  FROM lineitem GROUP BY l_orderkey),
facts AS (
  SELECT o_orderkey AS fid, o_totalprice, o_orderstatus, o_orderpriority, items.*, p_name AS description
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = partkey)"""

# the chosen bag of every document, one column per nutrient
FOODS = FACTS + f""",
chosen AS (
  SELECT fid, description, o_orderstatus, o_orderpriority, lines,
    CASE WHEN lines IS NULL THEN 'none' WHEN o_orderstatus = 'F' THEN 'label' ELSE 'food' END AS src,
    hi_qty, lo_qty, hi_tax, lo_tax, hi_disc, lo_disc, hi_price, lo_price, hi_line, lo_line, o_totalprice
  FROM facts),
bag AS (
  SELECT fid, description, src, o_orderstatus, o_orderpriority, lines,
    CASE src WHEN 'label' THEN lo_disc * 100 WHEN 'food' THEN hi_disc * 100 END AS fat,
    CASE src WHEN 'food' THEN lo_disc * 100 END AS "saturatedFat",
    CASE src WHEN 'food' THEN hi_line / 10 END AS "transFat",
    CASE src WHEN 'food' THEN lines * 10e0 END AS cholesterol,
    CASE src WHEN 'label' THEN lo_price / 100 WHEN 'food' THEN hi_price / 100 END AS sodium,
    CASE src WHEN 'label' THEN hi_price / 2000 WHEN 'food' THEN lo_price / 1000 END AS carbohydrates,
    CASE src WHEN 'label' THEN hi_tax * 50 WHEN 'food' THEN lo_tax * 100 END AS fiber,
    CASE src WHEN 'label' THEN lo_line::DOUBLE WHEN 'food' THEN lo_qty END AS sugars,
    CASE src WHEN 'label' THEN lo_qty WHEN 'food' THEN hi_qty END AS protein,
    CASE src WHEN 'food' THEN o_totalprice / 1000 END AS calcium,
    CASE src WHEN 'food' THEN lo_line::DOUBLE END AS iron,
    CASE src WHEN 'food' THEN lines * 50e0 END AS potassium,
    CASE src WHEN 'label' THEN o_totalprice / 400 WHEN 'food' THEN o_totalprice / 500 END AS calories,
    CASE WHEN src = 'food' AND o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS protein_ok,
    CASE WHEN src = 'food' AND o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 1 END AS sugars_ok,
    coalesce(len(list_filter(regexp_extract_all(lower(description), '{WORD}'), lambda w: w IN ('red', 'gizmo'))), 0) * 0.2e0 AS bonus
  FROM chosen),
scored AS (
  SELECT *, round(
      0e0 + protein_ok * coalesce(protein, 0) / 65 * 0.2e0 + coalesce(fiber, 0) / 30 * 0.2e0 + bonus
      - coalesce(fat, 0) / 65 * 0.15e0 - coalesce("transFat", 0) / 65 * 0.1e0
      - coalesce("saturatedFat", 0) / 20 * 0.1e0 - coalesce(cholesterol, 0) / 300 * 0.15e0
      - coalesce(sodium, 0) / 2400 * 0.2e0 - coalesce(carbohydrates, 0) / 300 * 0.25e0
      - sugars_ok * coalesce(sugars, 0) / 50 * 0.15e0, 6) + 0e0 AS score
  FROM bag)"""

FEATURE_LIST = (
    'fat, "saturatedFat", "transFat", cholesterol, sodium, carbohydrates, fiber, sugars, protein, calcium, iron, '
    "potassium, calories"
)
FEATURE_ZERO = ", ".join(
    f"coalesce({f.strip()}, 0) AS {f.strip()}" for f in FEATURE_LIST.split(",")
)


def bucket_sql(key: str, seed: str = "larder", n: int = 3) -> str:
    return f"(('0x' || substr(md5({key} || '{seed}'), 1, 8))::BIGINT % {n})"


FEATURES_SQL = FOODS + f""",
feature_rows AS (SELECT fid, description, score, {FEATURE_ZERO} FROM scored WHERE src <> 'none')"""

LABELED_SQL = FEATURES_SQL + f""",
labeled AS (
  SELECT *, CASE {bucket_sql('fid')} WHEN 0 THEN 'training' WHEN 1 THEN 'validation' ELSE 'testing' END AS label
  FROM feature_rows)"""

LOG_SQL = """log AS (
  SELECT ts, event_type AS model, event_id AS fid, (props::JSON->>'k')::DOUBLE AS target, "value" AS prediction,
         "value" - (props::JSON->>'k')::DOUBLE AS error,
         CASE WHEN (props::JSON->>'k')::DOUBLE <> 0
              THEN abs(("value" - (props::JSON->>'k')::DOUBLE) / (props::JSON->>'k')::DOUBLE) * 100 END AS ape
  FROM events)"""
