"""Queries over lines, names, units, texts, vectors and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import schemas
from larder.functions import nutrients as nut
from larder.functions import text as txt
from larder.functions.bind import with_once
from larder.functions.scoring import score_recipes, superfood_bonus
from larder.functions.vectors import cosine
from larder.operators import categorise as cat
from larder.operators import embed as emb
from larder.operators import phrases
from larder.operators.filters import nonblank
from larder.operators.joins import concat_sets, keys_not_found
from larder.plans import views
from larder.plans.registry import FACTS, WORD, query
from larder.plans.views import Tables
from larder.session import fresh_path, materialise
from larder.sources import files, tables


# --- lines and JSON -----------------------------------------------------------------------------------------------

DOC_LINES = r"""lines_in AS (
  SELECT doc_id, '{"doc"=' || doc_id || ', "text"="' || replace(replace(text, chr(10), '\q'), '"', '\"') || '"}' AS "value"
  FROM documents)"""


def repair_sql(line: str) -> str:
    """The line repair without lookahead: good escapes are set aside, the other backslashes doubled."""
    single = rf"replace({line}, '\\', '\')"
    aside = rf"""replace(replace(replace({single}, '\/', chr(1)), '\u', chr(2)), '\"', chr(3))"""
    doubled = rf"replace({aside}, '\', '\\')"
    back = rf"""replace(replace(replace({doubled}, chr(1), '\/'), chr(2), '\u'), chr(3), '\"')"""
    return f"replace({back}, '=', ':')"


@query("repair_lines", f"""WITH {DOC_LINES} SELECT doc_id, md5({repair_sql('"value"')}) AS repaired, length({repair_sql('"value"')}) AS n FROM lines_in""")
def repair_lines(t: Tables) -> DataFrame:
    """Repair of the whole texts as JSON lines; the result is compared by digest and length."""
    # the given file is one row group; dealt out by the key, its lines are repaired by all tasks
    fixed = with_once(views.document_lines(t).repartition("doc_id"), "fixed", txt.repair_json_line("value"))
    return fixed.select("doc_id", F.md5("fixed").alias("repaired"), F.length("fixed").cast("bigint").alias("n"))


@query(
    "read_lines",
    f"""WITH {DOC_LINES} SELECT doc_id, md5(replace(replace(text, chr(10), '\\q'), '=', ':')) AS body FROM documents""",
)
def read_lines(t: Tables) -> DataFrame:
    """Repaired lines parsed to documents: the text comes back whole."""
    docs, _ = files.parse_lines(views.document_lines(t), "doc bigint, text string")
    return docs.select(F.col("doc").alias("doc_id"), F.md5("text").alias("body"))


@query(
    "read_food_lines",
    f"""WITH {FACTS} SELECT fid, 'food-' || fid AS id, coalesce(description, '') || ' \\q é ' || o_orderpriority AS description,
    CASE WHEN lines IS NOT NULL THEN floor(hi_qty) END AS protein, CASE WHEN lines IS NOT NULL THEN lines::DOUBLE END AS sodium
    FROM facts WHERE o_orderpriority <> '5-LOW'""",
)
def read_food_lines(t: Tables) -> DataFrame:
    """Damaged food lines -> repaired, parsed, renamed documents."""
    docs, _ = files.parse_lines(views.food_lines(t), schemas.FOOD_LINE)
    food = files.food_documents(docs)
    bag = F.col("nutrients")
    return food.select(
        "fid", "id", "description", bag["protein"]["amount"].alias("protein"), bag["sodium"]["amount"].alias("sodium")
    )


@query("quarantine", f"WITH {FACTS} SELECT 'not valid JSON after repair' AS reason, count(*) AS docs FROM facts WHERE o_orderpriority = '5-LOW'")
def quarantine(t: Tables) -> DataFrame:
    """Truncated lines, kept aside with a reason."""
    _, bad = files.parse_lines(views.food_lines(t), schemas.FOOD_LINE)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("docs"))


@query(
    "safe_json",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN (props::JSON->>'k')::BIGINT END AS k,
    CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) END AS text FROM events""",
)
def safe_json(t: Tables) -> DataFrame:
    """Good documents parsed, damaged ones (errors lose their last brace) kept as text."""
    damaged = F.when(F.col("event_type") == "error", F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    parsed = t("events").select("event_id", txt.safe_json(damaged, "k bigint").alias("j"))
    return parsed.select("event_id", F.col("j.doc.k").alias("k"), F.col("j.text").alias("text"))


@query("nonblank_lines", "SELECT doc_id, line_no, length(line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents) WHERE trim(line) <> ''")
def nonblank_lines(t: Tables) -> DataFrame:
    rows = t("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "value"))
    return nonblank(rows).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.length("value").cast("bigint").alias("n"))


@query("flatten_report", """SELECT o_orderkey AS "order.key", o_orderstatus AS "order.state.code", o_totalprice AS "order.price" FROM orders""")
def flatten_report(t: Tables) -> DataFrame:
    """Nested report columns to dotted names."""
    nested = t("orders").select(
        F.struct(
            F.col("o_orderkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("state"),
            F.col("o_totalprice").alias("price"),
        ).alias("order")
    )
    return txt.flatten_structs(nested)


@query("as_json", """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS "value" FROM orders""")
def as_json(t: Tables) -> DataFrame:
    return tables.as_json(t("orders").select("o_orderkey", "o_orderstatus"))


# --- files and runs -----------------------------------------------------------------------------------------------


@query("list_files")
def list_files(t: Tables) -> DataFrame:
    """Files of the table directory with their folder and size; contents are not read."""
    return files.list_files(t.spark, t.root, "*.parquet").select("folder", "file_name", "length")


@query(
    "multi_file_read",
    f"""WITH {FACTS}, parts AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent' ELSE 'other' END AS folder, o_orderpriority AS p FROM facts)
    SELECT folder, count(*) FILTER (p <> '5-LOW') AS docs, count(*) FILTER (p = '5-LOW') AS bad FROM parts GROUP BY folder""",
)
def multi_file_read(t: Tables) -> DataFrame:
    """Food lines written as files in two folders, found by listing, read together and counted by folder."""
    root = fresh_path(t.spark, "drops")
    lines = views.food_lines(t)
    urgent = F.col("value").rlike("1-URGENT|2-HIGH")
    lines.where(urgent).select("value").write.text(f"{root}/urgent")
    lines.where(~urgent).select("value").write.text(f"{root}/other")
    found = files.list_files(t.spark, root, "part-*").groupBy("folder").agg(F.collect_list("path").alias("paths"))
    out = []
    for row in found.collect():  # two folders
        docs, bad = files.read_documents(t.spark, row["paths"], "nutrients")
        folder, one, none = F.lit(row["folder"]).alias("folder"), F.lit(1), F.lit(0)
        out += [docs.select(folder, one.alias("d"), none.alias("b")), bad.select(folder, none.alias("d"), one.alias("b"))]
    return concat_sets(*out).groupBy("folder").agg(F.sum("d").alias("docs"), F.sum("b").alias("bad"))


@query(
    "collection_lifecycle",
    f"""WITH {FACTS} SELECT 'exported' AS step, count(*) AS n, 'fdc_id,fid,labelNutrients,nutrients' AS columns FROM facts
    UNION ALL SELECT 'emptied', 0, 'fid,fdc_id' UNION ALL SELECT 'appended', count(*) FILTER (fid % 2 = 0), 'fid,fdc_id' FROM facts""",
)
def collection_lifecycle(t: Tables) -> DataFrame:
    """A collection exported without its raw bag, emptied, and appended to: rows and columns as read back each time."""
    path, other = fresh_path(t.spark, "export"), fresh_path(t.spark, "emptied")
    docs = materialise(views.food_docs(t).withColumn("food_nutrients", F.lit("raw")), "foods")
    tables.export(docs.select("fid", "fdc_id", "food_nutrients", "nutrients", "labelNutrients"), path)

    def state(step: str, where: str, ordered: bool) -> DataFrame:
        df = tables.scan(t.spark, where)
        names = ",".join(sorted(df.columns) if ordered else df.columns)
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n", F.lit(names).alias("columns"))

    exported = materialise(state("exported", path, True), "state")
    tables.append(docs.select("fid", "fdc_id"), other)
    tables.empty_collection(t.spark, other, "fid bigint, fdc_id bigint")
    emptied = materialise(state("emptied", other, False), "state")
    tables.append(docs.where("fid % 2 = 0").select("fid", "fdc_id"), other)
    return exported.unionByName(emptied).unionByName(state("appended", other, False))


@query("path_keys", """SELECT page_id, regexp_replace(url, '^[A-Za-z0-9]+://[^/]*/', '') AS "key" FROM pages""")
def path_keys(t: Tables) -> DataFrame:
    return t("pages").select("page_id", txt.key_of_path("url").alias("key"))


@query(
    "prefer_processed",
    """WITH stems AS (SELECT source || '-' || doc_id AS stem, doc_id FROM documents)
    SELECT stem || '_processed.json' AS input,
      CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN stem || '_davinci.json' ELSE stem || '_processed.json' END AS chosen
    FROM stems""",
)
def prefer_processed(t: Tables) -> DataFrame:
    """Every document is an input file; the labelled ones have a processed sibling, the rest is other files."""
    stem = F.concat_ws("-", "source", "doc_id")
    docs = t("documents").select("doc_id", stem.alias("stem"))
    inputs = docs.select(F.concat("stem", F.lit("_processed.json")).alias("file_name"))
    done = docs.join(t("labels").select("doc_id"), "doc_id").select(F.concat("stem", F.lit("_davinci.json")).alias("file_name"))
    other = docs.select(F.concat("stem", F.lit(".txt")).alias("file_name"))
    return files.prefer_processed(inputs.unionByName(done).unionByName(other))


@query("latest_run", "SELECT event_id, event_type FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)")
def latest_run(t: Tables) -> DataFrame:
    """Output rows of the latest run; a day is a run."""
    runs = t("events").select("event_id", "event_type", F.to_date("ts").alias("run_id"))
    return tables.latest_run(runs).select("event_id", "event_type")


@query(
    "collection_roundtrip",
    """SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    OR o_orderstatus = 'F' GROUP BY 1""",
)
def collection_roundtrip(t: Tables) -> DataFrame:
    """Append part of the documents, append all of them keyed (only new ones are added), scan the collection."""
    path = fresh_path(t.spark, "collection")
    docs = t("orders").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("label"))
    tables.append(docs.where("o_orderstatus = 'F'"), path)
    tables.append_new(docs, path, "o_orderkey")
    return tables.scan(t.spark, path).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "metric_log",
    """WITH m AS (SELECT count(*)::DOUBLE AS n, round(avg("value"), 6) AS mean, max("value") AS high FROM events)
    SELECT 'run-1' AS run_id, unnest(['n', 'mean', 'high']) AS name, 0::BIGINT AS step, unnest([n, mean, high]) AS "value" FROM m""",
)
def metric_log(t: Tables) -> DataFrame:
    wide = t("events").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("high")
    )
    return tables.wide_to_metrics(wide, "run-1")


# --- nutrient names and units -------------------------------------------------------------------------------------


@query(
    "rename_nutrients",
    f"""WITH {FACTS} SELECT fid, CASE WHEN lines IS NOT NULL THEN lo_tax * 100 END AS fiber, CASE WHEN lines IS NOT NULL THEN hi_disc * 100 END AS fat,
    CASE WHEN lines IS NOT NULL THEN hi_qty END AS "Mystery compound", CASE WHEN lines IS NOT NULL THEN 14 END AS entries FROM facts""",
)
def rename_nutrients(t: Tables) -> DataFrame:
    """Canonical names; of two fiber entries the later wins, an unknown name stays."""
    docs = views.raw_foods(t).select("fid", nut.fix_nutrition_labels(F.col("food_nutrients")).alias("n"))
    bag = F.col("n")
    return docs.select(
        "fid", *[bag[k]["amount"].alias(k) for k in ("fiber", "fat", "Mystery compound")],
        F.when(bag.isNotNull(), F.size(bag)).alias("entries"),
    )


@query(
    "fix_units",
    f"""WITH {FACTS} SELECT fid, 'protein' AS nutrient, lo_qty AS amount, 'g' AS unit_name FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'sodium', lo_price / 100, 'mg' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'vitamin D', hi_line, 'IU' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'calories', o_totalprice / 400, 'kcal' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'fat', lo_disc * 100, 'g' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'carbohydrates', hi_price / 2000, 'g' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'sugars', lo_line, 'g' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'
    UNION ALL SELECT fid, 'fiber', hi_tax * 50, 'g' FROM facts WHERE lines IS NOT NULL AND o_orderstatus = 'F'""",
)
def fix_units(t: Tables) -> DataFrame:
    rows = views.raw_foods(t).select("fid", F.explode(nut.fix_units(F.col("facts"))).alias("nutrient", "v"))
    return rows.select("fid", "nutrient", "v.amount", "v.unit_name")


def measures(t: Tables) -> DataFrame:
    """Line items as amounts of seven nutrients in six units."""
    names = F.array(*[F.lit(n) for n in ("protein", "sodium", "vitamin D", "calcium", "vitamin A", "folate", "stardust")])
    units = F.when(F.col("l_returnflag") == "A", F.when(F.col("l_linestatus") == "O", "gram").otherwise("mg")).when(
        F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") == "O", "IUs").otherwise("percentage")
    ).otherwise(F.when(F.col("l_linestatus") == "O", "microgram").otherwise(""))
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", F.get(names, F.col("l_linenumber") - 1).alias("nutrient"), units.alias("unit"),
        F.col("l_quantity").alias("amount"),
    )


CONVERT = """amounts AS (
  SELECT l_orderkey, l_linenumber,
    (['protein', 'sodium', 'vitamin D', 'calcium', 'vitamin A', 'folate', 'stardust'])[l_linenumber] AS nutrient,
    CASE l_returnflag || l_linestatus WHEN 'AO' THEN 'g' WHEN 'AF' THEN 'mg' WHEN 'NO' THEN 'IU' WHEN 'NF' THEN 'percent'
      WHEN 'RO' THEN 'mcg' WHEN 'RF' THEN '' END AS unit, l_quantity AS amount FROM lineitem),
daily(nutrient, unit, dv) AS (VALUES ('protein', 'g', 65e0), ('sodium', 'mg', 2400e0), ('vitamin D', 'IU', 800e0),
  ('vitamin D', 'mcg', 20e0), ('calcium', 'mg', 1000e0), ('vitamin A', 'IU', 5000e0), ('vitamin A', 'mcg', 1500e0), ('folate', 'mcg', 400e0)),
basis(nutrient, first_unit) AS (VALUES ('protein', 'g'), ('sodium', 'mg'), ('vitamin D', 'IU'), ('calcium', 'mg'), ('vitamin A', 'IU'), ('folate', 'mcg')),
scale(unit, factor) AS (VALUES ('g', 1e6), ('mg', 1e3), ('mcg', 1e0)),
named AS (SELECT a.*, first_unit, CASE WHEN a.unit = '' THEN coalesce(first_unit, '') ELSE a.unit END AS src FROM amounts a LEFT JOIN basis USING (nutrient)),
joined AS (
  SELECT n.*, s.factor AS sf, dt.dv AS dt, ds.dv AS ds FROM named n LEFT JOIN scale s ON s.unit = n.src
  LEFT JOIN daily dt ON dt.nutrient = n.nutrient AND dt.unit = 'mcg' LEFT JOIN daily ds ON ds.nutrient = n.nutrient AND ds.unit = n.src),
done AS (
  SELECT *, CASE WHEN first_unit IS NULL THEN 'failed' WHEN src = 'mcg' THEN 'same' WHEN sf IS NOT NULL THEN 'converted'
    WHEN src = 'percent' AND dt IS NOT NULL THEN 'converted' WHEN dt IS NOT NULL AND ds IS NOT NULL THEN 'converted' ELSE 'failed' END AS status FROM joined)"""


def micrograms(t: Tables) -> DataFrame:
    """The amounts with ``c``, what they are in micrograms."""
    amount = F.col("amount").cast("string")
    return nut.with_converted(measures(t), "c", F.col("nutrient"), F.col("unit"), F.lit("mcg"), amount)


@query(
    "convert_units",
    f"""WITH {CONVERT} SELECT l_orderkey, l_linenumber, nutrient, status,
    CASE WHEN status = 'failed' THEN src ELSE 'mcg' END AS unit_name,
    round(CASE WHEN status <> 'converted' THEN amount WHEN sf IS NOT NULL THEN amount * sf / 1e0
      WHEN src = 'percent' THEN amount * dt / 100 ELSE amount * dt / ds END, 6) AS amount FROM done""",
)
def convert_units(t: Tables) -> DataFrame:
    """Every amount to micrograms: mass scale, percent of the daily value, ratio of daily values, or failed."""
    return micrograms(t).select(
        "l_orderkey", "l_linenumber", "nutrient", "c.status", "c.unit_name", F.round("c.amount", 6).alias("amount")
    )


@query("conversion_audit", f"WITH {CONVERT} SELECT nutrient, src AS unit_name, count(*) AS docs FROM done WHERE status = 'failed' GROUP BY ALL")
def conversion_audit(t: Tables) -> DataFrame:
    """Amounts whose conversion failed, by nutrient and unit."""
    return micrograms(t).where("c.status = 'failed'").groupBy("nutrient", "c.unit_name").agg(F.count(F.lit(1)).alias("docs"))


@query(
    "convert_iu",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 3 THEN 'mcg' WHEN 5 THEN 'mcg' WHEN 1 THEN 'g' WHEN 2 THEN 'mg' WHEN 4 THEN 'mg'
      WHEN 6 THEN 'mcg' ELSE 'stardust' END AS unit_name,
    round(l_quantity * CASE l_linenumber WHEN 3 THEN 20 WHEN 5 THEN 1500 WHEN 1 THEN 65 WHEN 2 THEN 2400 WHEN 4 THEN 1000
      WHEN 6 THEN 400 ELSE 100 END / 100, 6) AS amount FROM lineitem""",
)
def convert_iu(t: Tables) -> DataFrame:
    rows = measures(t).withColumn("c", nut.convert_iu(F.col("nutrient"), F.col("amount")))
    return rows.select("l_orderkey", "l_linenumber", "c.unit_name", F.round("c.amount", 6).alias("amount"))


RECIPES = FACTS + """,
fixed AS (
  SELECT fid, description, 
    CASE o_orderstatus WHEN 'P' THEN (lo_line * 100)::DOUBLE * 1e3 / 1e6 ELSE hi_line::DOUBLE END AS fat,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN floor(hi_qty) ELSE floor(hi_qty) * 65 / 100 END AS protein,
    CASE o_orderstatus WHEN 'O' THEN hi_line::DOUBLE * 1e6 / 1e3 ELSE floor(hi_qty) END AS sodium,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL ELSE floor(lo_qty) END AS fiber,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN hi_line * 10e0 * 1500 / 5000 WHEN o_orderpriority = '3-MEDIUM' THEN hi_line * 10e0 * 1500 / 100
         ELSE hi_line * 10e0 END AS "vitamin A", floor(hi_qty) AS calories, lines::DOUBLE AS servings, lo_line::DOUBLE AS stardust
  FROM facts WHERE lines IS NOT NULL)"""


@query(
    "fix_recipe_units",
    f"""WITH {RECIPES} SELECT fid, round(fat, 6) AS fat, round(protein, 6) AS protein, round(sodium, 6) AS sodium, fiber,
    round("vitamin A", 6) AS "vitamin A", calories, servings, stardust, 'g' AS fat_unit, 'mg' AS sodium_unit, 'mcg' AS "vitamin A_unit", 'pinch' AS stardust_unit FROM fixed""",
)
def fix_recipe_units(t: Tables) -> DataFrame:
    """Recipe bags renamed and brought to the unit of each nutrient."""
    bag = F.col("n")
    docs = views.recipes(t).select("fid", nut.fix_recipes_labels(F.col("nutrients")).alias("n"))
    amounts = ["fat", "protein", "sodium", "fiber", "vitamin A", "calories", "servings", "stardust"]
    return docs.select(
        "fid", *[F.round(bag[k]["amount"], 6).alias(k) for k in amounts],
        *[bag[k]["unit_name"].alias(f"{k}_unit") for k in ("fat", "sodium", "vitamin A", "stardust")],
    )


@query(
    "score_recipe",
    f"""WITH {RECIPES} SELECT fid, round(0e0 + coalesce(protein, 0) / 65 * 0.2e0 + coalesce(fiber, 0) / 30 * 0.2e0
      + coalesce(len(list_filter(regexp_extract_all(lower(description), '{WORD}'), lambda w: w IN ('red', 'gizmo'))), 0) * 0.2e0
      - fat / 65 * 0.15e0 - sodium / 2400 * 0.2e0, 6) + 0e0 AS score FROM fixed""",
)
def score_recipe(t: Tables) -> DataFrame:
    docs = with_once(views.recipes(t), "nutrients", nut.fix_recipes_labels(F.col("nutrients")))
    return score_recipes(docs, views._score).select("fid", "score")


RECIPE_TEXT = """recipe AS (SELECT fid, description, o_orderstatus, hi_line, lo_line, hi_qty, lo_qty, lines,
    o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, o_orderpriority = '3-MEDIUM' AS medium FROM facts WHERE lines IS NOT NULL),
units AS (
  SELECT fid, 1 AS place, 'total_fat' AS field, CASE o_orderstatus WHEN 'P' THEN 'milligram' ELSE 'gram' END AS unit, (CASE o_orderstatus WHEN 'P' THEN lo_line * 100 ELSE hi_line END)::VARCHAR AS v FROM recipe
  UNION ALL SELECT fid, 2, 'protein', CASE WHEN urgent THEN 'grams' WHEN medium THEN 'g' ELSE 'percentage' END, hi_qty::INT::VARCHAR FROM recipe
  UNION ALL SELECT fid, 3, 'sodium', CASE o_orderstatus WHEN 'O' THEN 'gram' ELSE 'milligram' END, (CASE o_orderstatus WHEN 'O' THEN hi_line ELSE hi_qty::INT END)::VARCHAR FROM recipe
  UNION ALL SELECT fid, 4, 'dietary_fiber', CASE WHEN urgent THEN NULL ELSE 'gram' END, CASE WHEN urgent THEN NULL WHEN medium THEN 'na' ELSE lo_qty::INT || '%' END FROM recipe
  UNION ALL SELECT fid, 5, 'vitamin A', CASE WHEN urgent THEN 'IU' WHEN medium THEN 'percentage' ELSE 'mcg' END, (hi_line * 10)::VARCHAR FROM recipe
  UNION ALL SELECT fid, 6, 'calories', 'kcal', hi_qty::INT::VARCHAR FROM recipe
  UNION ALL SELECT fid, 7, 'servings', 'na', lines::VARCHAR FROM recipe
  UNION ALL SELECT fid, 8, 'stardust', 'pinch', lo_line::VARCHAR FROM recipe
  UNION ALL SELECT fid, 9, 'stardust', 'cup', '9' FROM recipe)"""


@query(
    "flatten_text",
    f"""WITH {FACTS}, {RECIPE_TEXT} SELECT fid, string_agg(CASE WHEN place = 9 THEN '' ELSE field || ': ' END || CASE WHEN unit IS NULL THEN '' ELSE unit || ': ' || v || '/n' END, '' ORDER BY place) AS text
    FROM units GROUP BY fid""",
)
def flatten_text(t: Tables) -> DataFrame:
    """The whole bag of every recipe in the old text form."""
    return views.recipes(t).select("fid", txt.flatten_map("nutrients", nested=True).alias("text"))


@query(
    "parse_text",
    f"""WITH {FACTS} SELECT fid, CASE o_orderstatus WHEN 'P' THEN 'milligram' ELSE 'gram' END AS fat_unit,
    CASE o_orderstatus WHEN 'P' THEN lo_line * 100 ELSE hi_line END::VARCHAR AS fat, lines::VARCHAR AS servings FROM facts WHERE lines IS NOT NULL""",
)
def parse_text(t: Tables) -> DataFrame:
    """Old text form of the whole bag back to fields; fields with one unit come back as they were."""
    bag = F.col("m")
    return views.recipes(t).select("fid", txt.parse_text(txt.flatten_map("nutrients", nested=True)).alias("m")).select(
        "fid", bag["total_fat"]["units"].alias("fat_unit"), bag["total_fat"]["value"].alias("fat"), bag["servings"]["value"].alias("servings"),
    )


@query(
    "text_round_trip",
    f"""WITH {FACTS}, {RECIPE_TEXT} SELECT fid, string_agg(field || '|' || coalesce(unit, '') || '|' || coalesce(v, ''), ';' ORDER BY place) AS bag, 1 AS same
    FROM units GROUP BY fid""",
)
def text_round_trip(t: Tables) -> DataFrame:
    """Whole bags written as text and read back: every field with every unit."""
    rows = with_once(views.recipes(t), "back", txt.parse_fields(txt.flatten_fields("nutrients")))
    none = F.array(F.struct(F.lit("").alias("key"), F.lit("").alias("value")))

    def listed(bag: str) -> Column:
        def units(e: Column) -> Column:
            entries = F.when(F.size(e["value"]) > 0, F.map_entries(e["value"])).otherwise(none)
            return F.transform(entries, lambda u: F.concat_ws("|", e["key"], u["key"], u["value"]))

        return F.array_join(F.flatten(F.transform(F.map_entries(F.col(bag)), units)), ";")

    return rows.select("fid", listed("back").alias("bag"), (listed("back") == listed("nutrients")).cast("int").alias("same"))


@query(
    "append_null_keys",
    """WITH docs AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS k, o_orderkey AS v FROM orders)
    SELECT 'collection' AS part, k, min(v) AS v, 1 AS n FROM docs WHERE k IS NOT NULL GROUP BY k
    UNION ALL SELECT 'quarantine', NULL, NULL, count(*) FROM docs WHERE k IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'added by the second call', NULL, NULL, 0""",
)
def append_null_keys(t: Tables) -> DataFrame:
    """Documents with repeated and null keys appended twice: the first of each key is added once, the keyless are set aside."""
    docs = t("orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("k"), F.col("o_orderkey").alias("v"))
    path = fresh_path(t.spark, "keyed")
    tables.append_new(docs, path, "k", "v")
    again = tables.append_new(docs, path, "k", "v")
    one = F.lit(1).cast("bigint")
    kept = tables.scan(t.spark, path).select(F.lit("collection").alias("part"), "k", "v", one.alias("n"))
    lost = tables.keyless(docs, "k").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    none = F.lit(None).cast("bigint")
    second = t.spark.range(1).select(F.lit("added by the second call").alias("part"), none.alias("k"), none.alias("v"), F.lit(again).cast("bigint").alias("n"))
    return kept.unionByName(lost.select(F.lit("quarantine").alias("part"), none.alias("k"), none.alias("v"), "n")).unionByName(second)


# --- tokens, superfoods, vectors ----------------------------------------------------------------------------------


@query(
    "token_counts",
    f"SELECT token, count(*) AS uses, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS token FROM documents) GROUP BY token",
)
def token_counts(t: Tables) -> DataFrame:
    # dealt out by the key first: moving a text costs less than finding its tokens, and (doc_id, token) needs no exchange then
    rows = cat.token_rows(t("documents").repartition("doc_id"), "doc_id", "text")
    return rows.groupBy("token").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("docs"))


#: Phrases of one and two words: how the documents begin.
PHRASES = f"""w AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS t FROM documents),
lex AS (SELECT t[1] AS phrase FROM w WHERE len(t) >= 1 UNION SELECT t[1] || ' ' || t[2] FROM w WHERE len(t) >= 2),
grams AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS phrase FROM w),
hits AS (SELECT doc_id, phrase, count(*) AS n FROM grams WHERE phrase IN (SELECT phrase FROM lex) GROUP BY ALL)"""


def beginnings(t: Tables) -> DataFrame:
    """The first word and the first two words of every document."""
    words = with_once(t("documents").select("text"), "w", txt.tokens("text")).where(F.size("w") > 0)
    return words.select(F.explode(F.array(F.get("w", F.lit(0)), F.concat_ws(" ", F.slice("w", 1, 2)))).alias("phrase"))


@query("phrase_hits", f"WITH {PHRASES} SELECT phrase, sum(n)::BIGINT AS uses, count(*) AS docs FROM hits GROUP BY phrase")
def phrase_hits(t: Tables) -> DataFrame:
    """Where else the beginnings of the documents stand in all texts."""
    hits = phrases.phrase_hits(t("documents"), "doc_id", "text", beginnings(t))
    return hits.groupBy("phrase").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("docs"))


@query(
    "phrase_bonus",
    f"WITH {PHRASES} SELECT d.doc_id, round(coalesce(n, 0) * 0.2e0, 6) AS bonus FROM documents d LEFT JOIN (SELECT doc_id, sum(n) AS n FROM hits GROUP BY doc_id) h ON h.doc_id = d.doc_id",
)
def phrase_bonus(t: Tables) -> DataFrame:
    """Bonus of every document by a lexicon of thousands of phrases."""
    return phrases.phrase_bonus(t("documents"), "doc_id", "text", beginnings(t)).select("doc_id", F.round("bonus", 6).alias("bonus"))


@query("category_lexicon", f"SELECT DISTINCT p_type AS category, unnest(regexp_extract_all(lower(p_name), '{WORD}')) AS keyword FROM part")
def category_lexicon(t: Tables) -> DataFrame:
    """Keywords of every part type."""
    return cat.category_lexicon(t("part"), "p_type", "p_name")


@query(
    "superfood_bonus",
    f"SELECT doc_id, round(len(list_filter(regexp_extract_all(lower(text), '{WORD}'), lambda w: w IN ('the', 'and', 'les'))) * 0.2e0, 6) AS bonus FROM documents",
)
def bonus(t: Tables) -> DataFrame:
    """Token bonus over whole texts, with a lexicon of words that occur in them."""
    docs = t("documents")
    return docs.select("doc_id", F.round(superfood_bonus(F.col("text"), ["the", "and", "les"]), 6).alias("bonus"))


@query(
    "drop_words",
    f"SELECT doc_id, len(list_distinct(list_filter(regexp_extract_all(lower(text), '{WORD}'), lambda w: w NOT IN ('the', 'and', 'les')))) AS words FROM documents",
)
def drop_words(t: Tables) -> DataFrame:
    """Distinct words of a text that are not in a removal lexicon."""
    left = txt.drop_words(txt.tokens("text"), ["the", "and", "les"])
    return t("documents").select("doc_id", F.size(left).cast("bigint").alias("words"))


VECTORS = f"""words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '{WORD}')) AS token FROM part),
token_vectors AS (
  SELECT token, embedding::DOUBLE[] AS vector FROM (
    SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id FROM words)
  JOIN embeddings USING (vec_id)),
lexicon AS (SELECT DISTINCT p_type AS category, p_name AS keyword FROM part),
cat_dims AS (
  SELECT category, i, avg(x) AS m FROM (
    SELECT category, unnest(vector) AS x, generate_subscripts(vector, 1) AS i
    FROM (SELECT category, unnest(regexp_extract_all(lower(keyword), '{WORD}')) AS token FROM lexicon) JOIN token_vectors USING (token))
  GROUP BY category, i),
centroids AS (SELECT category, list(m ORDER BY i) AS cv FROM cat_dims GROUP BY category),
names AS (SELECT DISTINCT p_name FROM part),
name_dims AS (
  SELECT p_name, i, avg(x) AS m FROM (
    SELECT p_name, unnest(vector) AS x, generate_subscripts(vector, 1) AS i
    FROM (SELECT p_name, unnest(regexp_extract_all(lower(p_name), '{WORD}')) AS token FROM names) JOIN token_vectors USING (token))
  GROUP BY p_name, i),
name_vectors AS (SELECT p_name, list(m ORDER BY i) AS nv FROM name_dims GROUP BY p_name),
sims AS (SELECT p_name, category, round(list_cosine_similarity(nv, cv), 9) AS sim FROM name_vectors, centroids)"""


@query(
    "token_lookup",
    f"WITH {VECTORS} SELECT token, round(vector[1], 6) AS first, round(list_sum(vector), 6) AS total FROM token_vectors",
)
def token_lookup(t: Tables) -> DataFrame:
    found = views.token_vectors(t, views.name_tokens(t))
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return found.select("token", F.round(F.col("vector")[0].cast("double"), 6).alias("first"), F.round(total, 6).alias("total"))


@query(
    "category_centroids",
    f"WITH {VECTORS} SELECT category, i - 1 AS pos, round(m, 6) AS m FROM cat_dims",
)
def category_centroids(t: Tables) -> DataFrame:
    centroids = cat.category_centroids(views.lexicon(t), views.token_vectors(t, views.name_tokens(t)))
    rows = centroids.select("category", F.posexplode("vector").alias("pos", "m"))
    return rows.select("category", F.col("pos").cast("bigint").alias("pos"), F.round("m", 6).alias("m"))


def _part_vectors(t: Tables, words: DataFrame) -> DataFrame:
    rows = cat.token_rows(t("part").select("p_partkey", "p_name"), "p_partkey", "p_name")
    return cat.text_vectors(rows, "p_partkey", words)


@query(
    "description_vectors",
    f"WITH {VECTORS} SELECT p_partkey, round(nv[1], 6) AS first, round(nv[64], 6) AS last FROM part JOIN name_vectors USING (p_name)",
)
def description_vectors(t: Tables) -> DataFrame:
    vectors = _part_vectors(t, views.token_vectors(t, views.name_tokens(t)))
    return vectors.select("p_partkey", F.round(F.col("vector")[0], 6).alias("first"), F.round(F.col("vector")[63], 6).alias("last"))


@query(
    "rank_categories",
    f"""WITH {VECTORS} SELECT p_partkey, category, round(sim, 6) AS sim, row_number() OVER (PARTITION BY p_partkey ORDER BY sim DESC, category) AS rank
    FROM part JOIN sims USING (p_name)""",
)
def rank_categories(t: Tables) -> DataFrame:
    words = materialise(views.token_vectors(t, views.name_tokens(t)), "token-vectors")
    centroids = cat.category_centroids(views.lexicon(t), words)
    ranked = cat.rank_categories(_part_vectors(t, words), "p_partkey", centroids)
    return ranked.select("p_partkey", "category", F.round("sim", 6).alias("sim"), "rank")


@query(
    "assign_category",
    f"""WITH {FACTS}, {VECTORS}, best AS (SELECT p_name, category FROM sims QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY sim DESC, category) = 1)
    SELECT fid, category FROM facts LEFT JOIN best ON p_name = description""",
)
def assign_category(t: Tables) -> DataFrame:
    """Category of every food by its description; foods without a description have none."""
    docs = materialise(views.order_facts(t).select("fid", "description"), "descriptions")
    words = views.token_vectors(t, views.name_tokens(t))
    return cat.categorise(docs, "description", views.lexicon(t), words).select("fid", "category")


@query(
    "centroid_similarity",
    """WITH dims AS (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL),
    centroids AS (SELECT label::VARCHAR AS category, list(m ORDER BY i) AS cv FROM dims GROUP BY label),
    sims AS (SELECT vec_id, category, list_cosine_similarity(embedding::DOUBLE[], cv) AS sim FROM embeddings, centroids)
    SELECT vec_id, arg_max(category, sim) AS category, round(max(sim), 6) AS sim FROM sims GROUP BY vec_id""",
)
def centroid_similarity(t: Tables) -> DataFrame:
    """Each vector with the nearest label centroid."""
    vectors = t("embeddings")
    centroids = cat.group_centroids(vectors, "label", "embedding")
    best = cat.best_category(vectors.select("vec_id", F.col("embedding").alias("vector")), "vec_id", centroids)
    return best.select("vec_id", "category", F.round("sim", 6).alias("sim"))


@query(
    "label_similarity",
    """WITH first_vec AS (SELECT label, arg_min(embedding, vec_id) AS f FROM embeddings GROUP BY label)
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], f::DOUBLE[]), 6) AS sim FROM embeddings JOIN first_vec USING (label)""",
)
def label_similarity(t: Tables) -> DataFrame:
    """Cosine similarity of every vector with the first vector of its label."""
    vectors = t("embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("f"))
    return vectors.join(first, "label").select("vec_id", F.round(cosine(F.col("embedding"), F.col("f")), 6).alias("sim"))


# --- embeddings ---------------------------------------------------------------------------------------------------


def embedding_sql(size: int, seed: int) -> str:
    return f"""WITH words AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS token FROM documents),
    hashed AS (SELECT id, ('0x' || substr(md5(token || '{seed}'), 1, 9))::BIGINT AS h FROM words),
    sums AS (SELECT id, (h >> 4) % {size} AS pos, sum(CASE WHEN h & 1 = 1 THEN 1 ELSE -1 END)::DOUBLE AS s FROM hashed GROUP BY ALL),
    units AS (SELECT id, pos, (s / sqrt(sum(s * s) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS v FROM sums)
    SELECT id, pos, round(v, 4) AS v FROM units WHERE v <> 0"""


def _entries(embedded: DataFrame) -> DataFrame:
    rows = embedded.select("id", F.posexplode("embedding").alias("pos", "v")).where(F.col("v") != 0)
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("v").cast("double"), 4).alias("v"))


@query("embed_texts", embedding_sql(64, 1))
def embed_texts(t: Tables) -> DataFrame:
    """Whole texts encoded by the seeded hashing encoder: the entries of every vector."""
    return _entries(emb.embed(t("documents"), "doc_id", "text"))


@query("embed_other_encoder", embedding_sql(128, 3))
def embed_other_encoder(t: Tables) -> DataFrame:
    """Another encoder by its alias."""
    return _entries(emb.embed(t("documents"), "doc_id", "text", "hashing-128"))


@query("embed_batches", "SELECT batch, count(*) AS n FROM (SELECT ntile(10) OVER (ORDER BY doc_id) AS batch FROM documents) GROUP BY batch")
def embed_batches(t: Tables) -> DataFrame:
    """Ten even batches of embedded texts."""
    done = emb.embed_in_batches(t("documents"), "doc_id", "text")
    return done.where(F.size("embedding") > 0).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query(
    "write_vectors",
    """WITH f AS (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source)
    SELECT doc_id, source AS id, CASE WHEN doc_id IN (SELECT doc_id FROM f) THEN 64 END AS size FROM documents""",
)
def write_vectors(t: Tables) -> DataFrame:
    """Vectors of the sources' names set on the first document of each source."""
    docs = t("documents").select("doc_id", F.col("source").alias("id"))
    vectors = emb.embed(docs.select("id").distinct(), "id", "id")
    done = emb.write_back(docs.withColumn("embedding", F.lit(None).cast("array<float>")), vectors, "id", "doc_id")
    return done.select("doc_id", "id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("size"))


@query("vectors_not_found", "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)")
def vectors_not_found(t: Tables) -> DataFrame:
    """Vector updates whose id no document has."""
    updates = t("embeddings").select("vec_id")
    return keys_not_found(updates, t("labels").select(F.col("doc_id").alias("vec_id")), "vec_id")
