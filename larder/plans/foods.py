"""Queries over food documents: scores, search aggregations, filters, joins, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import dims
from larder.functions.nutrients import prefer
from larder.operators import aggregates as agg
from larder.operators import filters, joins, splits
from larder.operators.ranks import value_counts
from larder.plans import views
from larder.plans.registry import FACTS, FEATURE_LIST, FEATURES_SQL, FOODS, LABELED_SQL, bucket_sql, query
from larder.plans.views import Tables
from larder.schemas import FEATURES
from larder.session import materialise


def r6(column: str) -> Column:
    return F.round(F.col(column), 6).alias(column)


# --- scores -------------------------------------------------------------------------------------------------------


@query("score_food", f"WITH {FOODS} SELECT fid, description, score FROM scored")
def score_food(t: Tables) -> DataFrame:
    return views.scored_foods(t).select("fid", "description", "score")


@query(
    "score_enriched",
    f"""WITH {FACTS} SELECT fid, CASE WHEN lines IS NULL THEN 0e0 WHEN o_orderstatus = 'F' THEN lo_qty ELSE hi_qty END AS protein,
    CASE WHEN lines IS NULL THEN 'none' WHEN o_orderstatus = 'F' THEN 'label' ELSE 'food' END AS source FROM facts""",
)
def score_enriched(t: Tables) -> DataFrame:
    """Label facts joined from their own table, with the food's own nutrients as fallback."""
    docs = views.food_docs(t).drop("labelNutrients")
    facts = views.food_docs(t).where(F.col("labelNutrients").isNotNull()).select("fdc_id", F.col("labelNutrients").alias("label"))
    done = joins.enrich(docs, facts)
    source = F.when(F.col("labelNutrients").isNull(), "none").when(F.col("labelNutrients")["iron"].isNull(), "label").otherwise("food")
    return done.select("fid", F.coalesce(F.col("labelNutrients")["protein"]["amount"], F.lit(0.0)).alias("protein"), source.alias("source"))


def stored_scores(t: Tables) -> DataFrame:
    """The scored collection, written once: the queries on it take several scans."""
    return materialise(views.scored_foods(t).select("fid", "score"), "scores")


# --- search aggregations ------------------------------------------------------------------------------------------

HIT = "SELECT '{name}' AS name, row_number() OVER (ORDER BY score {way}, fid) AS rank, score AS value, NULL::BIGINT AS n, fid AS doc FROM scored ORDER BY score {way}, fid LIMIT 2"


@query(
    "named_aggs",
    f"""WITH {FOODS},
    mode AS (SELECT score, count(*) AS n FROM scored GROUP BY score ORDER BY n DESC, score LIMIT 1)
    SELECT 'min_score' AS name, 1::BIGINT AS rank, min(score) AS value, NULL::BIGINT AS n, NULL::BIGINT AS doc FROM scored
    UNION ALL SELECT 'max_score', 1, max(score), NULL, NULL FROM scored
    UNION ALL SELECT 'zero_score_docs', 1, score, n, NULL FROM mode
    UNION ALL (SELECT * FROM ({HIT.format(name='highest_score_docs', way='DESC')}))
    UNION ALL (SELECT * FROM ({HIT.format(name='lowest_score_docs', way='ASC')}))""",
)
def named_aggs(t: Tables) -> DataFrame:
    return agg.named_aggregations(stored_scores(t))


@query("score_min_max", f"WITH {FOODS} SELECT min(score) AS min_score, max(score) AS max_score FROM scored")
def score_min_max(t: Tables) -> DataFrame:
    return views.scored_foods(t).agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"))


@query("score_mode", f"WITH {FOODS} SELECT score, count(*) AS n FROM scored GROUP BY score ORDER BY n DESC, score LIMIT 1")
def score_mode(t: Tables) -> DataFrame:
    return agg.modal_values(views.scored_foods(t), "score")


@query("top_hits_desc", f"WITH {FOODS} SELECT fid, description, score FROM scored ORDER BY score DESC, fid LIMIT 2")
def top_hits_desc(t: Tables) -> DataFrame:
    return agg.top_hits(views.scored_foods(t).select("fid", "description", "score"), "score", "fid")


@query("top_hits_asc", f"WITH {FOODS} SELECT fid, description, score FROM scored ORDER BY score, fid LIMIT 2")
def top_hits_asc(t: Tables) -> DataFrame:
    return agg.top_hits(views.scored_foods(t).select("fid", "description", "score"), "score", "fid", ascending=True)


@query(
    "hits",
    f"WITH {FOODS} SELECT fid, description, score FROM scored WHERE description LIKE 'red %' ORDER BY fid LIMIT 10",
)
def hits(t: Tables) -> DataFrame:
    """Documents of a query, first page in a fixed order."""
    found = views.scored_foods(t).where(F.col("description").startswith("red "))
    return filters.preview(found.select("fid", "description", "score"), [F.col("fid")], 10)


@query("count_docs", f"WITH {FOODS} SELECT count(*) AS docs, count(score) AS scored_docs FROM scored")
def count_docs(t: Tables) -> DataFrame:
    return views.scored_foods(t).agg(F.count(F.lit(1)).alias("docs"), F.count("score").alias("scored_docs"))


@query(
    "value_counts",
    f"WITH {FOODS} SELECT description, count(*) AS n FROM scored GROUP BY description",
)
def counts_by_description(t: Tables) -> DataFrame:
    return value_counts(views.scored_foods(t), "description")


@query(
    "describe_scores",
    f"""WITH {LABELED_SQL} SELECT label, count(score) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std,
    min(score) AS min, max(score) AS max, round(quantile_cont(score, 0.25), 6) AS p25,
    round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.75), 6) AS p75 FROM labeled GROUP BY label""",
)
def describe_scores(t: Tables) -> DataFrame:
    stats = agg.describe(views.labeled_features(t), ["label"], "score")
    return stats.select("label", "n", r6("mean"), r6("std"), "min", "max", r6("p25"), r6("p50"), r6("p75"))


@query(
    "describe_prices",
    """SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 3) AS mean, round(stddev_samp(l_extendedprice), 3) AS std,
    min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.25), 3) AS p25,
    round(quantile_cont(l_extendedprice, 0.5), 3) AS p50, round(quantile_cont(l_extendedprice, 0.75), 3) AS p75 FROM lineitem""",
)
def describe_prices(t: Tables) -> DataFrame:
    stats = agg.describe(t("lineitem"), [], "l_extendedprice")
    return stats.select("n", "min", "max", *[F.round(c, 3).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


# --- filters and projections --------------------------------------------------------------------------------------


@query("term_filter", f"WITH {LABELED_SQL} SELECT fid, description, score FROM labeled WHERE label = 'validation'")
def term_filter(t: Tables) -> DataFrame:
    return filters.term(views.labeled_features(t), "label", "validation").select("fid", "description", "score")


@query(
    "term_lookup",
    "SELECT o_orderkey AS fid, o_custkey AS owner FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O'",
)
def term_lookup(t: Tables) -> DataFrame:
    """Two keyword terms, pushed down to the scan."""
    docs = t("orders").select(F.col("o_orderkey").alias("fid"), F.col("o_custkey").alias("owner"), "o_orderpriority", "o_orderstatus")
    return filters.term(filters.term(docs, "o_orderpriority", "3-MEDIUM"), "o_orderstatus", "O").select("fid", "owner")


@query("exists_filter", f"WITH {FACTS} SELECT fid FROM facts WHERE lines IS NOT NULL")
def exists_filter(t: Tables) -> DataFrame:
    return filters.any_exists(views.food_docs(t), ["nutrients", "labelNutrients"]).select("fid")


@query(
    "source_projection",
    f"""WITH {FACTS} SELECT fid, CASE WHEN lines IS NOT NULL THEN
      'Fiber, soluble: ' || round(lo_tax * 100, 3) || ';Fiber, total dietary: ' || round(hi_tax * 100, 3) END AS fibers FROM facts""",
)
def source_projection(t: Tables) -> DataFrame:
    """Wildcard include ``food_nutrients.Fiber*`` on a map."""
    kept = filters.source_fields(views.raw_foods(t), ["fid", "food_nutrients.Fiber*"])
    parts = F.transform(
        F.sort_array(F.map_entries("food_nutrients")),
        lambda e: F.concat(e["key"], F.lit(": "), F.round(e["value"]["amount"], 3).cast("string")),
    )
    return kept.select("fid", F.array_join(parts, ";").alias("fibers"))


@query(
    "no_category",
    f"WITH {FOODS} SELECT fid FROM scored WHERE description IS NULL",
)
def no_category(t: Tables) -> DataFrame:
    docs = views.food_docs(t).withColumn("category", F.split("description", " ")[0])
    return filters.without_category(docs).select("fid")


@query(
    "missing_audit",
    f"""WITH {FACTS} SELECT o_orderstatus, count(*) AS docs, sum(CASE WHEN lines IS NULL THEN 1 ELSE 0 END)::BIGINT AS "no_nutrients",
    sum(CASE WHEN lines IS NULL OR o_orderstatus <> 'F' THEN 1 ELSE 0 END)::BIGINT AS "no_labelNutrients" FROM facts GROUP BY 1""",
)
def missing_audit(t: Tables) -> DataFrame:
    return filters.missing_audit(views.food_docs(t), ["nutrients", "labelNutrients"], ["o_orderstatus"])


@query(
    "feature_rows",
    f"WITH {FEATURES_SQL} SELECT fid, description, score, {FEATURE_LIST} FROM feature_rows",
)
def feature_rows(t: Tables) -> DataFrame:
    return views.features(t)


@query(
    "rename_drop",
    f"WITH {FEATURES_SQL} SELECT {FEATURE_LIST.replace('sodium', 'CASE WHEN fid % 7 = 0 THEN 0e0 ELSE sodium END AS sodium')}, score AS predictions FROM feature_rows",
)
def rename_drop(t: Tables) -> DataFrame:
    """Renamed and dropped columns; features that are missing in every seventh food become 0."""
    gaps = views.features(t).withColumn("sodium", F.when(F.col("fid") % 7 != 0, F.col("sodium")))
    rows = filters.rename(gaps, {"score": "predictions"})
    return filters.fill_zero(filters.drop_if_present(rows, ["fid", "description", "embedding"]), FEATURES)


@query("preview_rows", f"WITH {FEATURES_SQL} SELECT fid, score FROM feature_rows ORDER BY fid LIMIT 5")
def preview_rows(t: Tables) -> DataFrame:
    return filters.preview(views.features(t).select("fid", "score"), [F.col("fid")], 5)


@query(
    "before_ingest",
    f"WITH {FACTS} SELECT fid, CASE WHEN lines IS NULL THEN 0 ELSE 14 END AS entries FROM facts",
)
def before_ingest(t: Tables) -> DataFrame:
    """Absent bags become empty maps, the raw bag is dropped."""
    docs = views.food_docs(t).withColumn("food_nutrients", F.lit(None).cast("string"))
    return filters.before_ingest(docs).select("fid", F.size("nutrients").alias("entries"))


# --- joins --------------------------------------------------------------------------------------------------------


@query("anti_unlabeled", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_unlabeled(t: Tables) -> DataFrame:
    return joins.unlabeled(t("documents").select("doc_id", "lang"), t("labels"), "doc_id")


@query(
    "not_labeled_features",
    f"WITH {FEATURES_SQL} SELECT fid, score FROM feature_rows WHERE fid NOT IN (SELECT doc_id FROM labels)",
)
def not_labeled_features(t: Tables) -> DataFrame:
    """Feature rows whose id is not in the labelled set."""
    labeled = t("labels").select(F.col("doc_id").alias("fid"))
    return joins.unlabeled(views.features(t).select("fid", "score"), labeled)


@query("semi_known", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_known(t: Tables) -> DataFrame:
    return joins.known(t("documents").select("doc_id", "lang"), t("labels"), "doc_id")


@query(
    "incremental_ingest",
    f"""WITH {FOODS} SELECT fid, score FROM scored WHERE fid NOT IN (SELECT c_custkey FROM customer)""",
)
def incremental_ingest(t: Tables) -> DataFrame:
    """Score only documents whose id the collection (here: the customer keys) does not have."""
    collection = t("customer").select(F.col("c_custkey").alias("fdc_id"))
    fresh = joins.unknown(views.food_docs(t), collection)
    return filters.before_ingest(views.score_foods(fresh, views._score)).select("fid", "score")


UPSERT = """first_rows AS (SELECT o_custkey, min(o_orderkey) AS fid FROM orders GROUP BY o_custkey),
updates AS (SELECT c_custkey AS o_custkey, c_mktsegment AS category FROM customer WHERE c_acctbal > 0)"""


@query(
    "update_by_key",
    f"""WITH {UPSERT} SELECT o_orderkey AS fid, o_custkey AS id, coalesce(u.category, o_orderpriority) AS category
    FROM orders LEFT JOIN (SELECT f.fid, category FROM first_rows f JOIN updates USING (o_custkey)) u ON u.fid = o_orderkey""",
)
def update_by_key(t: Tables) -> DataFrame:
    """Category set on the first document of each updated id, old value kept elsewhere."""
    docs = t("orders").select(F.col("o_orderkey").alias("fid"), F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("category"))
    updates = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("category"))
    return joins.update_by_key(docs, updates, "id", "category", "fid")


@query("keys_not_found", "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def keys_not_found(t: Tables) -> DataFrame:
    updates = t("customer").select(F.col("c_custkey").alias("id"))
    return joins.keys_not_found(updates, t("orders").select(F.col("o_custkey").alias("id")), "id")


@query(
    "attach_predictions",
    f"""WITH {FEATURES_SQL} SELECT fid, score, prediction FROM feature_rows
    LEFT JOIN (SELECT event_id AS fid, "value" AS prediction FROM events) USING (fid)""",
)
def attach_predictions(t: Tables) -> DataFrame:
    found = t("events").select(F.col("event_id").alias("fid"), F.col("value").alias("prediction"))
    return joins.attach_predictions(views.features(t).select("fid", "score"), found)


@query(
    "pair_compare",
    f"""WITH {FEATURES_SQL},
    pairs AS (SELECT fid AS left_key, lead(fid) OVER (PARTITION BY description ORDER BY fid) AS right_key FROM feature_rows),
    both_sides AS (
      SELECT left_key, right_key, a.score >= b.score AS w, a.score - b.score AS ds, a.protein - b.protein AS dp,
             b.sodium - a.sodium AS dn FROM pairs JOIN feature_rows a ON a.fid = left_key JOIN feature_rows b ON b.fid = right_key)
    SELECT left_key, right_key, CASE WHEN w THEN left_key ELSE right_key END AS winner,
      concat_ws(',', CASE WHEN CASE WHEN w THEN dp > 0 ELSE dp < 0 END THEN 'protein' END,
                     CASE WHEN CASE WHEN w THEN dn > 0 ELSE dn < 0 END THEN 'sodium' END) AS reasons FROM both_sides""",
)
def pair_compare(t: Tables) -> DataFrame:
    """Each food against the next one of the same description: the winner by score, and why."""
    docs = materialise(views.features(t).select("fid", "description", "score", "protein", "sodium"), "features")
    pairs = joins.neighbour_pairs(docs, "fid", "description", "fid")
    return joins.compare_pairs(pairs, docs, "fid", "score", {"protein": True, "sodium": False})


@query(
    "concat_sets",
    f"WITH {LABELED_SQL} SELECT label, count(*) AS n, round(sum(score), 4) AS score_sum FROM labeled GROUP BY label",
)
def concat_sets(t: Tables) -> DataFrame:
    """The three labelled sets put together again."""
    rows = materialise(views.labeled_features(t).select("fid", "score", "label"), "labeled")
    sets = [filters.term(rows, "label", label) for label in splits.LABELS]
    return joins.concat_sets(*sets).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 4).alias("score_sum"))


# --- splits, windows, batches -------------------------------------------------------------------------------------

CAP = """capped AS (
  SELECT fid, score FROM (SELECT fid, score, row_number() OVER (ORDER BY fid) AS rn, count(*) OVER () AS n FROM scored)
  WHERE score <> 0 OR rn <= n * 15 // 100 + 1)"""


@query("zero_cap", f"WITH {FOODS}, {CAP} SELECT fid, score FROM capped")
def zero_cap(t: Tables) -> DataFrame:
    return splits.cap_zero_scores(stored_scores(t), "fid")


@query(
    "zero_cap_events",
    """SELECT event_id, score FROM (SELECT event_id, floor("value" / 25) AS score, row_number() OVER (ORDER BY event_id) AS rn,
    count(*) OVER () AS n FROM events) WHERE score <> 0 OR rn <= n * 15 // 100 + 1""",
)
def zero_cap_events(t: Tables) -> DataFrame:
    """The cap on a table in which a large part of the rows scores zero."""
    rows = t("events").select("event_id", F.floor(F.col("value") / 25).cast("double").alias("score"))
    return splits.cap_zero_scores(rows, "event_id")


SPLIT = f"""split AS (SELECT fid, score, CASE {bucket_sql('fid')} WHEN 0 THEN 'training' WHEN 1 THEN 'validation'
  ELSE 'testing' END AS label FROM capped)"""


@query("split_label", f"WITH {FOODS}, {CAP}, {SPLIT} SELECT fid, score, label FROM split")
def split_label(t: Tables) -> DataFrame:
    return splits.split_dataset(stored_scores(t), "fid")


@query(
    "split_sizes",
    f"""WITH {FOODS}, {CAP}, {SPLIT} SELECT label, count(*) AS actual,
    (CASE WHEN label = 'testing' THEN (SELECT count(*) FROM split) - 2 * ((SELECT count(*) FROM split) // 3)
          ELSE (SELECT count(*) FROM split) // 3 END)::BIGINT AS planned FROM split GROUP BY label""",
)
def split_sizes(t: Tables) -> DataFrame:
    return agg.split_sizes(splits.split_dataset(stored_scores(t), "fid"))


@query(
    "even_batches",
    "SELECT batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (SELECT o_orderkey, ntile(10) OVER (ORDER BY o_orderkey) AS batch FROM orders) GROUP BY batch",
)
def even_batches(t: Tables) -> DataFrame:
    rows = splits.even_batches(t("orders").select("o_orderkey"), "o_orderkey", 10)
    return rows.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "fixed_batches",
    "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM events",
)
def fixed_batches(t: Tables) -> DataFrame:
    rows = t("events").select("event_id", F.struct("ts", "event_id").alias("_o"))
    return splits.fixed_batches(rows, "_o", 100).select("event_id", "batch")


# --- audits -------------------------------------------------------------------------------------------------------


@query(
    "unit_audit",
    f"""WITH {FACTS} SELECT 'protein' AS nutrient, 'IU' AS unit_name, count(*) AS docs FROM facts
    WHERE lines IS NOT NULL AND o_orderstatus <> 'F' AND o_orderpriority = '5-LOW' HAVING count(*) > 0
    UNION ALL SELECT 'sugars', 'mg', count(*) FROM facts
    WHERE lines IS NOT NULL AND o_orderstatus <> 'F' AND o_orderpriority = '4-NOT SPECIFIED' HAVING count(*) > 0""",
)
def unit_audit(t: Tables) -> DataFrame:
    return agg.unit_audit(views.food_docs(t), prefer(F.col("labelNutrients"), F.col("nutrients")), dims.SCORE_TERMS)


NAMES = [
    "Protein", "Fiber, total dietary", "Total lipid (fat)", "Sugars, total including NLEA", "Sodium, Na",
    "Carbohydrate, by difference", "Fatty acids, total saturated", "Fatty acids, total trans", "Cholesterol",
    "Calcium, Ca", "Iron, Fe", "Potassium, K", "Energy", "Fiber, soluble", "Mystery compound",
]


@query(
    "distinct_names",
    f"WITH {FACTS} SELECT unnest({NAMES}) AS nutrient, count(*) AS docs FROM facts WHERE lines IS NOT NULL",
)
def distinct_names(t: Tables) -> DataFrame:
    return agg.distinct_names(views.raw_foods(t), F.col("food_nutrients"))


@query(
    "name_audit",
    f"WITH {FACTS} SELECT 'Mystery compound' AS nutrient, count(*) AS docs FROM facts WHERE lines IS NOT NULL",
)
def name_audit(t: Tables) -> DataFrame:
    return agg.unmapped_names(views.raw_foods(t), F.col("food_nutrients"), "food")


# --- measures -----------------------------------------------------------------------------------------------------


@query(
    "histogram_scores",
    f"""WITH {FEATURES_SQL}, e AS (SELECT min(score) lo, max(score) hi FROM feature_rows)
    SELECT bin, round(lo + (hi - lo) / 30 * bin, 6) AS bin_start, count(*) AS n
    FROM (SELECT least(floor((score - lo) / ((hi - lo) / 30)), 29)::BIGINT AS bin, lo, hi FROM feature_rows, e) GROUP BY bin, lo, hi""",
)
def histogram_scores(t: Tables) -> DataFrame:
    return agg.histogram(materialise(views.features(t).select("score"), "scores"), "score").select("bin", r6("bin_start"), "n")



