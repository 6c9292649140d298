"""Food, recipe, vector and prediction views over the given star-schema tables.

An order is a food document: its line items give the nutrient amounts, its first part gives the description.
Orders without line items are foods without nutrients.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.nutrients import fix_nutrition_labels, fix_units
from larder.functions.scoring import score_foods
from larder.functions.text import tokens
from larder.operators.filters import feature_rows
from larder.operators.splits import label_rows

# words of the part names that count as superfoods here
SUPERFOODS = ["red", "gizmo"]


class Tables:
    """The tables of one directory, as DataFrames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def _entry(name: str, amount: Column, unit: Column | str) -> list[Column]:
    unit_col = F.lit(unit) if isinstance(unit, str) else unit
    return [F.lit(name), F.struct(amount.cast("double").alias("amount"), unit_col.alias("unit_name"))]


def order_facts(t: Tables) -> DataFrame:
    """One row per order with the extremes of its line items; ``lines`` is null without line items."""
    c = F.col
    items = t("lineitem").groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("hi_qty"), F.min("l_quantity").alias("lo_qty"),
        F.max("l_discount").alias("hi_disc"), F.min("l_discount").alias("lo_disc"),
        F.max("l_tax").alias("hi_tax"), F.min("l_tax").alias("lo_tax"),
        F.max("l_extendedprice").alias("hi_price"), F.min("l_extendedprice").alias("lo_price"),
        F.max("l_linenumber").alias("hi_line"), F.min("l_linenumber").alias("lo_line"),
        F.min("l_partkey").alias("partkey"), F.count(F.lit(1)).alias("lines"),
    )
    orders = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    names = t("part").select(c("p_partkey").alias("partkey"), c("p_name").alias("description"))
    return (
        # joined by a shuffle at every size: the wide expressions on the bags then run on all cores, whatever the files' cut
        orders.join(items.hint("merge"), c("o_orderkey") == c("l_orderkey"), "left")
        .join(names, "partkey", "left")
        .withColumn("fid", c("o_orderkey"))
    )


def raw_bag() -> Column:
    """Nutrients under the names of the food files; two fiber names meet, one name is unknown."""
    c = F.col
    protein_unit = F.when(c("o_orderpriority") == "5-LOW", "IU").otherwise("g")
    sugar_unit = F.when(c("o_orderpriority") == "4-NOT SPECIFIED", "mg").otherwise("g")
    entries = [
        _entry("Protein", c("hi_qty"), protein_unit),
        _entry("Fiber, total dietary", c("hi_tax") * 100, "g"),
        _entry("Total lipid (fat)", c("hi_disc") * 100, "g"),
        _entry("Sugars, total including NLEA", c("lo_qty"), sugar_unit),
        _entry("Sodium, Na", c("hi_price") / 100, "mg"),
        _entry("Carbohydrate, by difference", c("lo_price") / 1000, "g"),
        _entry("Fatty acids, total saturated", c("lo_disc") * 100, "g"),
        _entry("Fatty acids, total trans", c("hi_line") / 10, "g"),
        _entry("Cholesterol", c("lines") * 10, "mg"),
        _entry("Calcium, Ca", c("o_totalprice") / 1000, "mg"),
        _entry("Iron, Fe", c("lo_line"), "mg"),
        _entry("Potassium, K", c("lines") * 50, "mg"),
        _entry("Energy", c("o_totalprice") / 500, "kcal"),
        _entry("Fiber, soluble", c("lo_tax") * 100, "g"),
        _entry("Mystery compound", c("hi_qty"), "mg"),
    ]
    return F.when(c("lines").isNotNull(), F.create_map(*[x for e in entries for x in e]))


def label_bag() -> Column:
    """Label facts ``map<name, struct<value>>`` of orders with status F."""
    c = F.col
    facts = {
        "protein": c("lo_qty"), "fat": c("lo_disc") * 100, "sodium": c("lo_price") / 100,
        "carbohydrates": c("hi_price") / 2000, "sugars": c("lo_line"), "fiber": c("hi_tax") * 50,
        "calories": c("o_totalprice") / 400, "vitamin D": c("hi_line"),
    }
    pairs = [x for n, v in facts.items() for x in (F.lit(n), F.struct(v.cast("double").alias("value")))]
    return F.when((c("o_orderstatus") == "F") & c("lines").isNotNull(), F.create_map(*pairs))


def raw_foods(t: Tables) -> DataFrame:
    """Raw documents with the file names of nutrients."""
    return order_facts(t).select(
        "fid", F.col("fid").alias("fdc_id"), "description", "o_orderstatus", "o_orderpriority",
        raw_bag().alias("food_nutrients"), label_bag().alias("facts"),
    )


def food_docs(t: Tables) -> DataFrame:
    """Normalised documents: canonical nutrients and label facts with units."""
    return raw_foods(t).select(
        F.concat(F.lit("food-"), F.col("fid")).alias("id"), "fid", "fdc_id", "description", "o_orderstatus", "o_orderpriority",
        fix_nutrition_labels(F.col("food_nutrients")).alias("nutrients"),
        fix_units(F.col("facts")).alias("labelNutrients"),
    )


def _score(bag: Column, description: Column) -> Column:
    from larder.functions.scoring import nutrient_score

    return F.round(nutrient_score(bag, description, superfoods=SUPERFOODS), 6)


def scored_foods(t: Tables) -> DataFrame:
    """Documents with their score, rounded to six places."""
    return score_foods(food_docs(t), _score)


def features(t: Tables) -> DataFrame:
    """Feature rows of the scored documents."""
    return feature_rows(scored_foods(t))


def labeled_features(t: Tables) -> DataFrame:
    """Feature rows with a training, validation or testing label."""
    return label_rows(features(t), "fid")


def recipes(t: Tables) -> DataFrame:
    """Recipes with nutrients ``{unit: value}`` in every form the source files use."""
    c = F.col
    urgent, medium = c("o_orderpriority").isin("1-URGENT", "2-HIGH"), c("o_orderpriority") == "3-MEDIUM"

    def sub(unit: Column | str, value: Column) -> Column:
        return F.create_map(unit if isinstance(unit, Column) else F.lit(unit), value.cast("string"))

    nothing = F.create_map().cast("map<string,string>")
    pairs = {
        "total_fat": F.when(c("o_orderstatus") == "P", sub("milligram", (c("lo_line") * 100).cast("int"))).otherwise(sub("gram", c("hi_line"))),
        "protein": sub(F.when(urgent, "grams").when(medium, "g").otherwise("percentage"), c("hi_qty").cast("int")),
        "sodium": F.when(c("o_orderstatus") == "O", sub("gram", c("hi_line"))).otherwise(sub("milligram", c("hi_qty").cast("int"))),
        "dietary_fiber": F.when(urgent, nothing).when(medium, sub("gram", F.lit("na"))).otherwise(sub("gram", F.concat(c("lo_qty").cast("int").cast("string"), F.lit("%")))),
        "vitamin A": sub(F.when(urgent, "IU").when(medium, "percentage").otherwise("mcg"), c("hi_line") * 10),
        "calories": sub("kcal", c("hi_qty").cast("int")),
        "servings": sub("na", c("lines")),
        "stardust": F.create_map(F.lit("pinch"), c("lo_line").cast("string"), F.lit("cup"), F.lit("9")),
    }
    bag = F.create_map(*[x for n, v in pairs.items() for x in (F.lit(n), v)])
    return order_facts(t).where(c("lines").isNotNull()).select("fid", "description", "o_orderstatus", "o_orderpriority", bag.alias("nutrients"))


def food_lines(t: Tables) -> DataFrame:
    """Damaged JSON lines as they arrive: ``=`` for ``:``, doubled quotes escapes and unknown escapes."""
    c = F.col
    return order_facts(t).select(
        "fid",
        F.concat(
            F.lit('{"_id"="food-'), c("fid"), F.lit('", "fid"= '), c("fid"), F.lit(', "fdc_id": '), c("fid"),
            F.lit(', "description": "'), F.coalesce("description", F.lit("")), F.lit(" \\q \\u00e9 "), c("o_orderpriority"),
            F.lit('", "food_nutrients": {'),
            F.when(
                c("lines").isNotNull(),
                F.concat(
                    F.lit('"Protein"= {"amount": '), c("hi_qty").cast("int"), F.lit(', "unit_name": "g"}, "Sodium, Na": {"amount": '),
                    c("lines"), F.lit(', "unit_name"= "mg"}'),
                ),
            ).otherwise(""),
            F.when(c("o_orderpriority") == "5-LOW", F.lit("}")).otherwise("}}"),
        ).alias("value"),
    )


def document_lines(t: Tables) -> DataFrame:
    """Whole texts as damaged JSON lines: a line break becomes an unknown escape, a quote a valid one."""
    body = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit("\\q")), F.lit('"'), F.lit('\\"'))
    return t("documents").select(
        "doc_id", F.concat(F.lit('{"doc"='), F.col("doc_id"), F.lit(', "text"="'), body, F.lit('"}')).alias("value")
    )


def prediction_log(t: Tables) -> DataFrame:
    """Events as a prediction log: ``value`` is the prediction, the number in ``props`` the target."""
    target = F.from_json("props", "k double")["k"]
    return t("events").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("model"), F.col("event_id").alias("fid"),
        target.alias("target"), F.col("value").alias("prediction"),
    )


def token_vectors(t: Tables, words: DataFrame) -> DataFrame:
    """``(token, vector)``: each distinct token gets the vector its md5 points to."""
    n = t("embeddings").agg(F.count(F.lit(1)).alias("n")).scalar()
    at = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("bigint") % n
    keyed = words.select("token").distinct().withColumn("vec_id", at)
    vectors = t("embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return keyed.join(vectors, "vec_id").select("token", "vector")


def lexicon(t: Tables) -> DataFrame:
    """Category lexicon from the part table: the type is the category, the name the keyword."""
    return t("part").select(F.col("p_type").alias("category"), F.col("p_name").alias("keyword")).distinct()


def name_tokens(t: Tables) -> DataFrame:
    return t("part").select(F.explode(tokens(F.col("p_name"))).alias("token"))


FEATURES = schemas.FEATURES
