"""Column functions against hand-worked cases."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from larder import dims
from larder.functions import nutrients as nut
from larder.functions import scoring
from larder.functions import text as txt
from larder.functions.vectors import cosine, mean_vectors, unit_vector

BAG = "map<string, struct<amount: double, unit_name: string>>"


def one(spark, value, schema, column):
    return spark.createDataFrame([(value,)], f"v {schema}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "line, fixed",
    [
        ('{"a"= 1}', '{"a": 1}'),
        (r'{"a": "x\y"}', r'{"a": "x\\y"}'),
        (r'{"a": "say \"hi\""}', r'{"a": "say \"hi\""}'),
        (r'{"a": "1\/2 é"}', r'{"a": "1\/2 é"}'),
        (r'{"a": "x\\y"}', r'{"a": "x\\y"}'),
        ('{"a": "u=v"}', '{"a": "u:v"}'),
    ],
)
def test_repair(spark, line, fixed):
    got = one(spark, line, "string", txt.repair_json_line)
    assert got == fixed
    json.loads(got)


def test_tokens(spark):
    assert one(spark, "Chia-Seeds, KALE (raw) é2", "string", txt.tokens) == ["chia-seeds", "kale", "raw", "é2"]
    assert one(spark, None, "string", txt.tokens) is None


def test_flatten_and_parse(spark):
    flat = one(spark, '{"tips": "stir", "time": "5"}', "string", lambda c: txt.flatten_map(F.from_json(c, "map<string,string>")))
    assert flat == "tips: stir/ntime: 5/n"
    nested = one(spark, {"fat": {"gram": "2.0"}}, "map<string,map<string,string>>", lambda c: txt.flatten_map(c, True))
    assert nested == "fat: gram: 2.0/n"
    back = one(spark, "fat: gram: 2.0/ntips: stir/n\nfat: mg: 3", "string", txt.parse_text)
    assert {k: tuple(v) for k, v in back.items()} == {"tips": ("", "stir"), "fat": ("mg", "3")}


def test_safe_json(spark):
    good = one(spark, '{"k": 3}', "string", lambda c: txt.safe_json(c, "k bigint"))
    assert good["ok"] and good["doc"]["k"] == 3 and good["text"] is None
    bad = one(spark, '{"k": ', "string", lambda c: txt.safe_json(c, "k bigint"))
    assert not bad["ok"] and bad["doc"] is None and bad["text"] == '{"k": '


def test_paths(spark):
    assert one(spark, "s3://bucket/a/b.json", "string", txt.key_of_path) == "a/b.json"
    assert one(spark, "x_processed.json", "string", txt.processed_sibling) == "x_davinci.json"


@pytest.mark.parametrize(
    "nutrient, source, target, raw, amount, unit, status",
    [
        ("sodium", "g", "mg", "2", 2000.0, "mg", "converted"),
        ("protein", "milligram", "g", "500", 0.5, "g", "converted"),
        ("protein", "mcg", "g", "1000000", 1.0, "g", "converted"),
        ("folate", "gram", "mcg", "2", 2e6, "mcg", "converted"),
        ("iron", "percentage", "mg", "50", 9.0, "mg", "converted"),
        ("iron", "mg", "mg", "12%", 2.16, "mg", "converted"),
        ("vitamin D", "IU", "mcg", "400", 10.0, "mcg", "converted"),
        ("vitamin D", "", "mcg", "400", 10.0, "mcg", "converted"),
        ("protein", "", "g", "4", 4.0, "g", "same"),
        ("protein", "cup", "g", "4", 4.0, "cup", "failed"),
        ("stardust", "g", "mg", "4", 4.0, "g", "failed"),
        ("protein", "iu", "g", "4", 4.0, "IU", "failed"),
        ("protein", "g", "mg", "na", None, "mg", "converted"),
        ("protein", "g", "g", "0", 0.0, "g", "same"),
    ],
)
def test_convert_units(spark, nutrient, source, target, raw, amount, unit, status):
    row = spark.range(1).select(
        nut.convert_units(F.lit(nutrient), F.lit(source), F.lit(target), F.lit(raw)).alias("c")
    ).first()["c"]
    assert row["unit_name"] == unit and row["status"] == status
    assert (row["amount"] is None) if amount is None else math.isclose(row["amount"], amount)


def test_round_trip_of_units(spark):
    for nutrient in ("protein", "sodium"):
        there = nut.convert_units(F.lit(nutrient), F.lit("g"), F.lit("mg"), F.lit("1.25"))
        back = nut.convert_units(F.lit(nutrient), F.lit("mg"), F.lit("g"), there["amount"].cast("string"))
        assert spark.range(1).select(back["amount"].alias("a")).first()["a"] == 1.25


def test_food_names_last_wins(spark):
    # a Python dict loses its order on the way into a map column, so the map is built from JSON, as it is when read
    line = (
        '{"Fiber, total dietary": {"amount": 1, "unit_name": "g"}, "Nectar": {"amount": 2, "unit_name": "g"}, '
        '"Fiber, soluble": {"amount": 3, "unit_name": "g"}, "Protein": null}'
    )
    got = one(spark, line, "string", lambda c: nut.fix_nutrition_labels(F.from_json(c, BAG)))
    assert got["fiber"]["amount"] == 3.0 and got["Nectar"]["amount"] == 2.0
    assert got["protein"] is None and set(got) == {"fiber", "Nectar", "protein"}


def test_label_units(spark):
    facts = {"fat": (1.0,), "sodium": (2.0,), "vitamin A": (3.0,), "calories": (4.0,), "alcohol": (5.0,)}
    got = one(spark, facts, "map<string, struct<value: double>>", nut.fix_units)
    assert {k: v["unit_name"] for k, v in got.items()} == {
        "fat": "g", "sodium": "mg", "vitamin A": "IU", "calories": "kcal", "alcohol": "",
    }


def test_recipe_units(spark):
    bag = {
        "total_fat": {"gram": "2.0"}, "sodium": {"grams": "1"}, "protein": {"grams": "3"}, "dietary_fiber": {},
        "calories": {"kcal": "218"}, "servings": {"na": "9"}, "vitamin A": {"percentage": "4"}, "moon": {"cup": "1", "gram": "2"},
        "cholesterol": {"milligram": "na"},
    }
    got = one(spark, json.dumps(bag), "string", lambda c: nut.fix_recipes_labels(F.from_json(c, "map<string,map<string,string>>")))
    flat = {k: (v["amount"], v["unit_name"]) for k, v in got.items()}
    assert flat["fat"] == (2.0, "g") and flat["protein"] == (3.0, "g")
    assert flat["fiber"] == (None, "g") and flat["calories"] == (218.0, "kcal") and flat["servings"] == (9.0, "")
    assert flat["vitamin A"] == (60.0, "mcg") and flat["moon"] == (1.0, "cup") and flat["cholesterol"] == (None, "mg")
    strict = one(spark, {"sodium": {"gram": "2"}}, "map<string,map<string,string>>", lambda c: nut.fix_recipe_units(c, True))
    assert tuple(strict["sodium"])[:2] == (2.0, "mg")


def test_score(spark):
    docs = spark.createDataFrame(
        [
            (1, "Kale, kale", {"protein": (6.5, "g"), "fat": (13.0, "g"), "sodium": (240.0, "g")}, None),
            (2, "plain", {"protein": (65.0, "g")}, {"sugars": (50.0, "g")}),
            (3, None, {}, None),
            (4, "x", {"monounsaturatedFat": (65.0, "g")}, None),
        ],
        f"fid bigint, description string, nutrients {BAG}, labelNutrients {BAG}",
    )
    got = {r["fid"]: r["score"] for r in scoring.score_foods(docs).collect()}
    assert math.isclose(got[1], 0.02 + 0.4 - 0.03) and math.isclose(got[2], -0.15) and got[3] == 0 and got[4] == 0
    fixed = scoring.score_foods(docs, lambda b, d: scoring.nutrient_score(b, d, fix_mono=True))
    assert math.isclose({r["fid"]: r["score"] for r in fixed.collect()}[4], -0.05)
    own = scoring.score_foods(docs, lambda b, d: F.length(d).cast("double"))
    assert {r["fid"]: r["score"] for r in own.collect()}[2] == 5.0


def test_score_terms_use_daily_values():
    by_name = {(n, u): a for n, u, a in dims.DAILY_VALUES}
    for nutrient, unit, _, divisor in dims.SCORE_TERMS:
        if nutrient in ("protein", "fiber", "alcohol", "fat", "saturatedFat", "cholesterol", "sodium", "sugars"):
            assert by_name[(nutrient, unit)] == divisor


def test_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0]), ("a", [0.0, 0.0]), ("b", [1.0, 0.0])], "k string, v array<float>")
    rows = df.select("k", unit_vector(F.col("v")).alias("u"), cosine(F.col("v"), F.array(F.lit(1.0), F.lit(0.0))).alias("c")).collect()
    assert rows[0]["u"] == pytest.approx([0.6, 0.8]) and rows[1]["u"] is None
    assert [r["c"] for r in rows] == [pytest.approx(0.6), None, 1.0]
    means = {r["k"]: r["v"] for r in mean_vectors(df, ["k"], "v").collect()}
    assert means == {"a": [1.5, 2.0], "b": [1.0, 0.0]}


def test_flatten_structs(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', named_struct('c', 2)) AS m, 3 AS n")
    assert txt.flatten_structs(df).columns == ["m.a", "m.b.c", "n"]


def test_labels_do_not_depend_on_partitions(spark):
    from larder.operators.splits import label_rows

    ids = spark.range(500).withColumnRenamed("id", "fid")
    left = {tuple(r) for r in label_rows(ids.repartition(7), "fid").collect()}
    right = {tuple(r) for r in label_rows(ids.coalesce(1), "fid").collect()}
    assert left == right and {label for _, label in left} == {"training", "validation", "testing"}


def test_mean_of_long_vectors(spark):
    rnd = random.Random(9)
    rows = [(i % 3, [rnd.gauss(0, 1) for _ in range(768)], float(rnd.randrange(1, 5))) for i in range(30)] + [(0, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, v array<float>, w double")
    for k, mean in mean_vectors(df, ["k"], "v", "w").collect():
        own = [(v, w) for g, v, w in rows if g == k and v]
        total = sum(w for _, w in own)
        assert mean == pytest.approx([sum(v[i] * w for v, w in own) / total for i in range(768)], abs=1e-5)


def test_text_of_a_bag_comes_back(spark):
    bags = [
        {"fat": {"gram": "2.0"}, "sugar": {"g": "1", "cup": "1/2"}, "tips": {}},
        {"a: b\\": {"": "x\ny", "u:\\c": "\\n"}, "empty": {"g": ""}},
        {},
    ]
    df = spark.createDataFrame([(b,) for b in bags], "bag map<string,map<string,string>>")
    from larder.functions.text import flatten_fields, parse_fields

    assert [r[0] for r in df.select(parse_fields(flatten_fields("bag"))).collect()] == bags


def test_superfood_phrases(spark):
    df = spark.createDataFrame([("Green tea, kale; brown RICE green tea",), ("tea",), ("",), (None,)], "d string")
    lexicon = ["green tea", "kale", "brown rice"]
    got = [round(r[0], 6) for r in df.select(scoring.superfood_bonus(F.col("d"), lexicon, phrases=True)).collect()]
    assert got == [0.8, 0.0, 0.0, 0.0]
    assert round(df.select(scoring.superfood_bonus(F.col("d"), lexicon)).first()[0], 6) == 0.2
