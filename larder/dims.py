"""Small fixed dimensions: daily values, unit classes, nutrient names, score terms and superfoods.

All of them are constants with a known size, so they enter plans as literal maps and never need a join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (nutrient, unit, daily amount) on a 2000-calorie diet; the first unit of a nutrient is its default.
DAILY_VALUES = [
    ("fat", "g", 65), ("transFat", "g", 13), ("polyunsaturatedFat", "g", 13), ("monounsaturatedFat", "g", 13),
    ("saturatedFat", "g", 20), ("cholesterol", "mg", 300), ("sodium", "mg", 2400), ("carbohydrates", "g", 300),
    ("sugars", "g", 50), ("addedSugar", "g", 20), ("fiber", "g", 30), ("protein", "g", 65), ("alcohol", "g", 14),
    ("iron", "mg", 18), ("calcium", "mg", 1000), ("potassium", "mg", 4700), ("vitamin A", "IU", 5000),
    ("vitamin A", "mcg", 1500), ("vitamin C", "mg", 60), ("vitamin D", "IU", 800), ("vitamin D", "mcg", 20),
    ("vitamin E", "mg", 15), ("vitamin K", "mcg", 120), ("thiamin", "mg", 1.2), ("riboflavin", "mg", 1.3),
    ("niacin", "mg", 16), ("vitamin B6", "mg", 1.3), ("folate", "mcg", 400), ("vitamin B12", "mcg", 2.4),
    ("pantothenicAcid", "mg", 5), ("biotin", "mcg", 30), ("choline", "mg", 550), ("phosphorus", "mg", 1000),
    ("magnesium", "mg", 400), ("zinc", "mg", 11), ("copper", "mg", 0.9), ("manganese", "mg", 2.3),
    ("selenium", "mcg", 55), ("chromium", "mcg", 35), ("molybdenum", "mcg", 45), ("iodine", "mcg", 150),
    ("vitamin B1", "mg", 1.2), ("vitamin B2", "mg", 1.3), ("vitamin B3", "mg", 16), ("vitamin B5", "mg", 5),
]

# Spellings of a unit and its short name.
UNIT_ALIASES = {
    "g": "g", "gram": "g", "mg": "mg", "milligram": "mg", "mcg": "mcg", "microgram": "mcg",
    "iu": "IU", "ius": "IU", "percentage": "percent", "percentages": "percent",
}

# Micrograms in one unit of mass.
UNIT_SCALE = {"g": 1_000_000.0, "mg": 1_000.0, "mcg": 1.0}

# The unit each nutrient is expressed in.
GRAM_NUTRIENTS = [
    "protein", "fiber", "sugars", "addedSugar", "carbohydrates", "saturatedFat", "monounsaturatedFat",
    "polyunsaturatedFat", "fat", "transFat",
]
MILLIGRAM_NUTRIENTS = [
    "manganese", "copper", "zinc", "magnesium", "phosphorus", "calcium", "choline", "pantothenicAcid", "vitamin B",
    "vitamin B1", "vitamin B2", "vitamin B3", "vitamin B5", "vitamin B6", "niacin", "riboflavin", "thiamin",
    "vitamin C", "vitamin E", "potassium", "iron", "sodium", "cholesterol", "water",
]
IU_NUTRIENTS = ["vitamin D", "vitamin A"]
CALORIE_FIELDS = ["calories", "caloriesFromFat"]
PLAIN_FIELDS = ["servings", "servingSize"]

# Recipe field names and their canonical names.
RECIPE_NAMES = {
    "servings": "servings", "calories": "calories", "calories_from_fat": "caloriesFromFat",
    "saturated_fat": "saturatedFat", "polyunsaturated_fat": "polyunsaturatedFat",
    "monounsaturated_fat": "monounsaturatedFat", "total_fat": "fat", "trans_fat": "transFat",
    "Vitamin A": "vitamin A", "Vitamin C": "vitamin C", "Vitamin B": "vitamin B", "Vitamin D": "vitamin D",
    "vitamin A": "vitamin A", "vitamin C": "vitamin C", "vitamin B": "vitamin B", "vitamin D": "vitamin D",
    "cholesterol": "cholesterol", "sodium": "sodium", "potassium": "potassium", "iron": "iron",
    "calcium": "calcium", "Protein": "protein", "protein": "protein", "total_carbs": "carbohydrates",
    "Cholesterol": "cholesterol", "Energy": "calories", "sugars": "sugars", "added_sugar": "addedSugar",
    "added_sugars": "addedSugar", "total_sugars": "sugars", "dietary_fiber": "fiber",
    "Fiber, total dietary": "fiber", "serving_size": "servingSize",
}

# Nutrient names of the food files and their canonical names. Selenium and tryptophan map to
# themselves here (the source material sends them to sodium and to a misspelling).
FOOD_NAMES = {
    "Total lipid (fat)": "fat", "total_fat": "fat", "saturated_fat": "saturatedFat", "dietary_fiber": "fiber",
    "Protein": "protein", "total_carbs": "carbohydrates", "Carbohydrate, by difference": "carbohydrates",
    "Carbohydrate, other": "carbohydrates", "Cholesterol": "cholesterol", "Choline": "choline",
    "Choline, total": "choline", "Cystine": "cystine", "Chlorine, Cl": "chlorine", "Chromium, Cr": "chromium",
    "Energy": "calories", "Sugars, total including NLEA": "sugars", "Sugars, added": "addedSugar",
    "Alcohol, ethyl": "alcohol", "Arginine": "arginine", "Alanine": "alanine", "Histidine": "histidine",
    "Fructose": "fructose", "Fiber, total dietary": "fiber", "Fiber, soluble": "fiber",
    "Fiber, insoluble": "fiber", "Calcium, Ca": "calcium", "Iron, Fe": "iron", "Iodine, I": "iodine",
    "Inulin": "inulin", "Inositol": "inositol", "Copper, Cu": "copper", "Lactose": "lactose",
    "Glucose": "glucose", "Zinc, Zn": "zinc", "Potassium, K": "potassium", "Thiamin": "thiamin",
    "Tyrosine": "tyrosine", "Sodium, Na": "sodium", "Selenium, Se": "selenium", "Riboflavin": "riboflavin",
    "Niacin": "niacin", "Magnesium": "magnesium", "Methionine": "methionine", "Molybdenum, Mo": "molybdenum",
    "Magnesium, Mg": "magnesium", "Manganese, Mn": "manganese", "Phosphorus, P": "phosphorus",
    "Pantothenic acid": "pantothenicAcid", "Phenylalanine": "phenylalanine", "Ash": "ash", "Water": "water",
    "Aspartic acid": "asparticAcid", "Acetic acid": "aceticAcid", "Lactic acid": "lacticAcid",
    "Glutamic acid": "glutamicAcid", "Glutamine": "glutamine", "Glycine": "glycine", "Folic acid": "folicAcid",
    "Folate, total": "folate", "Valine": "valine", "Vitamin A, IU": "vitamin A", "Vitamin B, IU": "vitamin B",
    "Vitamin B-1, IU": "vitamin B1", "Vitamin B-2, IU": "vitamin B2", "Vitamin B-3, IU": "vitamin B3",
    "Vitamin B-5, IU": "vitamin B5", "Vitamin B-6": "vitamin B6", "Vitamin B-12": "vitamin B12",
    "Vitamin C, total ascorbic acid": "vitamin C", "Vitamin D, IU": "vitamin D",
    "Vitamin D (D2 + D3), International Units": "vitamin D", "Vitamin D (D2 + D3)": "vitamin D",
    "Vitamin D3, IU": "vitamin D3", "Vitamin D3 (cholecalciferol)": "vitamin D3", "Vitamin E": "vitamin E",
    "Vitamin E (label entry primarily)": "vitamin E", "Vitamin E (alpha-tocopherol)": "vitamin E",
    "Vitamin K, (phylloquinone)": "vitamin K", "Vitamin K (phylloquinone)": "vitamin K",
    "Carotene, beta": "carotene", "Biotin": "biotin", "Folate, DFE": "folate", "Fluoride, F": "fluoride",
    "Ribose": "ribose", "SFA 8:0": "sfa", "SFA 10:0": "sfa", "SFA 12:0": "sfa", "PUFA 18:2": "pufa",
    "PUFA 18:2 n-6 c,c": "pufa", "PUFA 18:3 n-3 c,c,c (ALA)": "pufa", "Epigallocatechin-3-gallate": "gallate",
    "Caffeine": "caffeine", "Cysteine": "cystine", "Sorbitol": "sorbitol", "Starch": "starch",
    "Xilitol": "xilitol", "Xylitol": "xylitol", "Lutein + zeaxanthin": "lutein", "Taurine": "taurine",
    "Tryptophan": "tryptophan", "Threonine": "threonine", "Isoleucine": "isoleucine", "Leucine": "leucine",
    "Lignin": "lignin", "Lysine": "lysine", "Proline": "proline", "Serine": "serine",
    "Total sugar alcohols": "alcohol", "Fatty acids, total trans": "transFat",
    "Fatty acids, total saturated": "saturatedFat", "Fatty acids, total monounsaturated": "monounsaturatedFat",
    "Fatty acids, total polyunsaturated": "polyunsaturatedFat",
}

# Fixed values: (nutrient, unit it must have, signed weight, divisor). The superfood bonus comes after fiber.
SCORE_TERMS = [
    ("protein", "g", 0.2, 65.0),
    ("fiber", "g", 0.2, 30.0),
    ("alcohol", "g", -0.35, 14.0),
    ("fat", "g", -0.15, 65.0),
    ("transFat", "g", -0.1, 65.0),
    ("saturatedFat", "g", -0.1, 20.0),
    ("manounsaturatedFat", "g", -0.05, 65.0),
    ("polyunsaturatedFat", "g", -0.05, 65.0),
    ("cholesterol", "mg", -0.15, 300.0),
    ("sodium", "mg", -0.2, 2400.0),
    ("carbohydrates", "g", -0.25, 300.0),
    ("addedSugar", "g", -0.15, 50.0),
    ("sugars", "g", -0.15, 50.0),
]
SUPERFOOD_BONUS = 0.2

# Superfood names; only one-word names can match a single token.
SUPERFOODS = [
    "blueberries", "sweet potatoes", "salmon", "broccoli", "spinach", "avocado", "egg", "quinoa", "almonds",
    "chia seeds", "turmeric", "pumpkin", "garlic", "green tea", "kale", "bell peppers", "grapefruit", "watermelon",
    "flax seeds", "mushrooms", "papaya", "apples", "ginger", "lentils", "collard greens", "beets", "oats",
    "carrots", "cabbage", "cauliflower", "brussels sprouts", "plums", "artichokes", "peas", "brown rice",
    "buckwheat", "peanuts", "watercress", "asparagus", "radishes", "figs", "pomegranate", "black beans",
    "sunflower seeds", "pineapple", "raspberries", "tofu", "cantaloupe", "walnuts", "mango", "cashews", "oranges",
    "cherry", "strawberries", "blackberries", "dates", "pears", "nectarines", "grapes", "persimmons", "kiwi",
    "peaches", "apricots", "lemon", "limes", "grapefruits", "tangerines", "clementines", "pomegranates",
    "cranberries", "elderberries", "cherries", "melons", "mangoes", "guava", "brazilian nuts", "seaweed",
    "pistachios", "macademia nuts", "tuna", "mackerel", "sardines", "trout", "herring", "shiitake mushrooms",
    "maitake mushrooms", "oyster mushrooms", "reishi mushrooms", "chaga mushrooms", "cordyceps mushrooms",
]


def literal_map(values: dict) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def daily_value_map() -> Column:
    """``nutrient|unit -> daily amount``."""
    return literal_map({f"{n}|{u}": float(a) for n, u, a in DAILY_VALUES})


def default_unit_map() -> Column:
    """``nutrient -> its first unit``."""
    first: dict[str, str] = {}
    for nutrient, unit, _ in DAILY_VALUES:
        first.setdefault(nutrient, unit)
    return literal_map(first)


def recipe_unit_map() -> Column:
    """``canonical nutrient -> unit a recipe value is brought to``."""
    return literal_map(
        {n: "g" for n in GRAM_NUTRIENTS}
        | {n: "mg" for n in MILLIGRAM_NUTRIENTS}
        | {n: "mcg" for n in IU_NUTRIENTS}
        | {n: "kcal" for n in CALORIE_FIELDS}
        | {n: "" for n in PLAIN_FIELDS}
    )


def label_unit_map() -> Column:
    """``canonical nutrient -> unit of a value printed on a label``."""
    return literal_map(
        {n: "g" for n in GRAM_NUTRIENTS}
        | {n: "mg" for n in MILLIGRAM_NUTRIENTS}
        | {n: "IU" for n in IU_NUTRIENTS}
        | {"calories": "kcal"}
    )


def one_word_superfoods() -> list[str]:
    return [s for s in SUPERFOODS if " " not in s]
