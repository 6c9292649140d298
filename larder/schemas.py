"""Declared schemas of the tables the library reads and writes; nothing is inferred at run time."""

from __future__ import annotations

from dataclasses import dataclass, field

FOOD_LINE = (
    "_id string, fid bigint, fdc_id bigint, description string, "
    "food_nutrients map<string, struct<amount: double, unit_name: string>>"
)
RECIPE_LINE = (
    "_id string, name string, link string, photo string, description string, "
    "ingredients map<string, map<string, string>>, nutrients map<string, map<string, string>>, "
    "prep_time string, cook_time string, total_time string, calories string, servings double, "
    "directions map<string, string>, tips map<string, string>, source string"
)
BAG = "map<string, struct<amount: double, unit_name: string>>"
FOOD_DOC = (
    f"id string, fid bigint, fdc_id bigint, description string, score double, nutrients {BAG}, "
    f"labelNutrients {BAG}, label string, category string, embedding array<float>"
)
PREDICTION_LOG = "ts timestamp, model string, fid bigint, target double, prediction double"
MODEL_REGISTRY = "run_id string, name string, type string, path string"
METRICS = "run_id string, name string, step bigint, value double"

# The order of the model features is part of the contract with saved models.
FEATURES = [
    "fat", "saturatedFat", "transFat", "cholesterol", "sodium", "carbohydrates", "fiber",
    "sugars", "protein", "calcium", "iron", "potassium", "calories",
]


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns play which part in a report."""

    target: str = "score"
    prediction: str = "predictions"
    numeric: list[str] = field(default_factory=lambda: list(FEATURES))
    categorical: list[str] = field(default_factory=list)
    ident: list[str] = field(default_factory=lambda: ["fid", "description"])

    def report_columns(self, present: list[str]) -> list[str]:
        """Numeric and categorical columns that exist; ids, target and predictions stay out."""
        return [c for c in [*self.numeric, *self.categorical] if c in present]
