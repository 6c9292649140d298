"""Nutrient bags: canonical names, units, conversions and numeric parsing, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import dims
from larder.functions.bind import let, with_once
from larder.functions.text import last_wins


def _or_empty(unit: Column) -> Column:
    return F.coalesce(unit, F.lit(""))


def unit_short_name(unit: Column) -> Column:
    """Short name of a unit spelling; unknown spellings stay as they are."""
    return F.coalesce(dims.literal_map(dims.UNIT_ALIASES)[F.lower(_or_empty(unit))], _or_empty(unit))


def parse_amount(raw: Column) -> Column:
    """Number in an amount text: ``"12%"`` gives 12, ``"na"``, empty and unreadable texts give null."""
    return F.regexp_replace(F.trim(raw.cast("string")), "%$", "").try_cast("double")


def is_percent(raw: Column) -> Column:
    return F.coalesce(F.trim(raw.cast("string")).endswith("%"), F.lit(False))


def convert_units(nutrient: Column, from_unit: Column, to_unit: Column, raw: Column) -> Column:
    """``struct<amount, unit_name, status>`` of an amount brought from one unit to another.

    Mass units use their scale; a percentage is that share of the daily value; two units of the daily-value table
    (IU and micrograms) use the ratio of the daily values; an empty unit means the nutrient's default unit. What
    cannot be converted keeps its value and unit with status ``failed``.
    """
    named, factors, result = _conversion()
    given = _given(nutrient, from_unit, to_unit, raw)
    return let(let(let(given, named), factors), result)


def with_converted(df: DataFrame, name: str, nutrient: Column, from_unit: Column, to_unit: Column, raw: Column) -> DataFrame:
    """Adds ``name``: ``convert_units`` of columns of ``df``, step by step as columns, so that generated code evaluates it."""
    named, factors, result = _conversion()
    steps = with_once(df, "_given", _given(nutrient, from_unit, to_unit, raw))
    steps = with_once(steps, "_named", named(F.col("_given"))).drop("_given")
    steps = with_once(steps, "_factors", factors(F.col("_named"))).drop("_named")
    return with_once(steps, name, result(F.col("_factors"))).drop("_factors")


def _given(nutrient: Column, from_unit: Column, to_unit: Column, raw: Column) -> Column:
    return F.struct(
        nutrient.alias("nutrient"), _or_empty(from_unit).alias("unit"), _or_empty(to_unit).alias("target"),
        raw.cast("string").alias("raw"),
    )


def _conversion() -> tuple[Callable[[Column], Column], Callable[[Column], Column], Callable[[Column], Column]]:
    """The steps of a conversion: units named, factors looked up, amount converted."""
    daily, default, scale = dims.daily_value_map(), dims.default_unit_map(), dims.literal_map(dims.UNIT_SCALE)

    def named(x: Column) -> Column:
        unit = F.when(is_percent(x["raw"]), F.lit("percent")).otherwise(unit_short_name(x["unit"]))
        standard = default[x["nutrient"]]
        return F.struct(
            standard.isNotNull().alias("known"),
            F.when(unit == "", F.coalesce(standard, unit)).otherwise(unit).alias("source"),
            unit_short_name(x["target"]).alias("target"),
            parse_amount(x["raw"]).alias("value"),
            x["nutrient"].alias("nutrient"),
        )

    def factors(x: Column) -> Column:
        daily_target = daily[F.concat_ws("|", x["nutrient"], x["target"])]
        daily_source = F.when(x["source"] == "percent", F.lit(100.0)).otherwise(
            daily[F.concat_ws("|", x["nutrient"], x["source"])]
        )
        by_mass = scale[x["source"]].isNotNull() & scale[x["target"]].isNotNull()
        return F.struct(
            x.alias("x"),
            F.when(by_mass, scale[x["source"]]).otherwise(daily_target).alias("times"),
            F.when(by_mass, scale[x["target"]]).otherwise(daily_source).alias("over"),
        )

    def result(f: Column) -> Column:
        x = f["x"]
        same = x["known"] & (x["source"] == x["target"])
        reachable = x["known"] & f["times"].isNotNull() & f["over"].isNotNull()
        return (
            F.when(same, _converted(x["value"], x["target"], "same"))
            .when(reachable, _converted(x["value"] * f["times"] / f["over"], x["target"], "converted"))
            .otherwise(_converted(x["value"], x["source"], "failed"))
        )

    return named, factors, result


def _converted(amount: Column, unit: Column, status: str) -> Column:
    return F.struct(amount.alias("amount"), unit.alias("unit_name"), F.lit(status).alias("status"))


def convert_iu(nutrient: Column, iu: Column) -> Column:
    """``struct<unit_name, amount>``: daily value of the first unit that is not IU, times iu / 100."""
    unit, amount = {}, {}
    for name, u, value in dims.DAILY_VALUES:
        if u != "IU" and name not in unit:
            unit[name], amount[name] = u, float(value)
    return F.struct(
        F.coalesce(dims.literal_map(unit)[nutrient], nutrient).alias("unit_name"),
        F.coalesce(dims.literal_map(amount)[nutrient] * iu / 100, iu).alias("amount"),
    )


def canonical_name(name: Column, kind: str = "food") -> Column:
    """Canonical nutrient name, or the name itself if it is not in the map."""
    names = dims.FOOD_NAMES if kind == "food" else dims.RECIPE_NAMES
    return F.coalesce(dims.literal_map(names)[name], name)


def is_mapped(name: Column, kind: str = "food") -> Column:
    names = dims.FOOD_NAMES if kind == "food" else dims.RECIPE_NAMES
    return dims.literal_map(names)[name].isNotNull()


def fix_nutrition_labels(bag: Column) -> Column:
    """Food nutrient bag under canonical names; when two names meet, the later entry wins."""
    entries = F.transform(
        F.map_entries(bag),
        lambda e: F.struct(canonical_name(e["key"]).alias("key"), e["value"].alias("value")),
    )
    return F.map_from_entries(last_wins(entries))


def fix_units(label_facts: Column) -> Column:
    """Label facts ``map<name, struct<value>>`` -> bag with the unit that belongs to each nutrient."""
    unit = dims.label_unit_map()
    return F.transform_values(
        label_facts,
        lambda name, fact: F.struct(fact["value"].alias("amount"), _or_empty(unit[name]).alias("unit_name")),
    )


def _first_unit_value(sub: Column, strict_compat: bool) -> tuple[Column, Column]:
    # F.get gives null past the end; the entries of a Spark map keep their order
    first = F.get(F.map_entries(sub), F.lit(0))
    unit = _or_empty(first["key"])
    if strict_compat:
        unit = F.when(F.size(sub) > 1, unit).otherwise(F.lit(""))
    value = F.when(first["value"] != "na", first["value"])
    return unit, value


def fix_recipe_unit(nutrient: Column, sub: Column, strict_compat: bool = False) -> Column:
    """``struct<amount, unit_name, status>`` of one recipe value ``{unit: value}`` in the nutrient's own unit."""
    wanted = dims.recipe_unit_map()[nutrient]
    unit, value = _first_unit_value(sub, strict_compat)
    plural = dims.literal_map({"grams": "g", "milligrams": "mg"})
    spelled = F.coalesce(plural[F.lower(unit)], unit)
    done = convert_units(nutrient, spelled, wanted, value)

    def as_is(name: Column) -> Column:
        return F.struct(parse_amount(value).alias("amount"), name.alias("unit_name"), F.lit("same").alias("status"))

    return (
        F.when(wanted.isNull(), as_is(unit))
        .when(wanted.isin("kcal", ""), as_is(wanted))
        .when(unit_short_name(spelled) == wanted, as_is(wanted))
        .otherwise(done)
    )


def fix_recipe_units(bag: Column, strict_compat: bool = False) -> Column:
    """Recipe bag ``map<name, map<unit, value>>`` -> ``map<name, struct<amount, unit_name>>``.

    A single ``{unit: value}`` keeps its unit; ``strict_compat`` treats it as the default unit instead.
    """

    def fixed(name: Column, sub: Column) -> Column:
        done = fix_recipe_unit(name, sub, strict_compat)
        return F.struct(done["amount"].alias("amount"), done["unit_name"].alias("unit_name"))

    return F.transform_values(bag, fixed)


def fix_recipes_labels(bag: Column, strict_compat: bool = False) -> Column:
    """Rename, then fix the units of a recipe bag; unknown names pass through."""
    entries = F.transform(
        F.map_entries(bag),
        lambda e: F.struct(canonical_name(e["key"], "recipe").alias("key"), e["value"].alias("value")),
    )
    return fix_recipe_units(F.map_from_entries(last_wins(entries)), strict_compat)


def is_filled(bag: Column) -> Column:
    """A bag counts as present if it has at least one entry (null and empty bags are both absent)."""
    return F.coalesce(F.size(bag) > 0, F.lit(False))


def prefer(first: Column, second: Column) -> Column:
    """First non-empty bag, else null."""
    return F.when(is_filled(first), first).when(is_filled(second), second)
