"""String functions on columns: line repair, tokens, flattening to text and back, safe JSON, names of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.bind import let

TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_json_line(line: Column | str) -> Column:
    """Make a damaged JSON line parseable.

    Doubled backslashes become single, a backslash that starts no ``\\/``, ``\\u`` or ``\\"`` escape is doubled,
    and every ``=`` becomes ``:`` (also inside values, as in the source data's own repair).
    """
    single = F.replace(_col(line), F.lit("\\\\"), F.lit("\\"))
    doubled = F.regexp_replace(single, r'\\(?![/u"])', r"\\\\")
    return F.translate(doubled, "=", ":")


def tokens(text: Column | str) -> Column:
    """Lower-case words; a hyphenated word is one token."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), F.lit(0))


def drop_words(words: Column, lexicon: list[str]) -> Column:
    """Tokens that are not in a stop lexicon (measures, additives)."""
    return F.array_except(words, F.array(*[F.lit(w) for w in lexicon])) if lexicon else words


def flatten_map(bag: Column | str, nested: bool = False) -> Column:
    """``k: v/n`` text of a map; with ``nested`` the values are maps themselves.

    The old text form: a field with several units runs on in lines of their own, so only one-unit fields come back
    from :func:`parse_text`. :func:`flatten_fields` is the form that can always be read back.
    """

    def leaf(m: Column) -> Column:
        return F.array_join(
            F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string"), F.lit("/n"))),
            "",
        )

    if not nested:
        return leaf(_col(bag))
    return F.array_join(
        F.transform(F.map_entries(_col(bag)), lambda e: F.concat(e["key"], F.lit(": "), leaf(e["value"]))), ""
    )


def flatten_fields(bag: Column | str) -> Column:
    """Text of a map of maps that :func:`parse_fields` reads back: a line ``field: unit: value`` for every unit.

    Backslashes, colons and line ends inside names and values are escaped. A field without units keeps a line ``field:``.
    """

    def safe(c: Column) -> Column:
        slashes = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(slashes, F.lit(":"), F.lit("\\c")), F.lit("\n"), F.lit("\\n"))

    def field(e: Column) -> Column:
        units = F.transform(
            F.map_entries(e["value"]),
            lambda u: F.concat(safe(e["key"]), F.lit(": "), safe(u["key"]), F.lit(": "), safe(F.coalesce(u["value"], F.lit("")))),
        )
        return F.when(F.coalesce(F.size(e["value"]), F.lit(0)) < 1, F.array(F.concat(safe(e["key"]), F.lit(":")))).otherwise(units)

    return F.array_join(F.flatten(F.transform(F.map_entries(_col(bag)), field)), "\n")


def parse_fields(text: Column | str) -> Column:
    """Inverse of :func:`flatten_fields`: ``map<field, map<unit, value>>``; a null value comes back as empty text."""

    def plain(c: Column) -> Column:
        # a doubled backslash is set aside while the other escapes are undone
        aside = F.replace(c, F.lit("\\\\"), F.lit("\u0000"))
        undone = F.replace(F.replace(aside, F.lit("\\c"), F.lit(":")), F.lit("\\n"), F.lit("\n"))
        return F.replace(undone, F.lit("\u0000"), F.lit("\\"))

    lines = F.filter(F.split(_col(text), "\n"), lambda s: s != "")
    parts = F.transform(lines, lambda s: F.split(s, ": ?", 3))
    names = F.array_distinct(F.transform(parts, lambda p: p[0]))

    def units(name: Column) -> Column:
        own = F.filter(parts, lambda p: (p[0] == name) & (F.size(p) == 3))
        entries = F.transform(own, lambda p: F.struct(plain(p[1]).alias("key"), plain(p[2]).alias("value")))
        return F.struct(plain(name).alias("key"), F.map_from_entries(entries).alias("value"))

    return F.map_from_entries(F.transform(names, units))


def parse_text(text: Column | str) -> Column:
    """Inverse of :func:`flatten_map` for one entry per line: ``map<field, struct<units, value>>``.

    ``fat: gram: 2.0`` gives units ``gram`` and value ``2.0``; ``tips: stir`` gives units ``''``. If a field
    appears twice the later line wins.
    """
    lines = F.filter(F.split(_col(text), "/n|\n"), lambda s: F.trim(s).contains(":"))

    def entry(line: Column) -> Column:
        key = F.trim(F.regexp_extract(line, r"^([^:]*):", 1))
        rest = F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
        has_unit = rest.contains(":")
        units = F.when(has_unit, F.trim(F.regexp_extract(rest, r"^([^:]*):", 1))).otherwise(F.lit(""))
        value = F.when(has_unit, F.trim(F.regexp_replace(rest, r"^[^:]*:", ""))).otherwise(rest)
        return F.struct(key.alias("key"), F.struct(units.alias("units"), value.alias("value")).alias("value"))

    return F.map_from_entries(last_wins(F.transform(lines, entry)))


def last_wins(entries: Column) -> Column:
    """Drop an entry if a later one has the same key, so that a map can be built whatever the dedup policy is."""

    def with_keys(rows: Column) -> Column:
        return F.struct(rows.alias("all"), F.reverse(F.transform(rows, lambda e: e["key"])).alias("back"))

    def keep(bound: Column) -> Column:
        n = F.size(bound["all"])
        return F.filter(bound["all"], lambda e, i: F.array_position(bound["back"], e["key"]) == n - i)

    return let(let(entries, with_keys), keep)


def safe_json(text: Column | str, schema: str) -> Column:
    """``struct<ok boolean, doc struct, text string>``: the parsed document, or the text if it cannot be parsed."""
    raw, fields = _col(text), T.StructType.fromDDL(schema).fieldNames()
    probe = T.StructType.fromDDL(schema).add("_bad", T.StringType())
    parsed = F.from_json(raw, probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})

    def result(d: Column) -> Column:
        ok = d.isNotNull() & d["_bad"].isNull()
        doc = F.struct(*[d[f].alias(f) for f in fields])
        return F.struct(ok.alias("ok"), F.when(ok, doc).alias("doc"), F.when(~ok, raw).alias("text"))

    return let(parsed, result)


def key_of_path(path: Column | str) -> Column:
    """``s3://bucket/a/b`` -> ``a/b``."""
    return F.regexp_replace(_col(path), r"^[A-Za-z0-9]+://[^/]*/", "")


def processed_sibling(name: Column | str, suffix: str = "_processed", other: str = "_davinci") -> Column:
    """Name of the output that belongs to an input file: last extension off, suffix swapped, ``.json`` on."""
    stem = F.regexp_replace(_col(name), r"\.[^.]*$", "")
    return F.concat(F.replace(stem, F.lit(suffix), F.lit(other)), F.lit(".json"))


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """One level of dotted column names from nested structs."""

    def walk(schema: T.StructType, prefix: list[str]) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            path = [*prefix, f.name]
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, path)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)))
        return out

    return df.select(*walk(df.schema, []))


def hash_bucket(key: Column, seed: str, buckets: int) -> Column:
    """Bucket 0..buckets-1 from md5: the same for every partitioning, engine and run."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(seed)))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
