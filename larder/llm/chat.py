"""Chat formatting with tool calls, in DataFrame operations only.

Calls and results are joined by their identifier, calls are ordered so that each comes after those it needs, arguments
are checked against the tools' schemas, and every message becomes one line of canonical JSON: keys in order, no blanks,
no nulls. Nothing gathers a conversation in one row, so a conversation of any length is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import materialise

#: Names of the JSON types that ``schema_of_variant`` gives.
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "null": "VOID"}


@dataclass(frozen=True)
class Parameter:
    """One argument of a tool. ``kind``: string, integer, number, boolean, array or object."""

    kind: str
    required: bool = True


Schemas = Mapping[str, Mapping[str, Parameter]]


def of_kind(value: Column, kind: str) -> Column:
    """Whether a variant has the JSON type ``kind``."""
    name = F.schema_of_variant(value)
    if kind == "number":
        return (name == "BIGINT") | (name == "DOUBLE") | name.startswith("DECIMAL")
    if kind in ("array", "object"):
        return name.startswith(kind.upper() + "<") | (name == kind.upper())
    return name == KINDS[kind]


def valid_arguments(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Whether a JSON text fits the schema of the tool: an object with every required and no unknown argument.

    An unknown tool, a text that isn't JSON, or a null argument makes it false.
    """
    value = F.try_parse_json(arguments)
    verdict = F.lit(False)
    for tool, parameters in schemas.items():
        fits = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
        keys = F.json_object_keys(arguments)
        fits = fits & (F.size(F.array_except(keys, F.array(*[F.lit(p) for p in parameters]).cast("array<string>"))) == 0)
        for p, spec in parameters.items():
            part = F.try_variant_get(value, f'$["{p}"]', "variant")
            right = of_kind(part, spec.kind)
            fits = fits & F.when(part.isNull(), F.lit(not spec.required)).otherwise(right)
        verdict = F.when(name == tool, fits).otherwise(verdict)
    return F.coalesce(verdict, F.lit(False))


def canonical(arguments: Column) -> Column:
    """A JSON text with sorted keys and no blanks; a text that isn't JSON becomes a JSON string, null an empty one."""
    quoted = F.to_json(F.array(F.coalesce(arguments, F.lit(""))))
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), quoted.substr(F.lit(2), F.length(quoted) - 2))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 without a need, else one more than the highest level needed; null within or behind a cycle.

    ``calls`` has one row per (conv_id, call_id) and an array ``after`` of the calls needed; unknown ids in it don't count.
    Every round settles the calls whose needs are all settled, so rounds are as many as the longest chain.
    """
    nodes = calls.select("conv_id", "call_id")
    needs = calls.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("need"))
    known = nodes.withColumnRenamed("call_id", "need")
    needs = materialise(needs.join(known, ["conv_id", "need"], "left_semi"), "call-needs")
    counts = needs.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("wanted"))
    settled = nodes.join(counts, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0))
    settled = materialise(settled, "call-levels")
    while True:
        have = needs.join(settled.withColumnRenamed("call_id", "need"), ["conv_id", "need"])
        have = have.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("met"), (F.max("level") + 1).alias("level"))
        ready = have.join(counts, ["conv_id", "call_id"]).where(F.col("met") == F.col("wanted"))
        ready = ready.select("conv_id", "call_id", "level")
        fresh = ready.join(settled.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
        fresh = materialise(fresh, "call-levels")
        if fresh.isEmpty():
            return nodes.join(settled, ["conv_id", "call_id"], "left")
        settled = settled.unionByName(fresh)


def format_messages(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per message, call and result: conv_id, turn, kind, call_id, level, linked_turn, status, json.

    ``messages``: conv_id, turn, role, text. ``calls``: conv_id, turn, call_id, name, arguments, after. ``results``: conv_id,
    turn, call_id, text. Order a conversation by turn and level. ``linked_turn`` is the turn of the partner.

    Status of a call: `repeated id` unless it is the first of its id by turn, name and arguments; `cycle`; `invalid
    arguments`; `no result`; else `ok`. Status of a result: `no call`; `repeated result` unless it is the first by turn
    and text; `before call`; else `ok`. Of several faults the first named counts. Identical rows share their status. Rows
    with a null conversation or id are linked with nothing; null texts are left out of the JSON; a null ``after`` is empty.
    """
    first = calls.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("call"))
    first = materialise(first.where("conv_id IS NOT NULL AND call_id IS NOT NULL"), "calls")
    answer = results.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "text")).alias("result"))
    depth = levels(first.select("conv_id", "call_id", F.coalesce("call.after", F.array().cast("array<string>")).alias("after")))
    linked = first.join(depth, ["conv_id", "call_id"], "left").join(answer, ["conv_id", "call_id"], "left")
    linked = materialise(linked.select("conv_id", "call_id", "call", "level", "result"), "linked-calls")

    keys = ["conv_id", "call_id"]
    own = F.struct("turn", "name", "arguments", "after")
    made = calls.join(linked, keys, "left")
    call_status = (
        F.when(F.col("call").isNotNull() & ~own.eqNullSafe(F.col("call")), "repeated id")
        .when(F.col("call").isNotNull() & F.col("level").isNull(), "cycle")
        .when(~valid_arguments(F.col("name"), F.col("arguments"), schemas), "invalid arguments")
        .when(F.col("result").isNull(), "no result")
        .otherwise("ok")
    )
    head = F.to_json(F.struct(F.col("call_id").alias("id"), F.col("name")))
    call_json = F.concat(
        F.lit('{"role":"assistant","tool_calls":[{"arguments":'), canonical(F.col("arguments")),
        F.when(head != "{}", F.concat(F.lit(","), F.substring(head, 2, 1 << 30))).otherwise("}"), F.lit("]}"),
    )
    call_rows = made.select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", "level",
        F.col("result.turn").alias("linked_turn"), call_status.alias("status"), call_json.alias("json"),
    )
    came = results.join(linked, keys, "left")
    result_status = (
        F.when(F.col("call").isNull(), "no call")
        .when(~F.struct("turn", "text").eqNullSafe(F.col("result")), "repeated result")
        .when(F.col("turn") < F.col("call.turn"), "before call")
        .otherwise("ok")
    )
    result_rows = came.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", "level",
        F.col("call.turn").alias("linked_turn"), result_status.alias("status"),
        F.to_json(F.struct(F.col("text").alias("content"), F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id"))).alias("json"),
    )
    plain = messages.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("bigint").alias("linked_turn"), F.lit("ok").alias("status"),
        F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("json"),
    )
    return plain.unionByName(call_rows).unionByName(result_rows)


#: Tools of the trace below.
TOOLS: Schemas = {
    "search": {"query": Parameter("string"), "limit": Parameter("integer", required=False)},
    "count": {"words": Parameter("integer")},
    "note": {"text": Parameter("string"), "pinned": Parameter("boolean", required=False)},
}


def tool_trace(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages, calls and results made of plain conversations, with the faults that real traces have.

    Every assistant turn makes a call besides its message; the user turn after it is also the call's result. By the sum
    of conversation and turn, some calls lack an argument, have one of a wrong type, repeat an id, or need an earlier
    call; some results name a wrong id.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    mark = F.col("conv_id") + F.col("turn")
    query = F.substring(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x1f\"\\]", " "), 1, 24)
    words = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    arguments = (
        F.when(mark % 11 == 0, F.lit("{}"))
        .when(mark % 13 == 0, F.concat(F.lit('{"words": "'), words, F.lit('", "text": true}')))
        .when(mark % 3 == 0, F.concat(F.lit('{"words": '), words, F.lit("}")))
        .when(mark % 3 == 1, F.concat(F.lit('{"query": "'), query, F.lit('", "limit": '), words % 20, F.lit("}")))
        .otherwise(F.concat(F.lit('{"text":"'), query, F.lit('","pinned":true}')))
    )
    ident = F.concat(F.lit("call_"), F.when(mark % 17 == 0, F.col("turn") - 2).otherwise(F.col("turn")))
    calls = rows.where("role = 'assistant'").select(
        "conv_id", "turn", ident.alias("call_id"),
        F.element_at(F.array(F.lit("count"), F.lit("search"), F.lit("note")), (F.pmod(mark, F.lit(3)) + 1).cast("int")).alias("name"),
        arguments.alias("arguments"),
        F.when(mark % 2 == 0, F.array(F.concat(F.lit("call_"), F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("after"),
    )
    wrong = F.concat(F.lit("call_"), F.when(mark % 19 == 0, F.col("turn") + 100).otherwise(F.col("turn") - 1))
    results = rows.where("role = 'user' AND turn > 0").select("conv_id", "turn", wrong.alias("call_id"), "text")
    return rows, calls, results


def formatted(conversations: DataFrame, schemas: Schemas = TOOLS) -> DataFrame:
    """The messages of a conversation table, and the calls and results derived from it, linked and formatted."""
    return format_messages(*tool_trace(conversations), schemas)
