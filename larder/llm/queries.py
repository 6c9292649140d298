"""The dealt operators as registered queries: each reads its whole table and returns the operator's full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import align, article, chat, chat_sql, decontaminate, jaccard, layout, mixing, packing, quality, repeats, sketch, toxicity, turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_compression_quality")
def op1(spark: SparkSession, root: str) -> DataFrame:
    return quality.classify(table(spark, root, "documents"), table(spark, root, "labels"))


@query("op3_pfair_mixing")
def op3(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mixed(table(spark, root, "documents"))


@query("op4_toxicity")
def op4(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.classify(table(spark, root, "documents"), table(spark, root, "labels"))


@query("op5_iblt_fingerprints")
def op5(spark: SparkSession, root: str) -> DataFrame:
    return sketch.edited_fingerprints(table(spark, root, "documents"))


@query("op6_substring_dedup")
def op6(spark: SparkSession, root: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, root, "documents"))


@query("op7_tool_call_linking", chat_sql.FORMATTED)
def op7(spark: SparkSession, root: str) -> DataFrame:
    return chat.formatted(table(spark, root, "conversations"))


@query("op8_hilbert_sharding")
def op8(spark: SparkSession, root: str) -> DataFrame:
    return layout.shards(table(spark, root, "documents"))


@query("op9_decontamination")
def op9(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.contamination(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query("op2_ngram_jaccard_join")
def op2(spark: SparkSession, root: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, root, "documents"))


@query("op10_packed_tokens")
def op10(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed(table(spark, root, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, root: str) -> DataFrame:
    return align.alignment(table(spark, root, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, root: str) -> DataFrame:
    return turns.repair(table(spark, root, "conversations"))


@query("op12_main_text")
def op12(spark: SparkSession, root: str) -> DataFrame:
    return article.extracted(table(spark, root, "pages"))
