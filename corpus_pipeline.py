"""A corpus from raw documents to packed token rows. Every stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, jaccard, mixing, packing, quality
from larder.session import materialise, small_batches

#: Documents below this quality score go; lower than the operator's default, to keep clean documents in doubt.
REJECT_BELOW = 0.5
#: Near duplicates share this percentage of their shingles of so many words; the values of op2 bind only that query.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80

ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labelled ones among them, doesn't reject.

    A null or empty text is scored like others. Repeated rows, ties of the score and rows without an id are kept or go by
    their text alone. Without labels every score is one half, so all rows stay; an empty table gives no rows.
    """
    small_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model, REJECT_BELOW)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row: that of the smallest id, those without an id last.

    Rows that share id and text are one document and stay once; different texts of one id are different documents. A text
    without words links with nothing. An empty table gives no rows.
    """
    small_batches(spark)
    return jaccard.first_documents(docs, NEAR_SHINGLE, NEAR_PERCENT)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Null and empty texts, and repeated rows, stay; an empty benchmark keeps all rows."""
    small_batches(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix of their sources. A null source is one of its own; rows that share an id stand together."""
    return mixing.interleave(docs)


def packed_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids; a task packs the consecutive documents of the mix that it reads.

    A null or empty text is its end id; repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    small_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", distinct_documents),
    ("benchmark_decontamination", uncontaminated_documents),
    ("source_mixing", mixed_documents),
    ("packed_tokens", packed_rows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
