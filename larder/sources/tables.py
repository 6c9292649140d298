"""Collections as Parquet directories: scan, keyed append, rewrite, export, run outputs, metrics and models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder import schemas


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A collection, or None if it does not exist yet."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise


def append(docs: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Append to a collection and return the number of rows written, counted while writing."""
    seen = Observation()
    writer = docs.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["n"]


def append_new(docs: DataFrame, path: str, key: str, order: str | None = None) -> int:
    """Append only documents whose key the collection does not have; returns the number of rows added.

    Of several documents with one key the one with the smallest ``order`` counts (by default the smallest row hash).
    Documents without a key can't be recognised again: see ``keyless``.
    """
    from larder.operators.joins import one_per_key, unknown

    keyed = docs.where(F.col(key).isNotNull())
    if order is None:
        plain = F.xxhash64(*[F.to_json(c) if kind.startswith(("map", "struct", "array")) else c for c, kind in keyed.dtypes])
        single = one_per_key(keyed.withColumn("_order", plain), key, "_order").drop("_order")
    else:
        single = one_per_key(keyed, key, order)
    return append(unknown(single.select(*docs.columns), scan(docs.sparkSession, path), key), path)


def keyless(docs: DataFrame, key: str) -> DataFrame:
    """Quarantine rows ``(line, reason)`` of the documents that have no key."""
    return docs.where(F.col(key).isNull()).select(F.to_json(F.struct("*")).alias("line"), F.lit(f"no {key}").alias("reason"))


def export(docs: DataFrame, path: str) -> DataFrame:
    """Write a collection to Parquet; the raw bag goes only if a normalised one is there."""
    has_bag = {"nutrients", "labelNutrients"} & set(docs.columns)
    out = docs.drop("food_nutrients") if has_bag else docs
    out.write.mode("overwrite").parquet(path)
    return out


def empty_collection(spark: SparkSession, path: str, schema: str) -> None:
    """Replace a collection by an empty one of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def latest_run(runs: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Rows of the latest run."""
    return runs.where(F.col(run_id) == runs.agg(F.max(run_id).alias("m")).scalar())


def as_json(docs: DataFrame) -> DataFrame:
    return docs.select(F.to_json(F.struct("*")).alias("value"))


def log_metrics(spark: SparkSession, path: str, run_id: str, values: dict[str, float], step: int = 0) -> None:
    rows = [(run_id, name, step, float(v)) for name, v in values.items() if v is not None]
    append(spark.createDataFrame(rows, schemas.METRICS).coalesce(1), path)


def wide_to_metrics(df: DataFrame, run_id: str, step: int = 0) -> DataFrame:
    """Long ``(run_id, name, step, value)`` of a one-row or few-row table of numbers."""
    numbers = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "long", "integer")]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "name", "value")
    return long.select(F.lit(run_id).alias("run_id"), "name", F.lit(step).cast("bigint").alias("step"), "value")


def save_model(spark: SparkSession, model: MLWritable, path: str, registry: str, run_id: str, name: str) -> None:
    """Save a fitted model at a stable path and add its registry row."""
    model.write().overwrite().save(path)
    append(spark.createDataFrame([(run_id, name, "model", path)], schemas.MODEL_REGISTRY).coalesce(1), registry)


def load_model(kind: type[Model], path: str) -> Model:
    return kind.load(path)


def log_predictions(scored: DataFrame, path: str, model: str, target: str = "score", prediction: str = "predictions") -> int:
    """Append scored rows to the prediction log, partitioned by model."""
    rows = scored.select(
        F.current_timestamp().alias("ts"), F.lit(model).alias("model"), "fid",
        F.col(target).cast("double").alias("target"), F.col(prediction).cast("double").alias("prediction"),
    )
    return append(rows, path, ["model"])


def jdbc_sink(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Optional copy of a small result table into a relational database that the user runs."""
    df.write.jdbc(url, table, mode="append", properties=properties)
