"""Monitoring of a prediction stream: time windows with late data, and the rolling window over the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.operators.performance import rolling_quality
from larder.operators.splits import last_rows
from larder.sources.tables import scan


def windowed_quality(log: DataFrame, width: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Error sums per model and event-time window; rows later than ``lateness`` behind the newest are dropped."""
    e = F.col("prediction") - F.col("target")
    return (
        log.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width).alias("w"), "model")
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg(e).alias("mean_error"), F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
        )
        .select(F.col("w.start").alias("window_start"), "model", "n", "mean_error", "mae", "rmse")
    )


def run_windowed(log: DataFrame, sink: str, checkpoint: str, width: str = "1 day", lateness: str = "1 hour") -> StreamingQuery:
    """Append finished windows to a Parquet sink until the source is used up."""
    return (
        windowed_quality(log, width, lateness)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_rolling(log: DataFrame, log_path: str, report_path: str, checkpoint: str, window: int = 3000) -> StreamingQuery:
    """Each micro-batch extends the prediction log and writes a report over the last ``window`` rows per model.

    The rows that can still be among the last ones are kept as a state of at most ``window`` rows per model, so a batch
    reads that state and itself, never the log. Log, state and report have one folder per batch: a batch that is
    repeated writes the same again, and a reader of the latest finished report is never disturbed.
    """
    state_path = f"{report_path}-state"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/batch={number}")
        fresh = batch.sparkSession.read.schema(batch.schema).parquet(f"{log_path}/batch={number}")
        before = scan(batch.sparkSession, f"{state_path}/batch={number - 1}") if number else None
        seen = fresh if before is None else before.unionByName(fresh)
        last_rows(seen, window).drop("rn").write.mode("overwrite").parquet(f"{state_path}/batch={number}")
        kept = batch.sparkSession.read.schema(batch.schema).parquet(f"{state_path}/batch={number}")
        rolling_quality(kept, window).write.mode("overwrite").parquet(f"{report_path}/batch={number}")

    return (
        log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_report(spark: SparkSession, report_path: str) -> DataFrame | None:
    """The report of the newest batch, or None before the first."""
    reports = scan(spark, report_path)
    if reports is None:
        return None
    newest = reports.agg(F.max("batch")).first()[0]
    return reports.where(F.col("batch") == F.lit(newest)).drop("batch")
