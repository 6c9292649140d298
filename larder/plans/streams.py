"""Streaming queries, driven over the given tables until they are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.plans import views
from larder.plans.monitoring import QUALITY, rounded
from larder.plans.registry import FACTS, LOG_SQL, query
from larder.plans.views import Tables
from larder.session import fresh_path
from larder.streaming import ingest, monitor
from larder.sources import keyed, tables


@query(
    "stream_ingest",
    f"""WITH {FACTS} SELECT fid, 'food-' || fid AS id, round(0e0 + CASE WHEN lines IS NULL THEN 0 ELSE floor(hi_qty) / 65 * 0.2e0 - lines / 2400 * 0.2e0 END, 6) + 0e0 AS score
    FROM facts WHERE o_orderpriority <> '5-LOW'""",
)
def stream_ingest(t: Tables) -> DataFrame:
    """Line files taken in by a stream in two drops, the second with all lines again: each key is added once."""
    source, collection = fresh_path(t.spark, "lines"), fresh_path(t.spark, "foods")
    checkpoint = fresh_path(t.spark, "ingest-state")
    lines = views.food_lines(t)
    first = F.col("value").contains("MEDIUM")
    for drop in (lines.where(first), lines):
        drop.select("value").write.mode("append").text(source)
        ingest.ingest_stream(t.spark, source, collection, checkpoint).awaitTermination()
    return tables.scan(t.spark, collection).select("fid", "id", F.round("score", 6).alias("score"))


@query(
    "stream_filtered",
    f"""WITH {FACTS} SELECT fid, 'food-' || fid AS id, round(0e0 + CASE WHEN lines IS NULL THEN 0 ELSE floor(hi_qty) / 65 * 0.2e0 - lines / 2400 * 0.2e0 END, 6) + 0e0 AS score
    FROM facts WHERE o_orderpriority <> '5-LOW'""",
)
def stream_filtered(t: Tables) -> DataFrame:
    """As ``stream_ingest``, into a collection in hash partitions whose filters tell new keys from known ones."""
    source, collection = fresh_path(t.spark, "lines"), fresh_path(t.spark, "foods")
    checkpoint = fresh_path(t.spark, "ingest-state")
    lines = views.food_lines(t)
    for drop in (lines.where(F.col("value").contains("MEDIUM")), lines):
        drop.select("value").write.mode("append").text(source)
        ingest.ingest_stream(t.spark, source, collection, checkpoint, filtered=True).awaitTermination()
    return keyed.scan(t.spark, collection).select("fid", "id", F.round("score", 6).alias("score"))


@query(
    "stream_quarantine",
    f"""WITH {FACTS} SELECT o_orderpriority AS priority, count(*) AS lines FROM facts WHERE o_orderpriority = '5-LOW' GROUP BY ALL""",
)
def stream_quarantine(t: Tables) -> DataFrame:
    """Damaged lines that the ingest stream sets aside, by the priority in them."""
    source, collection = fresh_path(t.spark, "lines"), fresh_path(t.spark, "foods")
    quarantine, checkpoint = fresh_path(t.spark, "quarantine"), fresh_path(t.spark, "ingest-state")
    views.food_lines(t).select("value").write.text(source)
    ingest.ingest_stream(t.spark, source, collection, checkpoint, quarantine=quarantine).awaitTermination()
    bad = tables.scan(t.spark, quarantine)
    return bad.groupBy(F.regexp_extract("line", r"(\d-[A-Z ]+)", 1).alias("priority")).agg(F.count(F.lit(1)).alias("lines"))


def log_stream(t: Tables) -> DataFrame:
    """The events table read as a stream of predictions."""
    events = t("events")
    # a pattern, because the table may be one file or a folder of files
    raw = t.spark.readStream.schema(events.schema).parquet(f"{t.root}/events.parquet*")
    return raw.select(
        # the tables hold UTC wall-clock time; a watermark needs an instant, whatever the session's zone is
        F.expr("cast(convert_timezone('UTC', current_timezone(), cast(ts AS timestamp_ntz)) AS timestamp)").alias("ts"),
        F.col("event_type").alias("model"), F.col("event_id").alias("fid"),
        F.from_json("props", "k double")["k"].alias("target"), F.col("value").alias("prediction"),
    )


@query(
    "stream_rolling",
    f"""WITH {LOG_SQL}, recent AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY model ORDER BY ts DESC, fid) <= 700)
    SELECT model, {QUALITY} FROM recent GROUP BY model""",
)
def stream_rolling(t: Tables) -> DataFrame:
    """Rolling quality kept up by a stream over the prediction log."""
    log, report = fresh_path(t.spark, "log"), fresh_path(t.spark, "report")
    monitor.run_rolling(log_stream(t), log, report, fresh_path(t.spark, "rolling-state"), 700).awaitTermination()
    return rounded(monitor.latest_report(t.spark, report), [])


@query(
    "stream_windows",
    f"""WITH {LOG_SQL} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, model, count(*) AS n, round(avg(error), 6) AS mean_error,
    round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse FROM log
    WHERE date_trunc('day', ts) < (SELECT date_trunc('day', max(ts) - INTERVAL 1 HOUR) FROM log) GROUP BY ALL""",
)
def stream_windows(t: Tables) -> DataFrame:
    """Daily error windows per model; the window that is still open at the end is not written."""
    sink, state = fresh_path(t.spark, "windows"), fresh_path(t.spark, "window-state")
    monitor.run_windowed(log_stream(t), sink, state).awaitTermination()
    done = tables.scan(t.spark, sink)
    start = "convert_timezone(current_timezone(), 'UTC', cast(window_start AS timestamp_ntz))"
    day = F.expr(f"date_format({start}, 'yyyy-MM-dd') AS day")
    return rounded(done.select(day, "model", "n", "mean_error", "mae", "rmse"), [])
