"""Queries that run a stream over the given tables; the checks are their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenetrail.functions.text import normalise_state
from scenetrail.plans.derived import table
from scenetrail.plans.queries_jobs import TIMEOUT_SQL
from scenetrail.plans.registry import query
from scenetrail.session import scratch_path
from scenetrail.streaming import trackers


def _events(spark, sf):
    """The events table as a stream of its files."""
    schema = table(spark, sf, "events").schema
    return trackers.watch_files(spark, f"{sf}/events.parquet*", schema)


@query("q_stream_files", "SELECT event_id, event_type, user_id FROM events")
def stream_files(spark, sf):
    rows = _events(spark, sf).select("event_id", "event_type", "user_id")
    return trackers.run_available(rows, scratch_path(spark, "files"))


@query(
    "q_stream_counts",
    """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n,
           cast(sum(cast(value AS decimal(18,2))) AS double) AS total FROM events GROUP BY 1
    """,
)
def stream_counts(spark, sf):
    events = _events(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), "value")
    return trackers.run_updates(
        trackers.windowed_counts(events, "ts", "value"), scratch_path(spark, "counts"), ["window_start"]
    )


@query(
    "q_stream_jobs",
    f"""
    SELECT job_id, submitted_at, outcome FROM (
      SELECT job_id, submitted_at, CASE WHEN ended IS NOT NULL THEN CASE WHEN epoch_us(ended_at) < mark THEN ended END
                                        WHEN epoch_us(submitted_at) + 3600999999 < mark THEN 'TIMEOUT' END AS outcome
      FROM ({TIMEOUT_SQL}) t CROSS JOIN (SELECT (epoch_ms(max(ts)) - 600000) * 1000 AS mark FROM events) w
    ) x WHERE outcome IS NOT NULL
    """,
    ("job_status",),
)
def stream_jobs(spark, sf):
    raw = (
        F.when(F.col("event_type") == "click", "PENDING")
        .when(F.col("event_type") == "view", "RUNNING")
        .when(F.col("event_type") == "purchase", "COMPLETED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("")
    )
    status = _events(spark, sf).select(
        F.concat(F.lit("job-"), F.floor(F.col("event_id") / 8)).alias("job_id"),
        F.col("ts").cast("timestamp").alias("observed_at"),
        normalise_state(raw).alias("state"),
    )
    return trackers.run_available(trackers.job_tracker(status), scratch_path(spark, "jobs"))


@query(
    "q_stream_updates",
    "SELECT event_type AS dataset, user_id, count(*) AS updates, max(event_id) AS newest FROM events GROUP BY 1, 2",
)
def stream_updates(spark, sf):
    path = scratch_path(spark, "updates")

    def react(batch, batch_id):
        counted = batch.groupBy(F.col("event_type").alias("dataset"), "user_id").agg(
            F.count("*").alias("updates"), F.max("event_id").alias("newest")
        )
        counted.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    trackers.on_dataset_update(_events(spark, sf), react)
    parts = spark.read.schema("dataset string, user_id long, updates long, newest long, batch long").parquet(path)
    return parts.groupBy("dataset", "user_id").agg(F.sum("updates").alias("updates"), F.max("newest").alias("newest"))
