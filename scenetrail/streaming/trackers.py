"""Streaming forms: watched folders, tracked jobs, windowed counts and dataset updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scenetrail.operators.jobs import FINAL_STATES, JOB_LIMIT_SECONDS
from scenetrail.session import scratch_path


def watch_files(
    spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Stream of the rows of files as they arrive."""
    return (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)
    )


def run_available(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process what there is, write it as Parquet and return the result table."""
    spark = df.sparkSession
    query = (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_updates(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Process what there is in update mode and return the newest row of each key.

    Every batch is written to a folder of its own and overwritten on a retry, so a repeated batch does
    no harm.
    """
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        df.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rest = [c for c in df.columns if c not in keys]
    written = spark.read.schema(T.StructType([*df.schema, T.StructField("batch_id", T.LongType())])).parquet(path)
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(*keys, "_r.*")


def windowed_counts(events: DataFrame, ts: str, value: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows and sum per tumbling window; works on a stream and on a table alike.

    The sum is kept in decimals, so it does not depend on the order of arrival.
    """
    return (
        events.withWatermark(ts, late)
        .groupBy(F.window(ts, width))
        .agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
        .select(F.col("window.start").alias("window_start"), "n", F.col("total").cast("double").alias("total"))
    )


_SEEN = "job_id string, first_us long, last_us long, final_us long, final_state string, last_seen timestamp"
_OUTCOME = "job_id string, submitted_us long, outcome string"
_OUTCOME_COLUMNS = ["job_id", "submitted_us", "outcome"]
_STATE = (
    "job_ids array<string>, submitted_us array<long>, last_us array<long>, final_us array<long>, final_states array<string>, "
    "done array<boolean>"
)
JOB_BUCKETS = 1024
_SECOND = 1_000_000


def _reduce_polls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Polls of a batch to one row per job: first and last time, and the first final state."""
    for pdf in batches:
        pdf = pdf.sort_values(["observed_us", "state"], kind="stable")
        seen = pdf.groupby("job_id", sort=False)["observed_us"].agg(["min", "max"])
        final = pdf[pdf["state"].isin(FINAL_STATES)].groupby("job_id", sort=False).first().reindex(seen.index)
        final["state"] = final["state"].astype(object).where(final["state"].notna(), None)
        yield pd.DataFrame(
            {
                "job_id": seen.index,
                "first_us": seen["min"].to_numpy(),
                "last_us": seen["max"].to_numpy(),
                "final_us": final["observed_us"].astype("Int64").to_numpy(),
                "final_state": final["state"].to_numpy(),
                "last_seen": pd.to_datetime(seen["max"].to_numpy(), unit="us"),
            }
        )


def _merge(old: tuple | None, new: tuple) -> tuple:
    """A job as (submitted, last, final time, final state, done) with one more reduced poll row."""
    if old is None:
        return new
    finals = [f for f in (old[2:4], new[2:4]) if f[0] is not None]
    return (min(old[0], new[0]), max(old[1], new[1]), *min(finals, default=(None, None)), old[4])


def _track(limit_us: int) -> Callable:
    def follow(key: tuple, polls: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        jobs = {name: tuple(rest) for name, *rest in zip(*state.get)} if state.exists else {}
        polled = set()
        for pdf in () if state.hasTimedOut else polls:
            for job, first, newest, ended, name in zip(*(pdf[c] for c in ("job_id", "first_us", "last_us", "final_us", "final_state"))):
                final = (int(ended), name) if isinstance(name, str) else (None, None)
                jobs[job] = _merge(jobs.get(job), (int(first), int(newest), *final, False))
                polled.add(job)
        outcomes, dues = [], []
        for job, (submitted, last, final_us, final_state, done) in list(jobs.items()):
            if done and job not in polled and (last + limit_us) // 1000 < watermark:
                del jobs[job]
                continue
            if not done:
                # Ages count in whole seconds, as in the table form of this operator.
                in_time = final_us is not None and (final_us - submitted) // _SECOND <= limit_us // _SECOND
                due = final_us if in_time else submitted + limit_us + _SECOND - 1
                done = due < watermark * 1000  # polls up to then can no longer arrive
                if done:
                    outcomes.append((job, submitted, final_state if in_time else "TIMEOUT"))
                    jobs[job] = (submitted, last, final_us, final_state, True)
            # An ended job is remembered until it is silent for its limit, so that later polls do not start it anew.
            dues.append((last + limit_us if done else due) // 1000)
        if outcomes:
            yield pd.DataFrame(outcomes, columns=_OUTCOME_COLUMNS)
        if not jobs:
            if state.exists:
                state.remove()
            return
        state.update((list(jobs), *(list(column) for column in zip(*jobs.values()))))
        state.setTimeoutTimestamp(max(min(dues), watermark + 1))

    return follow


def job_tracker(
    status: DataFrame, limit_seconds: int = JOB_LIMIT_SECONDS, late: str = "10 minutes", buckets: int = JOB_BUCKETS
) -> DataFrame:
    """Outcome of each job of a status stream (job_id, observed_at, state).

    A job ends with its earliest final state within the limit, else with ``TIMEOUT``. The outcome is given once
    the watermark has passed the time of that state or of the limit, so it does not depend on the order in which polls
    arrive. Polls are reduced per job before the shuffle. Jobs are followed in hash buckets, one call of Python and one row
    of state for each bucket that has polls or is due, and some 60 bytes in it for each job that is not yet forgotten; for
    more than some ten million open jobs, take more buckets.
    """
    tracked = (
        status.select("job_id", F.unix_micros("observed_at").alias("observed_us"), "state")
        .mapInPandas(_reduce_polls, _SEEN)
        .withColumn("bucket", F.pmod(F.xxhash64("job_id"), F.lit(buckets)))
        .withWatermark("last_seen", late)
        .groupBy("bucket")
        .applyInPandasWithState(
            _track(limit_seconds * _SECOND), _OUTCOME, _STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
    return tracked.select("job_id", F.timestamp_micros("submitted_us").alias("submitted_at"), "outcome")


def on_dataset_update(producer: DataFrame, fn: Callable[[DataFrame, int], None]) -> None:
    """Call ``fn`` with every non-empty batch of updates of a producer stream."""

    def react(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            fn(batch, batch_id)

    query = (
        producer.writeStream.foreachBatch(react)
        .option("checkpointLocation", scratch_path(producer.sparkSession, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
