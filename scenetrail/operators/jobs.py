"""Job status, job output and download logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grace period before the first poll counts, and the limit for a job, in seconds.
GRACE_SECONDS = 60
JOB_LIMIT_SECONDS = 3600
FINAL_STATES = ("COMPLETED", "FAILED")


def latest_status(status: DataFrame, job: str = "job_id", at: str = "observed_at") -> DataFrame:
    """The newest row of each job. Rows are pre-aggregated in place, so a busy job moves once per task."""
    rest = [c for c in status.columns if c not in (job, at)]
    newest = status.groupBy(job).agg(F.max(F.struct(at, *rest)).alias("_s"))
    return newest.select(job, "_s.*")


def grace_filter(status: DataFrame, submitted: DataFrame, seconds: int = GRACE_SECONDS) -> DataFrame:
    """Drop the polls of a job within the grace period after its submission (job_id, submitted_at)."""
    counted = F.timestamp_add("SECOND", F.lit(seconds), F.col("submitted_at"))
    return status.join(submitted, "job_id").filter(F.col("observed_at") >= counted)


def submissions(status: DataFrame) -> DataFrame:
    """First time each job was seen."""
    return status.groupBy("job_id").agg(F.min("observed_at").alias("submitted_at"))


def timeouts(status: DataFrame, limit_seconds: int = JOB_LIMIT_SECONDS) -> DataFrame:
    """Outcome per job: its first final state within the limit, else ``TIMEOUT`` once the limit is past.

    A job that is neither final nor past the limit is ``OPEN``.
    """
    final = F.col("state").isin(*FINAL_STATES)
    per_job = status.groupBy("job_id").agg(
        F.min("observed_at").alias("submitted_at"),
        F.max("observed_at").alias("last_seen"),
        F.min(F.when(final, F.struct("observed_at", "state"))).alias("_first"),
    )

    def age(at: str) -> Column:
        return F.timestamp_diff("SECOND", F.col("submitted_at"), F.col(at))

    outcome = (
        F.when(age("_first.observed_at") <= limit_seconds, F.col("_first.state"))
        .when(age("last_seen") > limit_seconds, F.lit("TIMEOUT"))
        .otherwise(F.lit("OPEN"))
    )
    return per_job.select("job_id", "submitted_at", "last_seen", outcome.alias("outcome"))


def collect_output(lines: DataFrame, chunk_lines: int) -> DataFrame:
    """Text of each job and stream, in order, as chunks of the number of lines that the caller gives.

    ``lines`` is (job_id, stream, line_no, line) with line_no from 0. The chunks of a job put together are
    its whole text; no text of unknown length has to fit into one row or task.
    """
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return (
        lines.withColumn("chunk_no", F.floor(F.col("line_no") / chunk_lines))
        .groupBy("job_id", "stream", "chunk_no")
        .agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))
    )


def job_outcome(lines: DataFrame, check_stderr: bool = True) -> DataFrame:
    """Line counts per job, and whether error output fails it (some handlers do not check)."""
    err = F.col("stream") == "err"
    any_error = F.coalesce(F.max(F.when(err, F.length("line") > 0)), F.lit(False))
    return lines.groupBy("job_id").agg(
        F.count_if(F.col("stream") == "out").alias("out_lines"),
        F.count_if(err).alias("err_lines"),
        (any_error if check_stderr else F.lit(False)).alias("failed"),
    )


def download_summary(downloads: DataFrame, status: str | Column = "status") -> DataFrame:
    """Downloads per status; list the successes with a filter, not in one row."""
    status = F.col(status) if isinstance(status, str) else status
    return downloads.groupBy(status.alias("status")).agg(F.count("*").alias("downloads"))
