"""Queries on batch-queue text, job status, job output and downloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenetrail.functions import names as N
from scenetrail.functions import text as X
from scenetrail.operators import jobs
from scenetrail.plans.derived import table, view
from scenetrail.plans.registry import query


@query(
    "q_headers",
    "SELECT page_id, CASE WHEN page_id % 8 <> 0 THEN url END AS target FROM pages",
)
def headers(spark, sf):
    return view(spark, sf, "heads").select("page_id", X.location_header("body").alias("target"))


@query(
    "q_queue_rows",
    """
    SELECT event_id, CASE WHEN event_type = 'signup' THEN 'done' WHEN event_id % 9 = 0 THEN 'malformed'
           WHEN event_type IN ('click', 'view') THEN 'running' ELSE 'waiting' END AS status,
           CASE WHEN event_type <> 'signup' AND event_id % 9 <> 0 THEN
             CASE event_type WHEN 'click' THEN 'PD' WHEN 'view' THEN 'R' WHEN 'purchase' THEN 'CG' ELSE 'F' END END AS code
    FROM events
    """,
)
def queue_rows(spark, sf):
    return view(spark, sf, "poll_text").select(
        "event_id", X.queue_status("queue_body").alias("status"), X.queue_code("queue_body").alias("code")
    )


@query(
    "q_accounting_rows",
    """
    SELECT event_id, CASE WHEN accounting_body = '' THEN 'UNKNOWN'
             WHEN split_part(accounting_body, '|', 2) IN ('COMPLETED', 'RUNNING', 'PENDING', 'FAILED')
             THEN split_part(accounting_body, '|', 2) ELSE 'UNMAPPED' END AS state,
           CASE WHEN accounting_body <> '' THEN split_part(split_part(accounting_body, '|', 3), ':', 1) END AS exit_code
    FROM poll_text
    """,
    ("poll_text",),
)
def accounting_rows(spark, sf):
    return view(spark, sf, "poll_text").select(
        "event_id",
        X.accounting_state("accounting_body").alias("state"),
        X.accounting_exit_code("accounting_body").cast("string").alias("exit_code"),
    )


@query(
    "q_submit_ids",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN cast(event_id AS varchar) END AS strict_id,
           CASE WHEN event_type <> 'error' THEN cast(event_id AS varchar) ELSE '7' END AS last_word
    FROM events
    """,
)
def submit_ids(spark, sf):
    return view(spark, sf, "poll_text").select(
        "event_id",
        X.submitted_job("submit_body").alias("strict_id"),
        X.submitted_job("submit_body", strict=False).alias("last_word"),
    )


@query(
    "q_states",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETED'
           WHEN 'error' THEN 'FAILED' ELSE 'UNMAPPED' END AS state FROM events
    """,
)
def states(spark, sf):
    return view(spark, sf, "job_status").select("event_id", X.normalise_state("raw_state").alias("state"))


@query(
    "q_export_arg",
    "SELECT o_orderkey, '--export=CUST=' || cast(o_custkey AS varchar) || ',STATE=' || o_orderstatus AS arg FROM orders",
)
def export_arg(spark, sf):
    pairs = F.create_map(F.lit("CUST"), F.col("o_custkey").cast("string"), F.lit("STATE"), F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", X.export_arg(pairs).alias("arg"))


@query(
    "q_job_paths",
    """
    SELECT o_orderkey, '/jobs/s' || o_custkey || '.out' AS remote_out, '/jobs/s' || o_custkey || '.err' AS remote_err,
           '/jobs/s' || o_custkey || '_' || o_orderkey || '.out' AS local_out,
           '/jobs/s' || o_custkey || '_' || o_orderkey || '.err' AS local_err
    FROM orders
    """,
)
def job_paths(spark, sf):
    script = F.concat(F.lit("s"), "o_custkey")
    return table(spark, sf, "orders").select("o_orderkey", N.job_paths("/jobs", script, "o_orderkey").alias("p")).select(
        "o_orderkey", "p.*"
    )


@query(
    "q_run_keys",
    "SELECT o_orderkey, 'job-' || o_custkey || '_' || o_orderstatus || '_' || o_orderkey AS run_key FROM orders",
)
def run_keys(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", N.run_key("job-", "o_custkey", "o_orderstatus", "o_orderkey").alias("run_key")
    )


def _status(spark, sf):
    return view(spark, sf, "job_status").select(
        "job_id", F.col("observed_at").cast("timestamp").alias("observed_at"), X.normalise_state("raw_state").alias("state")
    )


_STATUS = """
    SELECT job_id, observed_at, CASE WHEN raw_state = '' THEN 'UNMAPPED' ELSE raw_state END AS state FROM job_status
"""


@query(
    "q_latest_status",
    f"SELECT job_id, max(observed_at) AS observed_at, arg_max(state, (observed_at, state)) AS state FROM ({_STATUS}) s GROUP BY 1",
    ("job_status",),
)
def latest_status(spark, sf):
    return jobs.latest_status(_status(spark, sf))


TIMEOUT_SQL = f"""
    SELECT job_id, submitted_at, max(observed_at) AS last_seen,
           arg_min(state, (observed_at, state)) FILTER (state IN ('COMPLETED', 'FAILED') AND age <= 3600) AS ended,
           min(observed_at) FILTER (state IN ('COMPLETED', 'FAILED') AND age <= 3600) AS ended_at,
           max(age) AS age
    FROM (SELECT *, cast(floor(date_diff('microsecond', submitted_at, observed_at) / 1000000) AS bigint) AS age FROM (
            SELECT *, min(observed_at) OVER (PARTITION BY job_id) AS submitted_at FROM ({_STATUS}) a) b) c GROUP BY 1, 2
"""


@query(
    "q_timeouts",
    f"""
    SELECT job_id, submitted_at, last_seen,
           CASE WHEN ended IS NOT NULL THEN ended WHEN age > 3600 THEN 'TIMEOUT' ELSE 'OPEN' END AS outcome
    FROM ({TIMEOUT_SQL}) t
    """,
    ("job_status",),
)
def timeouts(spark, sf):
    return jobs.timeouts(_status(spark, sf))


@query(
    "q_grace",
    f"""
    SELECT job_id, observed_at, state, submitted_at
    FROM (SELECT *, min(observed_at) OVER (PARTITION BY job_id) AS submitted_at FROM ({_STATUS}) a) b
    WHERE observed_at >= submitted_at + INTERVAL 60 SECOND
    """,
    ("job_status",),
)
def grace(spark, sf):
    status = _status(spark, sf)
    return jobs.grace_filter(status, jobs.submissions(status))


@query(
    "q_job_output",
    """
    SELECT job_id, stream, cast(floor(line_no / 4) AS bigint) AS chunk_no, string_agg(line, chr(10) ORDER BY line_no) AS text
    FROM job_lines GROUP BY 1, 2, 3
    """,
    ("job_lines",),
)
def job_output(spark, sf):
    return jobs.collect_output(view(spark, sf, "job_lines"), chunk_lines=4)


@query(
    "q_job_outcome",
    """
    SELECT job_id, count(*) FILTER (stream = 'out') AS out_lines, count(*) FILTER (stream = 'err') AS err_lines,
           count(*) FILTER (stream = 'err') > 0 AS failed FROM job_lines GROUP BY 1
    """,
    ("job_lines",),
)
def job_outcome(spark, sf):
    return jobs.job_outcome(view(spark, sf, "job_lines"))


_DOWNLOAD = """
    SELECT page_id, CASE WHEN page_id % 10 IN (0, 1) THEN 'Skipped' WHEN page_id % 10 IN (2, 3, 5) THEN 'Failed'
           ELSE 'Success' END AS status FROM pages
"""


def _download_status(spark, sf):
    status = X.download_status("url", "exit_code", "stderr", "uri")
    return view(spark, sf, "downloads").select("page_id", status.alias("status"), X.downloaded_name("uri").alias("file_name"))


@query(
    "q_download_status",
    f"""
    SELECT d.page_id, status, CASE WHEN d.page_id % 10 <> 5 THEN 'S2A_' || d.page_id || '.zip' END AS file_name
    FROM ({_DOWNLOAD}) d
    """,
)
def download_status(spark, sf):
    return _download_status(spark, sf)


@query("q_download_summary", f"SELECT status, count(*) AS downloads FROM ({_DOWNLOAD}) d GROUP BY 1")
def download_summary(spark, sf):
    return jobs.download_summary(_download_status(spark, sf))
