"""Queries on run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenetrail.operators import runs
from scenetrail.plans.derived import table, view
from scenetrail.plans.registry import query

_V = ("task_edges", "task_runs")

_UPSTREAM = """
    SELECT t.dag, t.task, d.logical_ts, count(DISTINCT e.parent) AS n_upstream,
           count(*) FILTER (r.state = 'success') AS n_success, count(*) FILTER (r.state = 'failed') AS n_failed
    FROM (SELECT dag, parent AS task FROM task_edges UNION SELECT dag, child FROM task_edges
          UNION SELECT dag, task FROM task_runs) t
    JOIN (SELECT DISTINCT dag, logical_ts FROM task_runs) d ON d.dag = t.dag
    LEFT JOIN task_edges e ON e.dag = t.dag AND e.child = t.task
    LEFT JOIN task_runs r ON r.dag = e.dag AND r.task = e.parent AND r.logical_ts = d.logical_ts
    GROUP BY 1, 2, 3
"""


@query(
    "q_trigger_rules",
    f"""
    SELECT dag, task, logical_ts, n_success = n_upstream AS all_success, n_success > 0 OR n_upstream = 0 AS one_success,
           n_failed = n_upstream AS all_failed FROM ({_UPSTREAM}) u
    """,
    _V,
)
def trigger_rules(spark, sf):
    return runs.trigger_rules(runs.upstream_states(view(spark, sf, "task_edges"), view(spark, sf, "task_runs")))


@query(
    "q_readiness",
    f"""
    SELECT dag, task, logical_ts, CASE task WHEN 't2' THEN 'one_success' WHEN 't3' THEN 'all_failed' ELSE 'all_success' END
           AS trigger_rule,
           CASE task WHEN 't2' THEN n_success > 0 OR n_upstream = 0 WHEN 't3' THEN n_failed = n_upstream ELSE n_success = n_upstream END AS ready
    FROM ({_UPSTREAM}) u
    """,
    _V,
)
def readiness(spark, sf):
    edges = view(spark, sf, "task_edges")
    rules = F.array(
        *[
            F.struct(F.lit(t).alias("task"), F.lit(r).alias("trigger_rule"))
            for t, r in (("t2", "one_success"), ("t3", "all_failed"))
        ]
    )
    named = edges.select("dag").distinct().select("dag", F.inline(rules))
    return runs.readiness(edges, view(spark, sf, "task_runs"), named)


_RUN_STATE = """
    SELECT r.dag, r.logical_ts,
           CASE WHEN count(*) FILTER (state = 'running') > 0
                     AND count(*) FILTER (state = 'running') = count(*) FILTER (state = 'running' AND {blocked}) THEN 'failed'
                WHEN count(*) FILTER (state = 'running') > 0 THEN 'running'
                WHEN count(*) FILTER (state = 'failed' AND task IN ('t4', 't5')) > 0 THEN 'failed' ELSE 'success' END AS run_state
    FROM task_runs r GROUP BY 1, 2
"""


@query("q_run_state", _RUN_STATE.format(blocked="false"), ("task_runs",))
def run_state(spark, sf):
    return runs.run_state(view(spark, sf, "task_runs"), view(spark, sf, "task_edges"))


@query("q_run_deadlock", _RUN_STATE.format(blocked="task = 't5'"), ("task_runs",))
def run_deadlock(spark, sf):
    task_runs = view(spark, sf, "task_runs")
    stuck = task_runs.filter((F.col("task") == "t5") & (F.col("state") == "running"))
    return runs.run_state(task_runs, view(spark, sf, "task_edges"), stuck)


@query(
    "q_past_ok",
    """
    SELECT dag, task, logical_ts, state, prev_state, coalesce(prev_state = 'success', true) AS may_run
    FROM (SELECT *, lag(state) OVER (PARTITION BY dag, task ORDER BY logical_ts) AS prev_state FROM task_runs) x
    """,
    ("task_runs",),
)
def past_ok(spark, sf):
    return runs.depends_on_past(view(spark, sf, "task_runs"))


@query(
    "q_past_downstream",
    """
    , p AS (SELECT *, lag(state) OVER (PARTITION BY dag, task ORDER BY logical_ts) AS prev_state,
                   lag(logical_ts) OVER (PARTITION BY dag, task ORDER BY logical_ts) AS prev_ts FROM task_runs)
    SELECT dag, task, logical_ts, state, prev_state, coalesce(prev_state = 'success', true) AND NOT (
      task = 't1' AND EXISTS (SELECT 1 FROM task_edges e JOIN task_runs c ON c.dag = e.dag AND c.task = e.child
        WHERE e.dag = p.dag AND e.parent = p.task AND c.logical_ts = p.prev_ts AND c.state <> 'success')) AS may_run
    FROM p
    """,
    _V,
)
def past_downstream(spark, sf):
    edges = view(spark, sf, "task_edges")
    waiting = edges.select("dag").distinct().withColumn("task", F.lit("t1"))
    return runs.depends_on_past(view(spark, sf, "task_runs"), edges, waiting)


def _consumers(spark, sf):
    dags = view(spark, sf, "dags")
    return dags.select(
        F.concat(F.lit("data/"), "dag").alias("dataset"),
        F.explode(F.array(F.concat(F.lit("report-"), "dag"), F.concat(F.lit("archive-"), "dag"))).alias("consumer"),
    )


def _updates(spark, sf):
    return view(spark, sf, "task_runs").select(
        F.concat(F.lit("data/"), "dag").alias("dataset"), F.col("task").alias("producer"), "logical_ts", "state"
    )


@query(
    "q_triggered",
    """
    SELECT k || dag AS consumer, 'data/' || dag AS dataset, task AS producer, logical_ts
    FROM task_runs, (VALUES ('report-'), ('archive-')) v(k) WHERE state = 'success'
    """,
    ("task_runs",),
)
def triggered(spark, sf):
    return runs.triggered_runs(_updates(spark, sf), _consumers(spark, sf))


@query(
    "q_triggered_any",
    """
    SELECT DISTINCT 'data/' || dag AS dataset, k || dag AS consumer
    FROM task_runs, (VALUES ('report-'), ('archive-')) v(k) WHERE state = 'success'
    """,
    ("task_runs",),
)
def triggered_any(spark, sf):
    return runs.triggered_consumers(_updates(spark, sf), _consumers(spark, sf))


@query(
    "q_lookback",
    """
    SELECT r.event_id, r.user_id, r.logical_ts, cast(m.value AS varchar) AS value
    FROM readers r ASOF LEFT JOIN messages m ON r.user_id = m.user_id AND r.logical_ts >= m.logical_ts
    """,
    ("readers", "messages"),
)
def lookback(spark, sf):
    found = runs.lookback(view(spark, sf, "readers"), view(spark, sf, "messages"), ["user_id"])
    return found.withColumn("value", F.col("value").cast("string"))


@query(
    "q_same_run",
    """
    SELECT r.event_id, cast(r.day AS varchar) AS day, cast(m.value AS varchar) AS value
    FROM (SELECT event_id, event_type, cast(ts AS date) AS day FROM events) r
    LEFT JOIN (SELECT event_type, cast(ts AS date) AS day, max(value) AS value FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1, 2) m
    ON r.event_type = m.event_type AND r.day = m.day
    """,
)
def same_run(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    pushed = events.filter(F.col("event_type").isin("purchase", "error")).select("event_type", "day", "value")
    found = runs.same_run(events.select("event_id", "event_type", "day"), pushed, ["event_type"], "day")
    return found.select("event_id", F.col("day").cast("string").alias("day"), F.col("value").cast("string").alias("value"))


@query(
    "q_run_gaps",
    """
    SELECT dag, task, logical_ts, cast(coalesce(date_diff('second', lag(logical_ts) OVER
           (PARTITION BY dag, task ORDER BY logical_ts), logical_ts), -1) AS bigint) AS gap_seconds FROM task_runs
    """,
    ("task_runs",),
)
def run_gaps(spark, sf):
    gaps = runs.run_gaps(view(spark, sf, "task_runs").drop("state"), ["dag", "task"])
    return gaps.withColumn("gap_seconds", F.coalesce("gap_seconds", F.lit(-1)))


@query(
    "q_event_pivot",
    """
    SELECT user_id, arg_max(CASE WHEN event_type = 'view' THEN 'on-start-' || event_id END, CASE WHEN event_type = 'view' THEN event_id END) AS "start",
           arg_max(CASE WHEN event_type = 'purchase' THEN 'on-complete-' || event_id END, CASE WHEN event_type = 'purchase' THEN event_id END) AS "complete",
           arg_max(CASE WHEN event_type = 'error' THEN 'on-failure-' || event_id END, CASE WHEN event_type = 'error' THEN event_id END) AS "failure"
    FROM events GROUP BY 1
    """,
)
def event_pivot(spark, sf):
    kind = (
        F.when(F.col("event_type") == "view", "start")
        .when(F.col("event_type") == "purchase", "complete")
        .when(F.col("event_type") == "error", "failure")
    )
    events = table(spark, sf, "events").select(
        "user_id", "event_id", kind.alias("event"), F.concat(F.lit("on-"), kind, F.lit("-"), "event_id").alias("dataset")
    )
    return runs.event_states(events, ["user_id"], "event", ["start", "complete", "failure"], "event_id")
