"""Run-history rules: trigger rules, past runs, dataset triggers and look-back.

``task_runs`` is (dag, task, logical_ts, state); ``task_edges`` is (dag, parent, child).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetrail.operators.graph import leaves
from scenetrail.operators.ordered import last_known, previous_value

# Task states that end a task, and those that mean it did not work.
FAILED_STATES = ("failed", "upstream_failed")
DONE_STATES = ("success", "skipped", *FAILED_STATES)


def upstream_states(task_edges: DataFrame, task_runs: DataFrame) -> DataFrame:
    """Per task and run: how many upstream tasks succeeded, failed, and exist.

    Every task of a dag, named by an edge or by a run, has a row in every run of it. An upstream task without a
    row in the run counts as not finished, and a task without upstream tasks has none of each. The states are
    joined to the edges and aggregated once; the run date keeps a large dag spread over tasks.
    """
    states = task_runs.select("dag", F.col("task").alias("parent"), "logical_ts", "state")
    n_parents = task_edges.groupBy("dag", "child").agg(F.count("*").alias("n_upstream"))
    tasks = (
        task_edges.select("dag", F.inline(F.array(F.struct(F.col("parent").alias("child")), F.struct("child"))))
        .unionByName(task_runs.select("dag", F.col("task").alias("child")))
        .distinct()
        .join(n_parents, ["dag", "child"], "left")
    )
    planned = tasks.join(task_runs.select("dag", "logical_ts").distinct(), "dag")
    seen = (
        task_edges.join(states, ["dag", "parent"])
        .groupBy("dag", "child", "logical_ts")
        .agg(
            F.count_if(F.col("state") == "success").alias("n_success"),
            F.count_if(F.col("state").isin(*FAILED_STATES)).alias("n_failed"),
        )
    )
    return planned.join(seen, ["dag", "child", "logical_ts"], "left").fillna(0, ["n_upstream", "n_success", "n_failed"])


def trigger_rules(upstream: DataFrame) -> DataFrame:
    """The three rules: all upstream tasks succeeded, one succeeded, all failed.

    A task without upstream tasks waits for nothing and meets all three.
    """
    n = F.col("n_upstream")
    return upstream.select(
        "dag",
        F.col("child").alias("task"),
        "logical_ts",
        (F.col("n_success") == n).alias("all_success"),
        ((F.col("n_success") > 0) | (n == 0)).alias("one_success"),
        (F.col("n_failed") == n).alias("all_failed"),
    )


def readiness(task_edges: DataFrame, task_runs: DataFrame, rules: DataFrame) -> DataFrame:
    """Whether a task may run: its rule (dag, task, trigger_rule; default all_success) over its upstream states."""
    checked = trigger_rules(upstream_states(task_edges, task_runs)).join(rules, ["dag", "task"], "left")
    rule = F.coalesce("trigger_rule", F.lit("all_success"))
    ready = (
        F.when(rule == "one_success", F.col("one_success"))
        .when(rule == "all_failed", F.col("all_failed"))
        .otherwise(F.col("all_success"))
    )
    return checked.select("dag", "task", "logical_ts", rule.alias("trigger_rule"), ready.alias("ready"))


def run_state(task_runs: DataFrame, task_edges: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """State of each run (dag, logical_ts) from its leaf tasks.

    An unfinished task keeps the run running, unless every unfinished task is among ``blocked`` (dag,
    task, logical_ts): that is a deadlock and fails. Otherwise a failed leaf fails the run. Tasks without
    edges are leaves.
    """
    inner = task_edges.select("dag", F.col("parent").alias("task")).distinct().withColumn("_inner", F.lit(True))
    rows = task_runs.join(inner, ["dag", "task"], "left")
    if blocked is not None:
        marks = blocked.select("dag", "task", "logical_ts").distinct().withColumn("_blocked", F.lit(True))
        rows = rows.join(marks, ["dag", "task", "logical_ts"], "left")
    else:
        rows = rows.withColumn("_blocked", F.lit(None).cast("boolean"))
    open_ = ~F.coalesce(F.col("state").isin(*DONE_STATES), F.lit(False))
    leaf_failed = F.col("_inner").isNull() & F.col("state").isin(*FAILED_STATES)
    per_run = rows.groupBy("dag", "logical_ts").agg(
        F.count_if(open_).alias("_open"),
        F.count_if(open_ & F.col("_blocked").isNotNull()).alias("_stuck"),
        F.count_if(leaf_failed).alias("_leaf_failed"),
    )
    state = (
        F.when((F.col("_open") > 0) & (F.col("_open") == F.col("_stuck")), F.lit("failed"))
        .when(F.col("_open") > 0, F.lit("running"))
        .when(F.col("_leaf_failed") > 0, F.lit("failed"))
        .otherwise(F.lit("success"))
    )
    return per_run.select("dag", "logical_ts", state.alias("run_state"))


def leaf_tasks(task_edges: DataFrame) -> DataFrame:
    return leaves(task_edges, ["dag"]).withColumnRenamed("node", "task")


def depends_on_past(
    task_runs: DataFrame, task_edges: DataFrame | None = None, waiting: DataFrame | None = None
) -> DataFrame:
    """Add ``prev_state`` and ``may_run``: the previous run of the task succeeded, or there is none.

    Tasks of ``waiting`` (dag, task) also need the previous run of their direct children in
    ``task_edges`` to have succeeded.
    """
    past = previous_value(
        task_runs, ["dag", "task"], ["logical_ts"], F.struct("logical_ts", "state"), "_prev"
    )
    ok = F.col("prev_state").isNull() | (F.col("prev_state") == "success")
    out = (
        past.withColumn("prev_state", F.col("_prev.state"))
        .withColumn("prev_ts", F.col("_prev.logical_ts"))
        .drop("_prev")
        .withColumn("may_run", ok)
    )
    if task_edges is None or waiting is None:
        return out.drop("prev_ts")
    wanted = task_edges.join(waiting.select("dag", F.col("task").alias("parent")), ["dag", "parent"], "left_semi")
    not_done = (
        wanted.join(
            task_runs.filter(F.coalesce(F.col("state") != "success", F.lit(True))).select(
                "dag", F.col("task").alias("child"), F.col("logical_ts").alias("prev_ts")
            ),
            ["dag", "child"],
        )
        .select("dag", F.col("parent").alias("task"), "prev_ts")
        .distinct()
        .withColumn("_held", F.lit(True))
    )
    return (
        out.join(not_done, ["dag", "task", "prev_ts"], "left")
        .withColumn("may_run", F.col("may_run") & F.col("_held").isNull())
        .drop("_held", "prev_ts")
    )


def triggered_runs(updates: DataFrame, consumers: DataFrame) -> DataFrame:
    """One consumer run per successful update (dataset, producer, logical_ts, state) of its dataset."""
    done = updates.filter(F.col("state") == "success").select("dataset", "producer", "logical_ts")
    return done.join(consumers.select("dataset", "consumer"), "dataset").select(
        "consumer", "dataset", "producer", "logical_ts"
    )


def triggered_consumers(updates: DataFrame, consumers: DataFrame) -> DataFrame:
    """Consumers with at least one successful update."""
    done = updates.filter(F.col("state") == "success").select("dataset").distinct()
    return consumers.join(done, "dataset", "left_semi")


def lookback(readers: DataFrame, messages: DataFrame, keys: list[str], ts: str = "logical_ts") -> DataFrame:
    """Add the newest message value at or before the time of each reader, from any earlier run."""
    return last_known(readers, messages, keys, ts, "value", "value")


def same_run(readers: DataFrame, messages: DataFrame, keys: list[str], ts: str = "logical_ts") -> DataFrame:
    """Add the message value of the same run; a run that pushed several keeps the largest."""
    pushed = messages.groupBy(*keys, ts).agg(F.max("value").alias("value"))
    return readers.join(pushed, [*keys, ts], "left")


def run_gaps(runs: DataFrame, keys: list[str], ts: str = "logical_ts") -> DataFrame:
    """Add ``gap_seconds`` since the previous run of the same key."""
    past = previous_value(runs, keys, [ts], ts, "_prev")
    return past.withColumn("gap_seconds", F.timestamp_diff("SECOND", F.col("_prev"), F.col(ts))).drop("_prev")


def event_states(events: DataFrame, keys: list[str], event: str, kinds: list[str], order: str) -> DataFrame:
    """Events (keys, event, dataset, order) as one row per key with the newest dataset of each kind of event.

    The newest has the largest ``order``, a time or a running number; of several, the largest dataset.
    """
    return events.groupBy(*keys).pivot(event, kinds).agg(F.max_by("dataset", F.struct(order, "dataset")))
