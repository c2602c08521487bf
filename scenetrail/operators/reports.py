"""The small SQL reports: union, counts, totals, scaling target, reconciliation, running total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def combine(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union across and within the inputs."""
    return a.unionByName(b).distinct()


def count_by(df: DataFrame, keys: list[str], counted: str, name: str = "number") -> DataFrame:
    """Rows per group with a value in ``counted``; a group of nulls counts 0."""
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def total(df: DataFrame, value: str | Column, name: str = "total") -> DataFrame:
    """Sum over all rows; null on an empty table."""
    return df.agg(F.sum(value).alias(name))


def mean(df: DataFrame, value: str | Column, name: str = "mean") -> DataFrame:
    """Average over all rows; null on an empty table."""
    return df.agg(F.avg(value).alias(name))


def is_active(not_queue: str | None = None) -> Column:
    """Whether a task instance is running or queued, outside a queue if one is named."""
    running = F.col("state").isin("running", "queued")
    return running & (F.col("queue") != not_queue) if not_queue is not None else running


def active(df: DataFrame, not_queue: str | None = None) -> DataFrame:
    """Task instances that are running or queued, outside a queue if one is named."""
    return df.filter(is_active(not_queue))


def scale_targets(df: DataFrame, kinds: list[tuple[str, Column, int]]) -> DataFrame:
    """(kind, target): for each (kind, condition, rows a worker), the workers needed, in one pass over the rows."""
    targets = [F.struct(F.lit(kind).alias("kind"), F.ceil(F.count_if(on) / F.lit(per_worker)).cast("long").alias("target")) for kind, on, per_worker in kinds]
    return df.agg(F.array(*targets).alias("targets")).select(F.inline("targets"))


def scale_target(df: DataFrame, per_worker: int, name: str = "target") -> DataFrame:
    """Workers needed for the rows, rounded up."""
    return df.agg(F.ceil(F.count("*") / F.lit(per_worker)).cast("long").alias(name))


def manifest_reconcile(reported: DataFrame, items: DataFrame, run: str) -> DataFrame:
    """Number of files that a run reports against the items in its manifest."""
    listed = items.groupBy(run).agg(F.count("*").alias("listed"))
    return (
        reported.select(run, F.col("num_files").alias("reported"))
        .join(listed, run, "left")
        .withColumn("listed", F.coalesce("listed", F.lit(0)))
        .withColumn("matches", F.col("reported") == F.col("listed"))
    )


def running_total(df: DataFrame, ts: str, value: str | Column, minutes: int = 5) -> DataFrame:
    """(slot_end, total): the sum of everything before the end of each slot that has rows.

    Rows are reduced to slots first. Slots are summed within their day, and days among each other, so no
    window holds more than the slots of a day or the days of the table.
    """
    slots = (
        df.groupBy(F.window(ts, f"{minutes} minutes")["end"].alias("slot_end"))
        .agg(F.sum(value).alias("_v"))
        .withColumn("_day", F.to_date("slot_end"))
    )
    days = slots.groupBy("_day").agg(F.sum("_v").alias("_v"))
    earlier = W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select("_day", F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_before"))
    in_day = W.partitionBy("_day").orderBy("slot_end").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        slots.withColumn("_in_day", F.sum("_v").over(in_day))
        .join(days, "_day")
        .select("slot_end", (F.col("_before") + F.col("_in_day")).alias("total"))
    )
