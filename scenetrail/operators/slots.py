"""Assignment of items to a fixed number of slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scenetrail.operators.ordered import enumerate_rows, number_in_key, tie_hash

FEW = 1000  # up to this many first rows, Spark's group limit leaves each task no more of a group before the shuffle


def take(df: DataFrame, n: int, order_by: list[str | Column], by: list[str] | None = None) -> DataFrame:
    """First ``n`` items in order, of all rows or of each group; adds the 0-based ``idx``.

    Few rows of a group are taken by a ranking window: each task keeps its own first ``n`` and only these are
    shuffled. For more than ``FEW``, rows are numbered in even slices of the whole order, so that neither a large ``n``
    nor a group that owns most rows meets in one task. Ties are broken alike in both: by a hash of the row.
    """
    by = by or []
    if n > FEW:
        return _numbered(df, order_by, by).filter(F.col("idx") < n)
    order = [*order_by, tie_hash(df)]
    if not by:
        df = df.orderBy(*order).limit(n)
    first = df.withColumn("idx", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("idx") <= n)
    return first.withColumn("idx", F.col("idx").cast("bigint") - 1)


def _numbered(df: DataFrame, order_by: list[str | Column], by: list[str]) -> DataFrame:
    if not by:
        return enumerate_rows(df, order_by)
    return number_in_key(df, by, order_by, "idx").withColumn("idx", F.col("idx") - 1)


def assign_slots(df: DataFrame, item: str, k: int, order_by: list[str], by: list[str] | None = None) -> DataFrame:
    """Slots 0..k-1 with their item; a slot past the end of the list holds null."""
    by = by or []
    filled = take(df, k, order_by, by)
    held = filled.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("idx", item))).alias("_held"))
    slots = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot")
    return held.select(*by, "_held", slots).select(
        *by, "slot", F.try_element_at("_held", F.col("slot").cast("long")).alias(item)
    )


def slot_overflow(df: DataFrame, k: int, order_by: list[str], by: list[str] | None = None) -> DataFrame:
    """Items that found no slot."""
    return _numbered(df, order_by, by or []).filter(F.col("idx") >= k).drop("idx")


def sorted_items(df: DataFrame, items: str) -> DataFrame:
    """Sort an array column, for order-free comparison of lists."""
    return df.withColumn(items, F.array_sort(items))
