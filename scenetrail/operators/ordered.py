"""Order-dependent operators that hold up when one key owns a large part of the rows.

A plain window puts a whole key into one task. Here the rows are range-sorted into slices of about
equal size, the slices are written to the shared folder, each slice is windowed by itself, and what
one slice hands on to the next is worked out on one summary row per slice. The number of slices is at
most the number of shuffle partitions, so the summary can be broadcast whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenetrail.session import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in the low 33 bits


def _sliced(df: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """Sort globally and keep the place of each row as ``_slice`` and ``_row``.

    Rows that agree in every sort column are told apart by a hash of their values, so that range
    partitioning can split them and a task that is run again places them alike. Only equal rows, which can
    stand for each other, are told apart by number.
    """
    placed = (
        df.withColumn("_hash", tie_hash(df))
        .withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*order_by, "_hash", "_tie")
        .drop("_hash", "_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_place", _ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )
    return cut(placed, "slices")


def tie_hash(df: DataFrame) -> Column:
    """A hash of a row's values, which orders rows that agree otherwise."""
    return F.xxhash64(*[f"`{f.name}`" for f in df.schema.fields if not _holds_map(f.dataType)])


def _holds_map(kind: T.DataType) -> bool:
    """Whether a type cannot be hashed because it is or holds a map or variant."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def enumerate_rows(df: DataFrame, order_by: list[str | Column], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in the given order."""
    rows = _sliced(df, order_by)
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        rows.join(F.broadcast(starts), "_slice")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_slice", "_row", "_start")
    )


def number_in_key(
    df: DataFrame, keys: list[str], order_by: list[str | Column], name: str = "number"
) -> DataFrame:
    """Add the 1-based position of each row among the rows of its key."""
    placed = enumerate_rows(df, [*keys, *order_by], "_idx").withColumn("_key", F.struct(*keys))
    first = placed.groupBy("_key").agg(F.min("_idx").alias("_first")).withColumnRenamed("_key", "_of")
    joined = placed.join(first, F.col("_key").eqNullSafe(F.col("_of")))
    return joined.withColumn(name, F.col("_idx") - F.col("_first") + 1).drop("_idx", "_first", "_key", "_of")


def _carried(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per slice: the newest non-null value of the key that the slice begins with, from earlier slices."""
    own_key = F.struct(*keys)
    summary = rows.groupBy("_slice").agg(
        F.min_by(own_key, "_row").alias("_first_key"),
        F.max_by(
            F.struct(own_key.alias("k"), F.col(value).alias("v")),
            F.when(F.col(value).isNotNull(), F.col("_row")),
        ).alias("_tail"),
    )
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return (
        summary.withColumn("_tail", F.last("_tail", ignorenulls=True).over(before))
        .filter(F.col("_tail.k").eqNullSafe(F.col("_first_key")))
        .select("_slice", F.col("_tail.k").alias("_key"), F.col("_tail.v").alias("_carry"))
    )


def _fill(rows: DataFrame, keys: list[str], value: str, inner: Column, name: str) -> DataFrame:
    rows = rows.withColumn("_inner", inner)
    carried = F.broadcast(_carried(rows.drop("_inner"), keys, value))
    out = rows.join(carried, "_slice", "left").withColumn(
        name,
        F.when(F.col("_inner").isNotNull(), F.col("_inner")).when(
            F.col("_key").eqNullSafe(F.struct(*keys)), F.col("_carry")
        ),
    )
    return out.drop("_inner", "_key", "_carry", "_slice", "_row")


def previous_value(
    df: DataFrame, keys: list[str], order_by: list[str | Column], value: str | Column, name: str
) -> DataFrame:
    """Add the value of the previous row of the same key, as ``lag`` does."""
    boxed = df.withColumn("_v", F.struct((F.col(value) if isinstance(value, str) else value).alias("x")))
    rows = _sliced(boxed, [*keys, *order_by])
    inner = F.lag("_v").over(W.partitionBy("_slice", *keys).orderBy("_row"))
    out = _fill(rows, keys, "_v", inner, "_box").drop("_v")
    return out.withColumn(name, F.col("_box.x")).drop("_box")


def last_known(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    name: str,
) -> DataFrame:
    """As-of join: the newest value of ``right`` at or before the time of each ``left`` row.

    Of several values at one instant the largest counts.
    """
    kept = left.columns
    messages = right.groupBy(*keys, ts).agg(F.max(value).alias("_m")).filter(F.col("_m").isNotNull())
    both = (
        left.withColumn("_m", F.lit(None).cast(messages.schema["_m"].dataType))
        .withColumn("_reader", F.lit(1))
        .unionByName(messages.withColumn("_reader", F.lit(0)), allowMissingColumns=True)
    )
    rows = _sliced(both, [*keys, ts, "_reader"])
    inner = F.last("_m", ignorenulls=True).over(
        W.partitionBy("_slice", *keys).orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    out = _fill(rows, keys, "_m", inner, name)
    return out.filter(F.col("_reader") == 1).select(*kept, name)
