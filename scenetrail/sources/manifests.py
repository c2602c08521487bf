"""Line-oriented sources and sinks: manifests and tagged command output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scenetrail.functions.names import strip
from scenetrail.functions.text import lines


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Items of text manifests as (path, line_no, item); blank lines are dropped, repeats are kept.

    Files are read in splits. A line number is the position inside its split plus the number of
    lines in the earlier splits of the file, so no file passes through one task; only one summary
    row per split is windowed.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        F.col("value"),
    )
    blocks = raw.groupBy("path", "_block").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    item = strip("value")
    return (
        raw.join(blocks, ["path", "_block"])
        .select("path", (F.col("_before") + F.col("_seq") - F.col("_first")).alias("line_no"), item.alias("item"))
        .filter(F.length("item") > 0)
    )


def manifest_items(df: DataFrame, body: str, *keys: str) -> DataFrame:
    """The same for manifests held in a column: (keys, line_no, item)."""
    return (
        df.select(*keys, F.posexplode(lines(body)).alias("line_no", "_line"))
        .select(*keys, "line_no", strip("_line").alias("item"))
        .filter(F.length("item") > 0)
    )


def write_manifest(df: DataFrame, item: str, order_by: list[str], path: str) -> None:
    """Write one item per line, in order over the sorted part files; an earlier manifest is replaced."""
    df.orderBy(*order_by).select(F.col(item).alias("value")).write.mode("overwrite").text(path)


def read_tagged_output(
    df: DataFrame, run: str, body: str, tags: dict[str, str], required: tuple[str, ...] = ()
) -> DataFrame:
    """One row per run with one column per tag, and an ``error`` column.

    ``tags`` maps a tag to the type of its column. A later line of a tag replaces an earlier one. The
    value is the line without any occurrence of the tag. Each body is one row, so the tags are picked
    out of its lines in place and nothing is shuffled.
    """
    split = lines(body)

    def last_value(tag: str):
        mark = F.lit(f"{tag}:")
        last = F.try_element_at(F.filter(split, lambda line: F.startswith(line, mark)), F.lit(-1))
        return strip(F.replace(last, mark, F.lit("")))

    picked = [last_value(tag).try_cast(kind).alias(tag.lower()) for tag, kind in tags.items()]
    out = df.select(run, *picked)
    absent = [
        F.when(F.coalesce(F.col(t.lower()).cast("string"), F.lit("")) == "", F.lit(t.lower())) for t in required
    ]
    missing = F.array_compact(F.array(*absent)) if absent else F.array().cast("array<string>")
    return out.withColumn(
        "error", F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
    )
