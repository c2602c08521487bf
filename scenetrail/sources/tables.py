"""Tables: creation, insertion, literal rows and keyed state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_if_absent(spark: SparkSession, table: str, columns: str, location: str | None = None) -> None:
    """``columns`` is a DDL column list; with a location the files outlive the table."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{where}")


def insert_into(df: DataFrame, table: str) -> None:
    """Append rows by column name."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.insertInto(table)


def drop_if_exists(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows; text is cast to the column type, as in a VALUES insert."""
    wanted = T.StructType.fromDDL(schema)
    as_text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    raw = spark.createDataFrame(as_text, T.StructType([T.StructField(f.name, T.StringType()) for f in wanted]))
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def state_put(df: DataFrame, key: str, items: str, path: str) -> None:
    """Replace the stored value of every key; ``items`` is an array column, kept as JSON."""
    df.select(F.col(key).cast("string").alias("key"), F.to_json(items).alias("value")).write.mode("overwrite").parquet(path)


def state_get(keys: DataFrame, key: str, path: str, default: str = "[]") -> DataFrame:
    """Stored JSON of each wanted key, or the default."""
    stored = keys.sparkSession.read.schema("key string, value string").parquet(path)
    return (
        keys.join(stored, F.col(key).cast("string") == F.col("key"), "left")
        .drop("key")
        .withColumn("value", F.coalesce("value", F.lit(default)))
    )
