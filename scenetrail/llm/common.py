"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions go to the executors with their code, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows in DuckDB."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql.strip()
        return fn

    return register


def small_batches() -> None:
    """Hand texts to Python a thousand at a time, so that a worker holds little at once."""
    SparkSession.active().conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def arrow_function(fn: Callable, kind: str) -> Callable[..., Column]:
    """A column function over Arrow arrays that is run once a row.

    Declared as not deterministic, because the optimizer runs a deterministic one again below every filter on its
    result.
    """
    small_batches()
    return F.arrow_udf(fn, kind).asNondeterministic()


def by_bytes(fn: Callable, kind: str) -> Callable[..., Column]:
    """A column function over an iterator of Arrow arrays, run once a row, with its tables made once a task.

    Spark bounds a batch by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    return F.arrow_udf(fn, kind).asNondeterministic()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxed(df: DataFrame, box: str = "_row") -> DataFrame:
    """All columns of ``df`` in one struct, so that working columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(box))


def unboxed(df: DataFrame, columns: list[str], box: str = "_row", **more: Column) -> DataFrame:
    """The columns of the struct again, and ``more``, which replace columns of the same name."""
    kept = [F.col(box).getField(c).alias(c) for c in columns if c not in more]
    return df.select(*kept, *[value.alias(name) for name, value in more.items()])


FILTER_BITS = 1 << 23
_SEGMENT = 8 * 4096  # bits that Spark keeps in one bitmap row


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of fixed size (1 MB) with the bit of every 64-bit key set.

    It only saves work before an exact join: keys that are not in ``keys`` may pass.
    """
    bit = F.pmod(F.col(key), F.lit(FILTER_BITS))
    parts = (
        keys.select(F.floor(bit / _SEGMENT).cast("int").alias("part"), F.pmod(bit, F.lit(_SEGMENT)).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # at most FILTER_BITS / _SEGMENT = 256 rows of 4 KB
    )
    out = np.zeros((FILTER_BITS // _SEGMENT, _SEGMENT // 8), np.uint8)
    for row in parts:
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set in a bitmap of ``key_filter``."""
    at = keys.astype(np.int64) & (FILTER_BITS - 1)  # the same as pmod by a power of two
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
