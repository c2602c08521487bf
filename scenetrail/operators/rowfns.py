"""User functions: one row to one, one to many, and many to one."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scenetrail.session import cut

EXPANDED_ROWS = 10_000  # in one batch that goes back to Spark
FAN_IN = 64  # partial rows that are merged at once, about


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """Apply a function to batches of rows, inside the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def expand_rows(df: DataFrame, fn: Callable[..., Iterable[tuple]], columns: list[str], schema: str) -> DataFrame:
    """Apply a function that gives several rows for one. Batches of rows go to Python as Arrow tables."""
    made = T.StructType.fromDDL(schema)
    fields = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            args = [batch.column(c).to_pylist() for c in columns]
            rows = [(i, row) for i, values in enumerate(zip(*args)) for row in fn(*values)]
            for at in range(0, len(rows), EXPANDED_ROWS):
                part = rows[at : at + EXPANDED_ROWS]
                kept = batch.take(pa.array([i for i, _ in part], pa.int32()))
                new = [pa.array([row[j] for _, row in part], f.type) for j, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*kept.schema.names, *fields.names])

    return df.mapInArrow(run, T.StructType([*df.schema, *made]))


def reduce_group(
    df: DataFrame,
    keys: list[str],
    value: str,
    partial: Callable[[pd.Series], tuple],
    merge: Callable[[pd.DataFrame], float],
    partial_schema: str,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Apply a reducing function to the values of each group, as a tree.

    ``partial`` reduces the values of a batch to one row of ``partial_schema``; ``merge`` reduces the
    partial rows of a group. Values are first reduced where they lie. As long as some group has more than ``fan_in``
    partial rows, its rows are dealt to pieces of about that many, and each piece becomes one row; so no task merges
    more of a group, whatever its size, and the rounds follow the logarithm of the largest group.
    ``merge`` must give the same answer whichever way its rows are grouped: it returns partial rows too,
    and ``result`` is read from them by the caller.
    """
    names = [f.name for f in T.StructType.fromDDL(partial_schema)]
    key_schema = T.StructType([df.schema[k] for k in keys])
    schema = T.StructType([*key_schema, *T.StructType.fromDDL(partial_schema)])

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*(k if isinstance(k, tuple) else (k,)), *partial(g[value]))
                for k, g in batch.groupby(keys, dropna=False, sort=False)
            ]
            yield pd.DataFrame(rows, columns=[*keys, *names])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[keys].iloc[[0]].reset_index(drop=True)
        merged = pd.DataFrame([merge(pdf[names])], columns=names)
        return pd.concat([head, merged], axis=1)

    parts = cut(df.select(*keys, value).mapInPandas(local, schema), "partial")
    while True:
        most = parts.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= fan_in:
            return parts.groupBy(*keys).applyInPandas(join, schema)
        # Rows of the written table keep their numbers, so a task that is run again deals them alike.
        piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-most // fan_in))).alias("_piece")
        dealt = parts.select("*", piece).groupBy(*keys, "_piece").applyInPandas(join, schema)
        parts = cut(dealt, "partial")
