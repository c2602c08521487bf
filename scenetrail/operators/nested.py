"""Lists, mixed lists, JSON properties and entity records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand(df: DataFrame, items: str, name: str = "item") -> DataFrame:
    """One row per list element; an empty list gives none."""
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.explode(items).alias(name))


def expand_chain(df: DataFrame, items: str, *steps: Callable[[Column], Column]) -> DataFrame:
    """One row per element with its index, and one column per step that maps the result before it."""
    kept = [c for c in df.columns if c != items]
    out = df.select(*kept, F.posexplode(items).alias("idx", "item"))
    value = F.col("item")
    for i, step in enumerate(steps, start=1):
        value = step(value)
        out = out.withColumn(f"step_{i}", value)
    return out


def expand_mixed(df: DataFrame, json: str) -> DataFrame:
    """Elements of a JSON list of mixed types: index, type and JSON text."""
    kept = [c for c in df.columns if c != json]
    items = F.expr(f"variant_get(try_parse_json({json}), '$', 'array<variant>')")
    return df.select(*kept, F.posexplode(items).alias("idx", "_v")).select(
        *kept, "idx", F.schema_of_variant("_v").alias("type"), F.to_json("_v").alias("value")
    )


def collect_mapped(df: DataFrame, keys: list[str], idx: str, value: str, chunk: int) -> DataFrame:
    """Mapped results back in index order: (keys, chunk_no, values).

    Lists come back in parts of the width ``chunk`` that the caller gives, so no group grows without bound.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(value).alias("v"))))
    return (
        df.withColumn("chunk_no", F.floor(F.col(idx) / chunk))
        .groupBy(*keys, "chunk_no")
        .agg(F.transform(ordered, lambda x: x["v"]).alias("values"))
    )


def map_in_place(items: str | Column, *steps: Callable[[Column], Column]) -> Column:
    """Map a list without taking it apart: expand and collect in one expression, no shuffle."""
    out = F.col(items) if isinstance(items, str) else items
    for step in steps:
        out = F.transform(out, step)
    return out


def normalise_array(items: str, scale: float = 255.0) -> Column:
    return F.transform(F.col(items), lambda x: x.cast("double") / F.lit(scale))


def props(json: str, fields: dict[str, str]) -> list[Column]:
    """Fields of a JSON text by name and type; null where the text does not have them."""
    schema = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    parsed = F.from_json(F.col(json), schema)
    return [parsed[name].alias(name) for name in fields]


def entity_struct(entity: str | Column, fqn: str | Column, key: str | Column) -> Column:
    def as_column(x):
        return F.lit(x) if isinstance(x, str) else x

    return F.struct(as_column(entity).alias("entity"), as_column(fqn).alias("fqn"), as_column(key).alias("key"))


def entities_from_map(df: DataFrame, entity_map: str) -> DataFrame:
    """Entity names out of a map such as ``{"tables": [fqn, ...]}``."""
    kept = [c for c in df.columns if c != entity_map]
    return df.select(*kept, F.explode(entity_map).alias("entity", "_names")).select(
        *kept, "entity", F.explode("_names").alias("fqn")
    )
