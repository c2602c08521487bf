"""Catalogue of entities named by service.database.schema.table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of entities by the number of parts in their name.
KINDS = ("service", "database", "schema", "table")


def with_parents(tables: DataFrame, fqn: str = "fqn") -> DataFrame:
    """Names and the names of everything above them: (fqn, kind, parent_fqn), each once.

    All that follows the third dot is the table's name. A name of fewer parts ends at its last kind.
    """
    parts = F.split(F.col(fqn), r"\.", len(KINDS))
    upto = lambda n: F.array_join(F.slice(parts, 1, n), ".")
    rows = [
        F.when(
            F.size(parts) > i,
            F.struct(
                upto(i + 1).alias("fqn"),
                F.lit(kind).alias("kind"),
                (upto(i) if i else F.lit(None).cast("string")).alias("parent_fqn"),
            ),
        )
        for i, kind in enumerate(KINDS)
    ]
    return tables.select(F.inline(F.array_compact(F.array(*rows)))).distinct()


def register_missing(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Entities to create, with ``create_order`` so that parents come before children."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return (
        candidates.join(catalog.select("fqn"), "fqn", "left_anti")
        .dropDuplicates(["fqn"])
        .withColumn("create_order", order)
    )


def registered(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """The catalogue after registration."""
    return catalog.unionByName(register_missing(candidates, catalog).select(*catalog.columns))


def catalog_path(catalog: DataFrame) -> DataFrame:
    """Schema, database and service of each table, by walking up the parents.

    Tables are many, everything above them is few; tables are not moved by a hot schema, because the
    walk is done on the schemas first and Spark splits or broadcasts the last join by measured size.
    """
    level = {k: catalog.filter(F.col("kind") == k) for k in KINDS}
    name = lambda kind: level[kind].select(F.col("fqn").alias(f"{kind}_fqn"), F.col("parent_fqn").alias("_up"))
    services = level["service"].select(F.col("fqn").alias("service_fqn"))
    databases = name("database").join(services, F.col("_up") == F.col("service_fqn")).drop("_up")
    schemas = name("schema").join(databases, F.col("_up") == F.col("database_fqn")).drop("_up")
    return name("table").join(schemas, F.col("_up") == F.col("schema_fqn")).drop("_up")
