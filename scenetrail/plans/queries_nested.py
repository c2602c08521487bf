"""Queries on lists, JSON, entities and user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from scenetrail.operators import nested, rowfns
from scenetrail.plans.derived import table, view
from scenetrail.plans.registry import query

_UNNEST = "SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS idx FROM embeddings"


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


@query("q_expand", f"SELECT vec_id, cast(x AS double) AS item FROM ({_UNNEST}) u")
def expand(spark, sf):
    return nested.expand(_vectors(spark, sf), "embedding").withColumn("item", F.col("item").cast("double"))


@query(
    "q_expand_chain",
    f"SELECT vec_id, idx, cast(x AS double) * 2 AS step_1, cast(x AS double) * 2 + 1 AS step_2 FROM ({_UNNEST}) u",
)
def expand_chain(spark, sf):
    steps = (lambda x: x.cast("double") * 2, lambda x: x + 1)
    return nested.expand_chain(_vectors(spark, sf), "embedding", *steps).drop("item")


@query(
    "q_expand_mixed",
    """
    SELECT event_id, 0 AS idx, 'BIGINT' AS type, cast(event_id AS varchar) AS value FROM events
    UNION ALL SELECT event_id, 1, 'STRING', '"' || event_type || '"' FROM events
    UNION ALL SELECT event_id, 2, 'OBJECT<k: BIGINT>', replace(props, ' ', '') FROM events
    """,
)
def expand_mixed(spark, sf):
    mixed = F.concat(F.lit("["), "event_id", F.lit(', "'), "event_type", F.lit('", '), "props", F.lit("]"))
    return nested.expand_mixed(table(spark, sf, "events").select("event_id", mixed.alias("items")), "items")


@query(
    "q_collect",
    f"""
    SELECT vec_id, cast(floor(idx / 16) AS bigint) AS chunk_no,
           string_agg(cast(cast(floor(cast(x AS double) * 1000) AS bigint) AS varchar), ',' ORDER BY idx) AS vals
    FROM ({_UNNEST}) u GROUP BY 1, 2
    """,
)
def collect(spark, sf):
    scaled = nested.expand_chain(_vectors(spark, sf), "embedding", lambda x: F.floor(x.cast("double") * 1000))
    back = nested.collect_mapped(scaled, ["vec_id"], "idx", "step_1", chunk=16)
    return back.select("vec_id", "chunk_no", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("vals"))


@query(
    "q_map_in_place",
    f"""
    SELECT vec_id, string_agg(cast(cast(floor(cast(x AS double) * 1000) AS bigint) + 1 AS varchar), ',' ORDER BY idx) AS vals
    FROM ({_UNNEST}) u GROUP BY 1
    """,
)
def map_in_place(spark, sf):
    mapped = nested.map_in_place(
        "embedding", lambda x: F.floor(x.cast("double") * 1000) + 1, lambda x: x.cast("string")
    )
    return _vectors(spark, sf).select("vec_id", F.array_join(mapped, ",").alias("vals"))


@query("q_props", "SELECT event_id, cast(props::json ->> 'k' AS int) AS k FROM events")
def props(spark, sf):
    return table(spark, sf, "events").select("event_id", *nested.props("props", {"k": "int"}))


@query("q_normalise", f"SELECT vec_id, idx, cast(x AS double) / 255.0::double AS value FROM ({_UNNEST}) u")
def normalise(spark, sf):
    return _vectors(spark, sf).select("vec_id", F.posexplode(nested.normalise_array("embedding")).alias("idx", "value"))


@query(
    "q_entities",
    "SELECT dag, 'Table' AS entity, fqn, key FROM declared",
    ("declared",),
)
def entities(spark, sf):
    rows = view(spark, sf, "declared")
    made = nested.entity_struct("Table", F.col("fqn"), F.col("key"))
    return rows.select("dag", made.alias("e")).select("dag", "e.*")


@query(
    "q_entity_maps",
    """
    SELECT o_orderkey, 'tables' AS entity, 'shop.' || o_custkey AS fqn FROM orders
    UNION ALL SELECT o_orderkey, 'tables', 'shop.' || o_orderstatus FROM orders
    """,
)
def entity_maps(spark, sf):
    fqns = F.array(F.concat(F.lit("shop."), "o_custkey"), F.concat(F.lit("shop."), "o_orderstatus"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.create_map(F.lit("tables"), fqns).alias("inlets"))
    return nested.entities_from_map(rows, "inlets")


@query(
    "q_udf_map",
    "SELECT event_id, event_type || '_processed' AS label, cast(round(value * 100) AS bigint) AS cents FROM events",
)
def udf_map(spark, sf):
    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        cents = (pdf["value"] * 100).round().astype("int64")
        return pd.DataFrame({"event_id": pdf["event_id"], "label": pdf["event_type"] + "_processed", "cents": cents})

    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return rowfns.map_rows(events, finish, "event_id long, label string, cents long")


@query(
    "q_udtf",
    """
    SELECT o_orderkey, i + 1 AS part, 'dataset' || (i + 1) AS name
    FROM (SELECT o_orderkey, unnest(range(o_custkey % 4)) AS i FROM orders) x
    """,
)
def udtf(spark, sf):
    def datasets(n: int):
        return [(i, f"dataset{i}") for i in range(1, n + 1)]

    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 4).cast("int").alias("n"))
    return rowfns.expand_rows(orders, datasets, ["n"], "part bigint, name string").select("o_orderkey", "part", "name")


@query(
    "q_udaf",
    """
    SELECT event_type, cast(floor(sum(cast(round(value * 100) AS bigint)) / count(*)) AS bigint) AS mean_cents,
           count(*) AS n FROM events GROUP BY 1
    """,
)
def udaf(spark, sf):
    cents = table(spark, sf, "events").select("event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    parts = rowfns.reduce_group(
        cents,
        ["event_type"],
        "cents",
        lambda values: (int(values.sum()), len(values)),
        lambda rows: (int(rows["total"].sum()), int(rows["n"].sum())),
        "total long, n long",
    )
    return parts.select("event_type", F.floor(F.col("total") / F.col("n")).alias("mean_cents"), "n")
