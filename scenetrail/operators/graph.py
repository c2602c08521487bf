"""Graph operators on edge tables (parent, child), with optional grouping columns.

Rounds of ``levels`` and of a walk follow the depth of the graph, those of ``components`` its logarithm. Every round
writes its result to the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenetrail.session import cut, cut_in_buckets, scratch_path

SHRINK = 2  # times fewer next nodes make it worth to walk on from them alone


def roots(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Nodes that no edge leads to."""
    return degrees(edges, keys).filter(F.col("n_in") == 0).select(*(keys or []), "node")


def leaves(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Nodes that no edge starts from."""
    return degrees(edges, keys).filter(F.col("n_out") == 0).select(*(keys or []), "node")


def degrees(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Edges in and out per node. Both ends are counted in one partially aggregated shuffle."""
    keys = keys or []
    ends = F.array(
        F.struct(F.col("parent").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("child").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    return (
        edges.select(*keys, F.inline(ends))
        .groupBy(*keys, "node")
        .agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))
    )


def fan_shapes(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Shape of each node: ``chain``, ``fan_out``, ``fan_in``, ``both``, or an end of the graph."""
    many_in, many_out = F.col("n_in") > 1, F.col("n_out") > 1
    shape = (
        F.when(many_in & many_out, F.lit("both"))
        .when(many_in, F.lit("fan_in"))
        .when(many_out, F.lit("fan_out"))
        .when((F.col("n_in") == 1) & (F.col("n_out") == 1), F.lit("chain"))
        .otherwise(F.lit("end"))
    )
    return degrees(edges, keys).withColumn("shape", shape)


def _reach(edges: DataFrame, start: DataFrame, near: str, far: str, name: str, keys: list[str]) -> DataFrame:
    """Shared closure: as long as the next nodes are far fewer than the nodes they are reached from, only the edges to
    them are kept, and the walk goes on from the next nodes alone. What these reach is found once and joined back.

    Each of these rounds parts the edges in those that start at its nodes and the rest. If no edge leads back to these nodes,
    the next round reads the rest alone; where none follows, this is not looked for, which would shuffle the far ends of all edges.
    Edges that come twice are not made distinct beforehand, only what they reach is.
    """
    steps = edges.select(*keys, F.col(near).alias("_at"), F.col(far).alias("_next"))
    nodes = start.select(*keys, "node").distinct()
    firsts: list[DataFrame] = []
    while True:
        here = nodes.select(*keys, F.col("node").alias("_at"), F.lit(True).alias("_here"))
        parted = cut(steps.join(here, [*keys, "_at"], "left"), "parted")
        first = parted.filter("_here").select(*keys, F.col("_at").alias("node"), F.col("_next").alias("_at"))
        firsts.append(first)
        here, there = first.agg(
            F.approx_count_distinct(F.struct(*keys, "node")).alias("here"), F.approx_count_distinct(F.struct(*keys, "_at")).alias("there")
        ).first()
        nodes = first.select(*keys, F.col("_at").alias("node")).distinct()
        if there * SHRINK > here or not there:
            steps = parted.drop("_here")
            break
        reached = parted.select(*keys, F.col("_next").alias("node")).distinct()
        back = reached.join(first.select(*keys, "node").distinct(), [*keys, "node"], "left_semi")
        steps = (parted.filter("_here IS NULL") if back.isEmpty() else parted).drop("_here")
    reach = _walk(steps, nodes, keys) if there else firsts[0].limit(0).select(*keys, "node", "_at", F.lit(1).alias("distance"))
    for first in reversed(firsts):
        direct = first.withColumn("distance", F.lit(1))
        beyond = reach.select(*keys, F.col("node").alias("_at"), F.col("_at").alias("_far"), (F.col("distance") + 1).alias("distance"))
        beyond = first.join(beyond, [*keys, "_at"]).select(*keys, "node", F.col("_far").alias("_at"), "distance")
        reach = direct.unionByName(beyond).groupBy(*keys, "node", "_at").agg(F.min("distance").alias("distance"))
    return reach.withColumnRenamed("_at", name)


def _walk(steps: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, _at, distance) by breadth-first rounds; all rounds are one table, of which each reads the last one.

    The edges are shuffled once, into buckets by the node that they start at, so a round shuffles only what it goes on from.
    """
    spark = steps.sparkSession
    path = scratch_path(spark, "reach")
    steps = cut_in_buckets(steps, [*keys, "_at"], "steps")
    frontier = nodes.select(*keys, "node", F.col("node").alias("_at"))
    kind = T.StructType([*frontier.schema, T.StructField("distance", T.IntegerType())])
    distance, seen = 0, None
    while True:
        distance += 1
        reached = frontier.join(steps, [*keys, "_at"]).select(*keys, "node", F.col("_next").alias("_at"))
        if seen is not None and reached.isEmpty():  # before all that was reached is shuffled to be compared
            return seen
        reached = reached.distinct()
        if seen is not None:
            reached = reached.join(seen.select(*keys, "node", "_at"), [*keys, "node", "_at"], "left_anti")
        reached.write.option("compression", "zstd").parquet(f"{path}/distance={distance}")
        seen = spark.read.schema(kind).parquet(path)
        frontier = seen.filter(F.col("distance") == distance).drop("distance")
        if frontier.isEmpty():
            return seen


def ancestors(edges: DataFrame, start: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(node, ancestor, distance) for each start node and everything it was derived from.

    Distance is the least number of edges. The result is as large as the closure asked for, so start
    from the nodes of interest, not from all.
    """
    return _reach(edges, start, "child", "parent", "ancestor", keys or [])


def descendants(edges: DataFrame, start: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(node, descendant, distance) for each start node and everything derived from it."""
    return _reach(edges, start, "parent", "child", "descendant", keys or [])


def levels(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Execution level per node: 1 for a root, else one more than the highest level among its parents.

    Only edges to nodes that are parents themselves can hold a level back, so the rounds run over these alone. Round d keeps
    the ones whose parents have a level of at least d: their parents are children in the round before. A node's level is
    one more than the number of rounds that have it as a child; all rounds are one table. Edges that come twice change no level
    and are not made distinct. The edges become fewer in each round, or there is a cycle among them, which is an error. All other nodes get their levels by one join at the end. A
    chain takes a round for each edge.
    """
    keys = keys or []
    spark = edges.sparkSession
    path = scratch_path(spark, "levels")
    links = cut(edges.select(*keys, "parent", "child"), "edges")
    inner = links.join(links.select(*keys, F.col("parent").alias("child")).distinct(), [*keys, "child"], "left_semi")
    kind = T.StructType([*links.schema, T.StructField("round", T.IntegerType())])
    at, left = 1, None
    while left is None or left > 0:
        inner.select(*keys, "parent", "child").write.option("compression", "zstd").parquet(f"{path}/round={at}")
        rounds = spark.read.schema(kind).parquet(path)
        last = rounds.filter(F.col("round") == at).drop("round")
        before, left = left, last.count()
        if left and left == before:
            raise ValueError("the graph has a cycle")
        at += 1
        fed = last.select(*keys, F.col("child").alias("parent")).distinct()
        inner = last.join(fed, [*keys, "parent"], "left_semi")
    held = rounds.groupBy(*keys, F.col("child").alias("parent")).agg((F.max("round") + 1).alias("level"))
    level = F.coalesce("level", F.lit(1))
    ends = F.array(F.struct(F.col("parent").alias("node"), level.alias("level")), F.struct(F.col("child").alias("node"), (level + 1).alias("level")))
    return links.join(held, [*keys, "parent"], "left").select(*keys, F.inline(ends)).groupBy(*keys, "node").agg(F.max("level").alias("level"))


def levels_in_groups(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``levels`` where the edges of one key fit into one row, as those of one document do.

    The edges of a key come together once and stay there: edges that are partitioned by the keys are not shuffled at all, and no
    round is stored. A task takes the rounds of all keys of a batch in step. A cycle is an error. A null end is a node like others.
    """
    node = edges.schema["parent"]
    kind = T.StructType([*[edges.schema[k] for k in keys], T.StructField("node", node.dataType), T.StructField("level", T.IntegerType())])
    together = edges.groupBy(*keys).agg(F.collect_list(F.struct("parent", "child")).alias("_edges"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, name, level = _batch_levels(batch.column("_edges"))
            found = [*[batch.column(k).take(owner) for k in keys], name, level]
            yield pa.RecordBatch.from_arrays(found, [*keys, "node", "level"])

    return together.mapInArrow(find, kind)


def _batch_levels(edges: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(row, node, level) of each node in the lists of edges; a node is one of its row alone."""
    ends = pc.list_flatten(edges)
    names = pa.concat_arrays([pc.struct_field(ends, [i]) for i in (0, 1)]).dictionary_encode(null_encoding="encode")
    row = np.tile(pc.list_parent_indices(edges).to_numpy(zero_copy_only=False).astype(np.int64), 2)
    nodes, at = np.unique(row * max(1, len(names.dictionary)) + names.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    parent, child = np.split(at, 2)
    level = np.ones(len(nodes), np.int32)
    depth = 1
    while len(parent):
        depth += 1
        level[child] = depth
        held = np.zeros(len(nodes), bool)
        held[child] = True
        stay = held[parent]
        if stay.all():
            raise ValueError("the graph has a cycle")
        parent, child = parent[stay], child[stay]
    row, name = np.divmod(nodes, max(1, len(names.dictionary)))
    return pa.array(row), names.dictionary.take(pa.array(name)), pa.array(level)


def components(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, node, component): the least node that each node is connected to, direction ignored.

    Rounds of large-star and small-star steps shrink the edges to stars. Their number grows with the
    logarithm of the longest path, and a round moves each edge a constant number of times. Number nodes
    by integers where possible: their minimum is hash-aggregated.
    """
    keys = keys or []
    current = cut(
        edges.select(*keys, F.greatest("parent", "child").alias("u"), F.least("parent", "child").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct(),
        "components",
    )
    while not _are_stars(current, keys):
        twice = current
        for _ in range(2):
            twice = _small_star(_large_star(twice, keys), keys)
        current = cut(twice, "components")
    centres = current.select(*keys, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(*keys, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _are_stars(edges: DataFrame, keys: list[str]) -> bool:
    """Whether each node either is a centre or hangs on exactly one."""
    roles = F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("leaf")), F.struct(F.col("v").alias("node"), F.lit(0).alias("leaf"))
    )
    mixed = (
        edges.select(*keys, F.inline(roles))
        .groupBy(*keys, "node")
        .agg(F.sum("leaf").alias("n"), F.min("leaf").alias("least"))
        .filter((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("least") == 0)))
    )
    return mixed.isEmpty()


def _large_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Link the larger neighbours of each node to the least node around it."""
    ends = F.array(
        F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b"))
    )
    around = edges.select(*keys, F.inline(ends))
    least = around.groupBy(*keys, "a").agg(F.min("b").alias("m")).select(*keys, "a", F.least("a", "m").alias("m"))
    return (
        around.filter(F.col("b") > F.col("a"))
        .join(least, [*keys, "a"])
        .select(*keys, F.col("b").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = edges.groupBy(*keys, "u").agg(F.min("v").alias("m"))
    links = F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
    )
    return (
        edges.join(least, [*keys, "u"])
        .select(*keys, F.inline(links))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
