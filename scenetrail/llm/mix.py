"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue in a shuffled order that a hash fixes. A document's virtual finish time is the sum of
the words of its source up to and with it, divided by the source's target; a second pass over a source queues behind
its first. Served in the order of finish times, every source is at the same share of its target at any moment, so
the queue is cut where the total budget is reached.

The order is by hash, so slices of the hash range are even, and a queue is summed from the sums of its slices. The
cut is found from the sums of even slices of virtual time and the documents of the one slice in which it lies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scenetrail.llm.common import boxed, query, table, unboxed
from scenetrail.session import cut

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
SHARE = 1.5  # budget by all words
REPEATS = 2  # passes over a source at most
_WORD = r"[^\x20\x09-\x0D]+"
_HEX = 8  # digits of the hash that place a document in a slice


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    The budget is shared by weight; a target stops at ``repeats`` times its source, and the excess is shared again.
    So target = min(weight x level, repeats x size) for one level. Sources are sorted by the level at which they
    stop; the level is the first that stays below the next source's. Code point order gives the weights, null last.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("most", F.lit(float(repeats)) * F.col("source_size"))
    by_stop = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_stop.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    rows = ranked.withColumns(
        {
            "budget": F.lit(float(share)) * F.sum("source_size").over(everything),
            "stopped": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    level = (F.col("budget") - F.col("stopped")) / F.col("open")
    fits = level <= F.col("most") / F.col("weight")
    rows = rows.withColumn("level", F.min_by(F.when(fits, level), F.when(fits, F.col("stopped"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least(F.col("weight") * F.col("level"), F.col("most")))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = "mix",
    slice_rows: int = 4_000,
) -> DataFrame:
    """doc_id, source, mark (md5 of the text), size, source_size, target, taken: one row for each row of ``docs``.

    ``taken`` is the size times the passes in which the cut includes the document (0 to ``repeats``). The order of a
    source is by md5 of seed, id and text; rows equal in both are told apart by number only and can stand for each
    other. Null and empty texts have size 0 and are never taken; a null source is a source; a null id is an id. An
    empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    mark = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    line = docs.select("doc_id", "source", mark.alias("mark"), words(F.col("text")).alias("size"))
    place = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "mark").cast("binary"))
    line = cut(line.withColumn("place", place), "mix")

    n = max(1, -(-line.count() // slice_rows))
    line = line.withColumn("slice", F.floor(F.conv(F.substring("place", 1, _HEX), 16, 10).cast("double") / 16.0**_HEX * n).cast("int"))
    parts = line.groupBy("source", "slice").agg(F.sum("size").alias("part"))
    sums = parts.groupBy("source").agg(F.sum("part").cast("bigint").alias("source_size"))
    goals = targets(sums, weights, share, repeats)
    earlier = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("source", "slice", F.coalesce(F.sum("part").over(earlier), F.lit(0)).alias("start"))
    starts = cut(_join(starts, goals, ["source"]), "starts")  # one row for a source and slice

    queue = _join(line, starts, ["source", "slice"])
    inside = W.partitionBy("source", "slice").orderBy("place", "size", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    queue = queue.withColumn("done", F.col("start") + F.sum("size").over(inside))
    queue = cut(queue.select("doc_id", "source", "mark", "place", "size", "source_size", "target", "done"), "queue")

    entry = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    entries = queue.filter((F.col("size") > 0) & (F.col("target") > 0)).select("source", "place", "size", "source_size", "target", "done", entry.alias("pass"))
    entries = entries.withColumn("finish", _finish(F.col("pass")))
    last = _cut_point(entries, n, slice_rows)
    if last is None:
        taken = F.lit(0).cast("bigint")
    else:
        served = [F.when(_rank(F.lit(p)) <= _literal(last), 1).otherwise(0) for p in range(repeats)]
        taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * sum(served[1:], served[0])).otherwise(0).cast("bigint")
    return queue.select("doc_id", "source", "mark", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken (words, repeats counted).

    Rows with equal id, source and text become one, with the words taken of all of them. Columns of ``docs`` with the
    names of the results are replaced. ``how`` goes to ``mix``.
    """
    keys = ["doc_id", "source", "mark"]
    chosen = mix(docs, **how).filter(F.col("taken") > 0).groupBy(*keys)
    chosen = chosen.agg(*[F.first(c).alias(c) for c in ("size", "source_size", "target")], F.sum("taken").alias("taken"))
    mark = F.md5(F.coalesce(F.col("_row.text"), F.lit("")).cast("binary"))
    rows = boxed(docs).select("_row", F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), mark.alias("mark"))
    joined = _join(rows, chosen, keys).dropDuplicates(keys)
    return unboxed(joined, docs.columns, **{c: F.col(c) for c in ("size", "source_size", "target", "taken")})


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which a null key equals a null key."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(renamed, condition).drop(*[f"_{k}" for k in keys])


def _finish(turn: Column) -> Column:
    return (turn * F.col("source_size") + F.col("done")) / F.col("target")


def _rank(turn: Column) -> Column:
    """The order of service; ties go by source, null last, then by pass and place."""
    return F.struct(
        _finish(turn).alias("finish"), F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
        turn.cast("int").alias("pass"), F.col("place").alias("place"),
    )


def _literal(last) -> Column:
    return F.struct(
        F.lit(last["finish"]).alias("finish"), F.lit(last["no_source"]).alias("no_source"), F.lit(last["source"]).alias("source"),
        F.lit(last["pass"]).alias("pass"), F.lit(last["place"]).alias("place"),
    )


def _cut_point(entries: DataFrame, n: int, slice_rows: int):
    """The last entry that the budget (the sum of all targets) covers, or null.

    Entries are counted in even slices of time; the slice in which the budget runs out is sliced again until it holds
    at most ``slice_rows`` entries, or entries of one time only.
    """
    budget = entries.groupBy("source").agg(F.first("target").alias("target")).agg(F.round(F.sum("target"), 3)).first()[0]
    if budget is None:
        return None
    low, high, before, found = 0.0, float(entries.agg(F.max("finish")).first()[0]), 0, entries
    slices = max(16, math.isqrt(n * 16))
    while True:
        width = (high - low) / slices
        if width <= 0 or low + width == low:
            break
        at = F.least(F.floor((F.col("finish") - low) / width), F.lit(slices - 1)).cast("int")
        counted = found.groupBy(at.alias("at")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("at").collect()
        crossing = None
        for row in counted:  # at most `slices` rows
            if before + row["size"] > budget:
                crossing = row
                break
            before += row["size"]
        if crossing is None:
            return entries.agg(F.max(_rank(F.col("pass"))).alias("r")).first()["r"]
        found = found.filter(at == crossing["at"])
        low, high = low + crossing["at"] * width, low + (crossing["at"] + 1) * width
        if crossing["n"] <= slice_rows:
            break
        found = cut(found, "crossing")
    rank = _rank(F.col("pass"))
    running = F.sum("size").over(W.orderBy("r").rowsBetween(W.unboundedPreceding, 0))
    fits = found.select(rank.alias("r"), "size").withColumn("sum", running).filter(F.col("sum") <= budget - before)
    last = fits.agg(F.max("r").alias("r")).first()["r"]
    if last is not None:
        return last
    return entries.filter(F.col("finish") < low).agg(F.max(rank).alias("r")).first()["r"]


@query(
    "op1_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, md5(coalesce(text, '')) AS mark,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM documents
    ),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (
      SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
             2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget
      FROM s
    ),
    l AS (
      SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w
    ),
    g AS (
      SELECT source, source_size, least(weight * (SELECT arg_min(level, most / weight) FROM l WHERE level <= most / weight), most) AS target
      FROM l
    ),
    q AS (
      SELECT d.*, source_size, target, md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), '-'), mark)) AS place
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
    ),
    r AS (
      SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, size, doc_id ROWS UNBOUNDED PRECEDING) AS done FROM q
    ),
    e AS (
      SELECT doc_id, source, place, size, pass, (pass * source_size + done)::DOUBLE / target AS finish
      FROM r, (VALUES (0), (1)) p(pass) WHERE size > 0
    ),
    c AS (
      SELECT doc_id, place, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, pass, place ROWS UNBOUNDED PRECEDING) AS total FROM e
    ),
    t AS (SELECT doc_id, place, CAST(sum(size) AS BIGINT) AS taken FROM c WHERE total <= (SELECT round(sum(target), 3) FROM g) GROUP BY doc_id, place)
    SELECT r.doc_id, r.size, source_size, target, coalesce(taken, 0) AS taken
    FROM r LEFT JOIN t ON r.doc_id IS NOT DISTINCT FROM t.doc_id AND r.place = t.place
    """,
)
def op1_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
