"""Near-duplicate documents by DartMinHash.

The elements of a text are its runs of five words. Each element throws darts, a hashed Poisson process in time over its
weight; a dart hits one coordinate, and every coordinate keeps its earliest dart. Elements stop at the time by which all
coordinates are expected to be hit, so a signature costs about one step an element. Two texts agree in a coordinate with
their (weighted) Jaccard similarity. Coordinates make bands, and texts that agree in a whole band share a bucket.

Equal texts are one node. Every link is confirmed on the full sets of elements, and classes are the connected nodes.
Pairs of a bucket are not all formed: nodes are first compared with one node of their bucket, then twice with another
one, and what a class already joins is not compared again; at the end, the nodes of buckets that still hold several
classes are joined on their rarest elements, so a large bucket of unlike texts is not expanded into pairs. Sizes and
parity bits of the sets rule out most pairs that are not similar, before any set is fetched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import arrow_function, boxed, key_filter, may_have, query, table, unboxed
from scenetrail.llm.words import binary_keys, list_column, mixed, pieces, shingles, text_bytes, text_keys, words_of
from scenetrail.operators.graph import components
from scenetrail.session import cut

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4  # at a similarity of 0.8, two texts share no band in 3 of 100,000 cases

STAR_TURNS = 2  # rounds of comparing one node of each class in a bucket, before all that is left is compared

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(element: np.ndarray, owner: np.ndarray, n: int, k: int, weight: np.ndarray | None = None) -> np.ndarray:
    """(n x k) earliest dart of every coordinate for each owner; owners without weight get zeros.

    Without ``weight``, elements count once however often they occur; with it, equal elements of an owner must be
    given once. A weight is cut into cells of one, and in the last, broken cell a dart counts if it falls inside.
    """
    if weight is not None:
        cells = np.ceil(weight).astype(np.int64)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        room = np.repeat(weight, cells) - cell
        owner = np.repeat(owner, cells)
        element = mixed(np.repeat(element, cells) + cell.astype(np.uint64) * _STEP)
    else:
        room = None
    best = np.zeros((n, k), np.uint64)
    hit = np.zeros((n, k), bool)
    total = np.bincount(owner, weights=None if room is None else np.minimum(room, 1), minlength=n)
    until = k * (np.log(k) + 2) / np.maximum(total, 1e-9)
    todo = total > 0
    while todo.any():
        mine = np.flatnonzero(todo[owner])
        seed, who, limit = mixed(element[mine] ^ np.uint64(0x5851F42D4C957F2D)), owner[mine], until[owner[mine]]
        clock, active, drawn, size, found = np.zeros(len(mine)), np.arange(len(mine)), 0, 1, []
        while len(active):
            h = mixed(seed[active][:, None] + np.arange(drawn + 1, drawn + size + 1, dtype=np.uint64) * _STEP)
            times = clock[active][:, None] + np.cumsum(-np.log(_unit(h)), axis=1)
            early = times <= limit[active][:, None]
            row, col = np.nonzero(early)
            at, dart = active[row], h[row, col]
            if room is not None:
                inside = _unit(mixed(dart ^ np.uint64(0x2545F4914F6CDD1D))) < room[mine[at]]
                row, col, at, dart = row[inside], col[inside], at[inside], dart[inside]
            found.append((who[at] * k + (mixed(dart ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(k)).astype(np.int64), times[row, col], dart))
            clock[active] = times[:, -1]
            active = active[early[:, -1]]
            drawn, size = drawn + size, size * 2
        place, time, dart = (np.concatenate(x) for x in zip(*found))
        late_first = np.argsort(-time, kind="stable")
        best.reshape(-1)[place[late_first]] = dart[late_first]  # of several, the last put is the earliest
        hit.reshape(-1)[place] = True
        todo &= ~hit.all(axis=1)
        until[todo] *= 4
    return best


def _elements(part: np.ndarray, borders: np.ndarray, size: int):
    """Distinct shingles of each text: words, hash, text, borders by text, count in the text."""
    words = words_of(part, borders)
    gram, doc, _ = shingles(words, size)
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(gram)))
    gram, doc = gram[at], doc[at]
    return words, gram, doc, np.searchsorted(doc, np.arange(len(borders))), times


PARITY_WORDS = 4
WIDE_WORDS = 16  # of the nodes that the last join compares


def parity(gram: np.ndarray, first: np.ndarray, width: int = PARITY_WORDS) -> np.ndarray:
    """(texts x width) 64-bit words in which each element of a text flips one bit.

    Two texts differ in no fewer elements than in bits, so few differing bits are needed for a high similarity.
    """
    out = np.zeros((len(first) - 1, width), np.uint64)
    some = np.flatnonzero(np.diff(first))
    h = mixed(gram ^ np.uint64(0x8E9D5A3C17F0B264))
    bit = np.uint64(1) << (h >> np.uint64(58))
    for w in range(width if len(some) else 0):
        mine = np.where((h & np.uint64(width - 1)) == w, bit, np.uint64(0))
        out[some, w] = np.bitwise_xor.reduceat(mine, first[:-1][some])
    return out


def _need(n: Column, m: Column, similarity: float) -> Column:
    """Elements that two sets of these sizes have in common at least."""
    return F.ceil((n + m) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))


def _near(a: str, b: str, similarity: float, width: int = PARITY_WORDS) -> Column:
    """Whether sizes and parity of the columns n_a, bits_a and n_b, bits_b allow the similarity; never wrongly no."""
    n, m = F.col(f"n_{a}"), F.col(f"n_{b}")
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"bits_{a}")[w].bitwiseXOR(F.col(f"bits_{b}")[w])) for w in range(width)])
    return (F.least(n, m) >= similarity * F.greatest(n, m) - F.lit(1e-9)) & (differ <= n + m - 2 * _need(n, m, similarity))


def signatures(text: Column | str, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> Column:
    """key (16 bytes of the words), low (64 bits of it), n (elements), bits (parity) and bands; n is 0 without words.

    With ``weighted`` an element weighs as often as it occurs, else 1.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seeds = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            raw, ends = text_bytes(batch)
            keys, counts, values, bits = [], [], [], [np.zeros((0, PARITY_WORDS), np.uint64)]
            for _, _, part, borders in pieces(raw, ends):
                words, gram, doc, first, times = _elements(part, borders, size)
                n = len(borders) - 1
                marks = dart_signatures(gram, doc, n, bands * rows, times.astype(float) if weighted else None).reshape(n, bands, rows)
                band = np.tile(seeds, (n, 1))
                for r in range(rows):
                    band = mixed(band * _STEP + marks[:, :, r])
                keys.append(np.stack(text_keys(words), axis=1))
                counts.append(np.diff(first))
                bits.append(parity(gram, first))
                values.append(band.view(np.int64))
            key = np.concatenate(keys) if keys else np.zeros((0, 2), np.uint64)
            count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            band = np.concatenate(values) if values else np.zeros((0, bands), np.int64)
            yield pa.StructArray.from_arrays(
                [
                    binary_keys([key[:, 0], key[:, 1]]),
                    pa.array(key[:, 0].view(np.int64)),
                    pa.array(count, pa.int32()),
                    list_column(np.concatenate(bits).view(np.int64).reshape(-1), np.full(len(band), PARITY_WORDS), pa.int64()),
                    list_column(band.reshape(-1), np.full(len(band), bands), pa.int64()),
                ],
                ["key", "low", "n", "bits", "bands"],
            )

    return arrow_function(run, "struct<key:binary,low:bigint,n:int,bits:array<bigint>,bands:array<bigint>>")(text)


def _element_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(key, elements) of the given nodes. The texts are read again, so that no other sets are ever stored."""
    bits = key_filter(nodes, "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple] = set()  # by this task: copies need not be given again
        for batch in batches:
            raw, ends = text_bytes(batch.column(0))
            for _, _, part, borders in pieces(raw, ends):
                words, gram, _, first, _ = _elements(part, borders, size)
                low, high = text_keys(words)
                wanted = may_have(bits, low.view(np.int64)) & (np.diff(words.first) > 0)
                keys, sets = [], []
                for k in np.flatnonzero(wanted).tolist():
                    key = (int(low[k]), int(high[k]))
                    if key not in given:
                        given.add(key)
                        keys.append(key[0].to_bytes(8, "big") + key[1].to_bytes(8, "big"))
                        sets.append(gram[first[k] : first[k + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["key", "elements"])

    sets = docs.select("text").mapInArrow(run, "key binary, elements array<bigint>")
    sets = sets.join(nodes.select("key"), "key", "left_semi")
    return cut(sets.groupBy("key").agg(F.first("elements").alias("elements")), "elements")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    left = sets.select(F.col("key").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").filter(common / (F.size("x") + F.size("y") - common) >= similarity).select("a", "b")


def _classes(links: DataFrame) -> DataFrame:
    """(key, comp) of all linked nodes."""
    found = components(links.select(F.col("a").alias("parent"), F.col("b").alias("child")))
    return found.select(F.col("node").alias("key"), F.col("component").alias("comp"))


def _open_posts(posts: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, key, n, bits, comp) of the buckets that hold more than one class."""
    placed = posts.join(classes, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    several = placed.groupBy("band").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least != most")
    return cut(placed.join(several.select("band"), "band"), "open")


def _star_pairs(posts: DataFrame, turn: int, similarity: float) -> DataFrame:
    """In each bucket, one node of every class with one node of the class that has most."""
    choice = F.xxhash64("key", "band", F.lit(turn))
    parts = posts.groupBy("band", "comp").agg(F.count("*").alias("n"), F.min_by(F.struct("key", "n", "bits"), choice).alias("one"))
    centre = parts.groupBy("band").agg(F.max(F.struct("n", "comp", "one")).alias("c"))
    sides = parts.join(centre, "band").filter(F.col("comp") != F.col("c.comp")).select(
        F.col("one.key").alias("a"), F.col("one.n").alias("n_a"), F.col("one.bits").alias("bits_a"),
        F.col("c.one.key").alias("b"), F.col("c.one.n").alias("n_b"), F.col("c.one.bits").alias("bits_b"),
    )
    return sides.filter(_near("a", "b", similarity)).select("a", "b").distinct()


def _wide_parity(elements: Column) -> Column:
    def run(column: pa.Array) -> pa.Array:
        first = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        bits = parity(column.flatten().to_numpy().view(np.uint64), first, WIDE_WORDS)
        return list_column(bits.view(np.int64).reshape(-1), np.full(len(bits), WIDE_WORDS), pa.int64())

    return F.arrow_udf(run, "array<bigint>").asNondeterministic()(elements)


def _rest_pairs(posts: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes in different classes that may be similar, by a prefix join on the elements of what is left.

    Elements are ordered by how many of these nodes hold them. Similar nodes share one of their rarest n - ceil(tn) + 1
    elements, so nodes of a large bucket that have only their common text in common do not meet. Sizes, the place of
    the common element and wide parity bits leave few pairs besides similar ones.
    """
    left = posts.groupBy("key").agg(F.first("comp").alias("comp")).join(sets, "key")
    left = cut(left.select("key", "comp", "elements", F.size("elements").alias("n"), _wide_parity(F.col("elements")).alias("bits")), "left")
    each = left.select("key", F.explode("elements").alias("element"))
    shared = each.groupBy("element").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    ranked = each.join(shared, "element").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("nodes", "element"))).alias("ranked"))
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)) + 1
    # Elements of one node only come first in its order; they are counted and not posted.
    posted = (
        left.select("key", "comp", "n", "bits").join(ranked, "key")
        .withColumn("alone", F.col("n") - F.size("ranked"))
        .withColumn("prefix", F.slice("ranked.element", F.lit(1), F.greatest(length - F.col("alone"), F.lit(0)).cast("int")))
        .select("key", "comp", "n", "bits", "alone", F.posexplode("prefix").alias("at", "element"))
        .withColumn("place", F.col("alone") + F.col("at"))
    )
    posted = cut(posted.drop("alone", "at"), "prefixes")

    def side(name: str) -> DataFrame:
        return posted.select("element", *[F.col(c).alias(f"{c}_{name}") for c in ("key", "comp", "n", "bits", "place")])

    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= _need(F.col("n_a"), F.col("n_b"), similarity)
    on = (F.col("x.element") == F.col("y.element")) & (F.col("comp_a") != F.col("comp_b")) & (F.col("key_a") < F.col("key_b")) & room
    pairs = side("a").alias("x").join(side("b").alias("y"), on & _near("a", "b", similarity, WIDE_WORDS))
    return pairs.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, key, class_id, class_key, class_size for every row of ``docs``.

    Two documents are linked if their sets of ``size``-word shingles (of all words, for a shorter text) have a Jaccard
    similarity of at least ``similarity``; classes are connected documents. ``class_id`` is the least doc_id of the
    class (null only if all are), ``class_key`` names the class, and ``class_size`` counts its rows, repeated ones
    included. A null text, an empty one and one without words are in no class but their own. Words are those of
    ``words``, so case and punctuation do not matter. Other columns of ``docs`` are ignored.
    """
    docs = docs.select("doc_id", "text")
    signed = docs.select("doc_id", signatures("text", size, bands, rows).alias("s"))
    signed = cut(signed.select("doc_id", "s.*"), "signed")
    nodes = signed.filter("n > 0").groupBy("key", "low", "n").agg(F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    nodes = cut(nodes, "nodes")
    bands_of = nodes.select("key", F.explode("bands").alias("band"))
    shared = bands_of.groupBy("band").agg(F.min("key").alias("centre"), F.max("key").alias("most")).filter("centre != most")
    posts = cut(bands_of.join(shared.select("band", "centre"), "band"), "posts")

    active = cut(posts.groupBy("key").agg(F.min("centre").alias("centre")).join(nodes.select("key", "low", "n", "bits"), "key"), "active")
    posts = cut(posts.select("band", "key").join(active.select("key", "n", "bits"), "key"), "posts")
    sets = _element_sets(docs, active, size)
    own_side = active.filter("key != centre").select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"), F.col("centre").alias("b"))
    centres = active.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    first = own_side.join(centres, "b").filter(_near("a", "b", similarity)).select("a", "b")
    links = cut(_confirmed(first, sets, similarity), "links")
    classes = _classes(links)
    for turn in range(STAR_TURNS):
        new = cut(_confirmed(_star_pairs(_open_posts(posts, classes), turn, similarity), sets, similarity), "links")
        links = links.unionByName(new)
        classes = cut(_classes(links), "classes")
    new = cut(_confirmed(_rest_pairs(_open_posts(posts, classes), sets, similarity), sets, similarity), "links")
    if not new.isEmpty():
        classes = _classes(links.unionByName(new))

    own = F.when(F.col("n") > 0, F.coalesce("comp", "key"))
    placed = signed.select("doc_id", "key", "n").join(classes, "key", "left").select("doc_id", "key", own.alias("class_key"))
    grouped = placed.filter(F.col("class_key").isNotNull())
    told = grouped.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    alone = placed.filter(F.col("class_key").isNull())
    return (
        grouped.join(told, "class_key")
        .select("doc_id", "key", "class_id", "class_key", "class_size")
        .unionByName(alone.select("doc_id", "key", F.col("doc_id").alias("class_id"), "class_key", F.lit(1).cast("bigint").alias("class_size")))
    )


def deduplicate(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: the one with the least doc_id, null last, then the least key.

    Documents without words all stay; of rows with equal id and words one stays. Columns are those of ``docs``.
    """
    found = near_duplicates(docs, size, similarity).filter(F.col("class_key").isNotNull())
    best = found.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("_best_id"), F.col("best.key").alias("_best_key"))
    rows = boxed(docs).withColumn("_s", signatures_key(F.col("_row.text")))
    some = rows.filter("_s.n > 0")
    kept = some.join(best, (F.col("_s.key") == F.col("_best_key")) & F.col("_row.doc_id").eqNullSafe(F.col("_best_id")), "left_semi")
    kept = kept.withColumn("_id", F.col("_row.doc_id")).withColumn("_key", F.col("_s.key")).dropDuplicates(["_id", "_key"])
    return unboxed(kept.select("_row").unionByName(rows.filter("_s.n = 0").select("_row")), docs.columns)


def signatures_key(text: Column) -> Column:
    """key and n (words) of a text, as in ``signatures``."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw, ends = text_bytes(batch)
            keys, counts = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
            for _, _, part, borders in pieces(raw, ends):
                words = words_of(part, borders)
                keys.append(np.stack(text_keys(words), axis=1))
                counts.append(np.diff(words.first))
            key = np.concatenate(keys)
            yield pa.StructArray.from_arrays([binary_keys([key[:, 0], key[:, 1]]), pa.array(np.concatenate(counts), pa.int32())], ["key", "n"])

    return arrow_function(run, "struct<key:binary,n:int>")(text)


@query("op4_near_dedup")
def op4_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
