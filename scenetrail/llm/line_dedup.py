"""Line deduplication by an exact set-similarity join.

A line's set holds its words. Tokens are ordered by rarity, which is the least of two hashed counters of fixed size
over all words of the corpus. Two sets with a Jaccard similarity of at least t share a token in their prefixes: of the
smaller set the first n - ceil(2tn / (1 + t)) + 1 tokens, of the larger the first n - ceil(tn) + 1. Prefix tokens are
joined; the sizes, the positions of the common token and the parity bits of both sets rule out most pairs, and the
rest are verified on the whole sets. A line goes if an earlier line (by doc_id, then line number) is similar.

Equal sets are one set. Before the join, each set is paired with the first set of the same least hash, if the filters
allow; the join leaves out pairs of two such members, so that a group of many similar lines is not expanded into all
pairs. Members that prove not to be similar to an earlier set are joined with the other members afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenetrail.llm.common import boxed, key_filter, may_have, query, small_batches, table, unboxed
from scenetrail.llm.words import list_column, mixed, pieces, text_bytes, words_of
from scenetrail.session import cut

SIMILARITY = 0.8
COUNTERS = 1 << 16  # in each of two rows
_TOKEN = np.uint64((1 << 50) - 1)  # a token is 50 bits of its hash; the other 14 number the lines of a block
_LINES = 1 << 14
_LOW = np.uint64(0xFFFFFFFF)


def _slots(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (token >> np.uint64(34)).astype(np.int64), (token & np.uint64(COUNTERS - 1)).astype(np.int64)


def token_rarity(docs: DataFrame) -> np.ndarray:
    """Two rows of counters over all words of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, COUNTERS), np.int64)
        for batch in batches:
            raw, ends = text_bytes(batch.column(0))
            for _, _, part, borders in pieces(raw, ends):
                for row, slot in zip(counts, _slots(words_of(part, borders).hash >> np.uint64(14))):
                    row += np.bincount(slot, minlength=COUNTERS)
        flat = counts.reshape(-1)
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(flat[used])], ["slot", "n"])

    counted = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(2 * COUNTERS, np.int64)
    for row in counted.collect():  # at most 2 * COUNTERS rows
        out[row["slot"]] = row["n"]
    return out.reshape(2, COUNTERS)


def _ceil(x: np.ndarray) -> np.ndarray:
    return np.ceil(x - 1e-9).astype(np.int64)


class LineSets:
    """The lines with words of a piece of texts, and the distinct tokens of each."""

    def __init__(self, part: np.ndarray, borders: np.ndarray):
        words = words_of(part, borders)
        breaks = np.flatnonzero(part == 10)
        above = np.searchsorted(breaks, borders)  # line ends before each text
        self.n_lines = np.diff(above) + 1
        line = np.searchsorted(breaks, words.start) + words.doc  # a text adds a line without a line end
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        place = np.cumsum(new) - 1  # of each word: its line among the lines with words
        first = np.flatnonzero(new)
        self.doc = words.doc[first]
        self.line = line[first] - self.doc - above[self.doc] + 1
        tokens, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for at in range(0, len(first), _LINES):
            a, b = first[at], first[at + _LINES] if at + _LINES < len(first) else len(line)
            both = np.sort(((place[a:b] - at).astype(np.uint64) << np.uint64(50)) | (words.hash[a:b] >> np.uint64(14)))
            keep = np.ones(len(both), bool)
            keep[1:] = both[1:] != both[:-1]
            both = both[keep]
            tokens.append(both & _TOKEN)
            owners.append((both >> np.uint64(50)).astype(np.int64) + at)
        self.token, self.owner = np.concatenate(tokens), np.concatenate(owners)
        self.first = np.searchsorted(self.owner, np.arange(len(first) + 1))
        self.size = np.diff(self.first)

    def only(self, keep: np.ndarray) -> LineSets:
        """Some of the sets, without their places in the texts."""
        out = object.__new__(LineSets)
        out.token, out.size = self.token[np.repeat(keep, self.size)], self.size[keep]
        out.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(out.size)])
        out.owner = np.repeat(np.arange(len(out.size)), out.size)
        return out

    def sums(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each set."""
        if not len(self.token):
            return np.zeros(0, np.uint64)
        return mixed(np.add.reduceat(mixed(self.token ^ np.uint64(seed)), self.first[:-1]) + self.size.astype(np.uint64))

    def least(self, seed: int) -> np.ndarray:
        if not len(self.token):
            return np.zeros(0, np.uint64)
        return np.minimum.reduceat(mixed(self.token ^ np.uint64(seed)), self.first[:-1])

    def parity(self, words: int) -> np.ndarray:
        """(sets x words) 64 bits each, of which a token flips one: two sets differ in no fewer tokens than bits."""
        out = np.zeros((len(self.size), words), np.uint64)
        h = mixed(self.token ^ np.uint64(0x7F4A7C159E3779B9))
        bit = np.uint64(1) << (h >> np.uint64(58))
        for w in range(words if len(h) else 0):
            out[:, w] = np.bitwise_xor.reduceat(np.where((h & np.uint64(words - 1)) == w, bit, np.uint64(0)), self.first[:-1])
        return out

    def prefixes(self, rank: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """The rarest tokens of each line (32 bits of each), and their number."""
        one, two = _slots(self.token)
        rarity = np.minimum(rank[0][one], rank[1][two]).astype(np.uint64)
        length = self.size - _ceil(similarity * self.size) + 1
        out = []
        for at in range(0, len(self.size), _LINES):
            a, b = self.first[at], self.first[min(at + _LINES, len(self.size))]
            key = (self.owner[a:b] - at).astype(np.uint64) << np.uint64(50)
            out.append(np.sort(key | (rarity[a:b] << np.uint64(32)) | (self.token[a:b] & _LOW)) & _LOW)
        token = np.concatenate(out) if out else np.zeros(0, np.uint64)
        inside = np.arange(len(token)) - np.repeat(self.first[:-1], self.size) < np.repeat(length, self.size)
        return token[inside].astype(np.uint32).view(np.int32), length


_KEY_SEEDS = (0x1B873593CC9E2D51, 0x38495AB5E6546B64)
WIDE = 8  # words of the wider parity bits
HELD_SETS = 500_000  # whose places a task knows at once
SLICES = 2  # of the tokens in the prefix join
_STAR_SEEDS = (0x52DCE729A5A5A5A5, 0x38B34AE5C2B2AE3D)


def _lines(docs: DataFrame, counts: np.ndarray, similarity: float) -> DataFrame:
    """A row for each line with words, and a row with line 0 for each document, which has its number of lines as n.

    A line is ``sent`` if the task has not met its set at an earlier place. So a line that is not goes in any case, and has
    no keys, and a set that many lines have is sent about once by each task. The first line of a task with some set
    also has what the join needs of the set.
    """
    rank = np.floor(np.log2(np.maximum(counts, 1)) * 4096).astype(np.int64)  # less than 2 ** 18, in the order of counts
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("text_key", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("sent", T.BooleanType()),
            T.StructField("k1", T.LongType()),
            T.StructField("k2", T.LongType()),
            T.StructField("bits", T.LongType()),
            T.StructField("more", T.LongType()),
            T.StructField("stars", T.ArrayType(T.LongType())),
            T.StructField("prefix", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[tuple, tuple] = {}  # the earliest place of each set so far
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            id_list, key_list = ids.to_pylist(), keys.to_pylist()
            raw, ends = text_bytes(batch.column(2))
            for a, b, part, borders in pieces(raw, ends):
                sets = LineSets(part, borders)
                own_ids, own_keys = ids.slice(a, b - a), keys.slice(a, b - a)
                nothing = [pa.nulls(b - a, t) for t in (pa.bool_(), *[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [own_ids, own_keys, pa.array(np.zeros(b - a, np.int32)), pa.array(sets.n_lines.astype(np.int32)), *nothing], schema.names
                )
                if not len(sets.doc):
                    continue
                k1, k2 = (sets.sums(s).view(np.int64) for s in _KEY_SEEDS)
                fresh, sent = np.zeros(len(k1), bool), np.zeros(len(k1), bool)
                if len(given) > HELD_SETS:
                    given.clear()
                heads = [(i is None, i, k) for i, k in zip(id_list[a:b], key_list[a:b])]
                for i, (key, d, line) in enumerate(zip(zip(k1.tolist(), k2.tolist()), sets.doc.tolist(), sets.line.tolist())):
                    place = (heads[d], line)
                    before = given.get(key)
                    if before is None:
                        given[key] = place
                        fresh[i] = sent[i] = True
                    elif place <= before:  # the same place is a document given twice
                        given[key] = place
                        sent[i] = True
                new = sets.only(fresh)
                token, lengths = new.prefixes(rank, similarity)
                stars = np.stack([new.least(s) for s in _STAR_SEEDS], axis=1).view(np.int64)
                length, bits = np.zeros(len(fresh), np.int64), np.zeros((2, len(fresh)), np.int64)
                length[fresh], bits[:, fresh] = lengths, new.parity(2).T.view(np.int64)
                old = ~fresh
                doc = pa.array(sets.doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        own_ids.take(doc),
                        own_keys.take(doc),
                        pa.array(sets.line.astype(np.int32)),
                        pa.array(sets.size.astype(np.int32)),
                        pa.array(sent),
                        pa.array(k1, mask=~sent),
                        pa.array(k2, mask=~sent),
                        *(pa.array(word, mask=old) for word in bits),
                        list_column(stars.reshape(-1), np.where(fresh, 2, 0), pa.int64()),
                        list_column(token, length, pa.int32()),
                    ],
                    schema.names,
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def _token_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k1, k2, tokens, wide parity bits) of the sets whose k1 is wanted, and perhaps of others; the texts are read again."""
    bits = key_filter(wanted, "k1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple] = set()
        for batch in batches:
            raw, ends = text_bytes(batch.column(0))
            for _, _, part, borders in pieces(raw, ends):
                sets = LineSets(part, borders)
                k1 = sets.sums(_KEY_SEEDS[0]).view(np.int64)
                asked = may_have(bits, k1)
                k1, sets = k1[asked], sets.only(asked)
                k2 = sets.sums(_KEY_SEEDS[1]).view(np.int64)
                fresh = np.ones(len(k1), bool)
                for i, key in enumerate(zip(k1.tolist(), k2.tolist())):
                    fresh[i] = key not in given
                    given.add(key)
                sets = sets.only(fresh)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[fresh]),
                        pa.array(k2[fresh]),
                        list_column(sets.token.view(np.int64), sets.size, pa.int64()),
                        list_column(sets.parity(WIDE).view(np.int64).reshape(-1), np.full(len(sets.size), WIDE), pa.int64()),
                    ],
                    ["k1", "k2", "tokens", "wide"],
                )

    found = docs.select("text").mapInArrow(run, "k1 long, k2 long, tokens array<long>, wide array<long>")
    found = found.join(wanted, "k1", "left_semi")
    return found.groupBy("k1", "k2").agg(F.first("tokens").alias("tokens"), F.first("wide").alias("wide"))


def _later_of_similar(tokens: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """(k1, k2) of the sets that are similar to an earlier one, of pairs (a, b) of k1."""
    marks = tokens.select("k1", F.size("tokens").alias("n"), "wide")
    near = pairs.join(marks.toDF("a", "n", "u"), "a").join(marks.toDF("b", "m", "v"), "b")
    differ = reduce(Column.__add__, [F.bit_count(F.col("u")[w].bitwiseXOR(F.col("v")[w])) for w in range(WIDE)])
    n, m = F.col("n"), F.col("m")
    pairs = near.filter(differ <= n + m - 2 * _need(n, m, similarity)).select("a", "b")
    left = tokens.select(F.col("k1").alias("a"), F.struct("k1", "k2", "first", "tokens").alias("x"))
    right = tokens.select(F.col("k1").alias("b"), F.struct("k1", "k2", "first", "tokens").alias("y"))
    common = F.size(F.array_intersect("x.tokens", "y.tokens"))
    similar = pairs.join(left, "a").join(right, "b").filter(common / (F.size("x.tokens") + F.size("y.tokens") - common) >= similarity)
    later = F.when(F.col("x.first") < F.col("y.first"), F.struct("y.k1", "y.k2")).otherwise(F.struct("x.k1", "x.k2"))
    return similar.select(later.alias("l")).select("l.k1", "l.k2").distinct()


def _fits(n_a: Column, n_b: Column, a: str, b: str, need: Column) -> Column:
    """Whether the parity bits of the sides ``a`` and ``b`` leave room for ``need`` common tokens."""
    differ = [F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in ("bits", "more")]
    return differ[0] + differ[1] <= n_a + n_b - 2 * need


def _need(n_a: Column, n_b: Column, similarity: float) -> Column:
    return F.ceil((n_a + n_b) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int")


def _star_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): b may be similar to a, the set of its star that comes first by doc_id."""
    posts = sets.select("k1", "n", "bits", "more", F.col("first.doc_id").alias("id"), F.explode("stars").alias("star"))
    centre = posts.groupBy("star").agg(F.struct(*[F.min_by(c, "id").alias(c) for c in ("k1", "n", "bits", "more")]).alias("c"))
    n, m = F.col("n"), F.col("c.n")
    sizes = F.least(n, m) >= similarity * F.greatest(n, m) - F.lit(1e-9)
    return (
        posts.join(centre, "star")
        .filter((F.col("k1") != F.col("c.k1")) & sizes & _fits(n, m, "", "c.", _need(n, m, similarity)))
        .select(F.col("c.k1").alias("a"), F.col("k1").alias("b"))
        .distinct()
    )


def _prefix_pairs(sets: DataFrame, gone: DataFrame, similarity: float, slices: int = SLICES) -> DataFrame:
    """Pairs of sets that the filters leave, without those of two sets in ``gone`` (k1).

    Tokens are dealt to slices, and one slice is joined after another, so that only its postings are shuffled at a time.
    """
    flagged = sets.join(gone.withColumn("gone", F.lit(1)), "k1", "left")
    # Size and whether the set is gone in one number; the place of a token in the prefix joins them below.
    info = F.shiftleft(F.col("n").cast("bigint") * 2 + F.coalesce("gone", F.lit(0)), 31)
    flagged = cut(flagged.select("k1", "bits", "more", info.alias("info"), "prefix"), "flagged")
    found = [cut(_slice_pairs(flagged, similarity, k, slices), "pairs") for k in range(slices)]
    return reduce(DataFrame.unionByName, found)


def _slice_pairs(flagged: DataFrame, similarity: float, k: int, slices: int) -> DataFrame:
    """Sets meet by a token and a class of sizes: the smaller is posted to every class that its partners may have."""
    size, _, _ = _unpacked(F.col("info"))
    largest = F.floor(size / F.lit(similarity) + F.lit(1e-9))
    x = _postings(flagged.withColumn("class", F.explode(F.sequence(_size_class(size), _size_class(largest)))), "x", k, slices)
    y = _postings(flagged.withColumn("class", _size_class(size)), "y", k, slices)
    size, at, _ = _unpacked(F.col("x_info"))
    x = x.filter(at <= size - F.ceil(size * F.lit(2 * similarity / (1 + similarity)) - F.lit(1e-9)))
    (n, x_at, x_gone), (m, y_at, y_gone) = _unpacked(F.col("x_info")), _unpacked(F.col("y_info"))
    need = _need(n, m, similarity)
    condition = (
        (x["token"] == y["token"])
        & ((n < m) | ((n == m) & (F.col("x_k1") < F.col("y_k1"))))
        & (n >= m * F.lit(similarity) - F.lit(1e-9))
        & ((x_gone + y_gone) < 2)
        & _fits(n, m, "x_", "y_", need)
        & (F.least(n - x_at, m - y_at) >= need)
    )
    return y.join(x, condition).select(F.col("x_k1").alias("a"), F.col("y_k1").alias("b")).distinct()


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(size)).cast("int")


def _postings(sets: DataFrame, side: str, k: int, slices: int) -> DataFrame:
    """The postings of slice ``k``: the token, mixed with the class of sizes, and what the filters need."""
    posts = sets.select("k1", "bits", "more", "info", "class", F.posexplode("prefix").alias("at", "token"))
    posts = posts.filter(F.pmod("token", F.lit(slices)) == k).withColumn("info", F.col("info") + F.col("at"))
    meet = F.col("token").bitwiseXOR(F.shiftleft("class", 26))
    return posts.select(meet.alias("token"), *[F.col(c).alias(f"{side}_{c}") for c in ("k1", "bits", "more", "info")])


def _unpacked(info: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(info, 32), info.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(info, 31).bitwiseAND(F.lit(1))


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, n_lines, removed (line numbers from 1, in order) for every row of ``docs``.

    Lines are what line feeds separate; a line without words is never removed. A line is removed if the set of its
    words has a Jaccard similarity of at least ``similarity`` to that of any earlier line, of this document or another,
    whether that one stays or not. Documents are in the order of doc_id, null last, then of a hash of the text. Rows
    with equal id and text count as one document given twice and get equal results. A null text is one line without
    words, as is an empty one. Tokens are compared by 50 bits of their hash. Other columns are ignored.
    """
    small_batches()
    docs = docs.select("doc_id", "text")
    lines = cut(_lines(docs, token_rarity(docs), similarity), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "line")
    worded = lines.filter("line > 0")
    some = F.col("bits").isNotNull()
    sent = worded.filter("sent")
    # Tasks have sent each set about once, so rows are brought together before they are sorted and not also after.
    sets = sent.repartition("k1", "k2").groupBy("k1", "k2").agg(
        F.min(place).alias("first"),
        F.count("*").alias("times"),
        F.first("n").alias("n"),
        F.first("bits", ignorenulls=True).alias("bits"),
        F.first("more", ignorenulls=True).alias("more"),
        F.first(F.when(some, F.col("stars")), ignorenulls=True).alias("stars"),
        F.first(F.when(some, F.col("prefix")), ignorenulls=True).alias("prefix"),
    )
    sets = cut(sets, "sets")
    stars = cut(_star_pairs(sets, similarity), "stars")
    members = stars.select(F.col("b").alias("k1")).distinct()
    pairs = cut(_prefix_pairs(sets, members, similarity).unionByName(stars).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("k1")).distinct()
    tokens = cut(_token_sets(docs, wanted).join(sets.select("k1", "k2", "first"), ["k1", "k2"]), "line_sets")
    later = cut(_later_of_similar(tokens, pairs, similarity), "later")
    # Pairs of two members were left out; they matter where a member turned out not to be similar to an earlier set.
    among = sets.join(members, "k1", "left_semi")
    rest = _prefix_pairs(among, later.select("k1").distinct(), similarity).distinct()
    later = later.unionByName(_later_of_similar(tokens, rest, similarity)).distinct().withColumn("later", F.lit(True))
    firsts = sets.select("k1", "k2", "first", "times").join(later, ["k1", "k2"], "left").filter((F.col("times") > 1) | F.col("later"))
    told = (
        sent.select("k1", "k2", place.alias("place"))
        .join(firsts, ["k1", "k2"])
        .filter((F.col("place") != F.col("first")) | F.col("later"))
        .select("place.doc_id", "place.text_key", "place.line")
    )
    removed = (
        worded.filter(~F.col("sent")).select("doc_id", "text_key", "line")
        .unionByName(told)
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))
        .withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    )
    heads = lines.filter("line = 0").select("doc_id", "text_key", F.col("n").alias("n_lines"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    nothing = F.array().cast("array<int>")
    return heads.join(removed, same, "left").select("doc_id", "text_key", "n_lines", F.coalesce("removed", nothing).alias("removed"))


def drop_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without repeated lines; a document of which no line with words is left goes, if it had one.

    Null texts and texts without words stay as they are. Columns are those of ``docs``.
    """
    found = repeated_lines(docs, similarity).filter(F.size("removed") > 0)
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "removed").distinct()
    rows = boxed(docs).withColumn("_hash", F.xxhash64("_row.text"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key"))
    joined = rows.join(found, same, "left")
    parts = F.split("_row.text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(1), F.size(parts)), "removed")
    cut_text = F.array_join(F.transform(kept, lambda i: F.element_at(parts, i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("_row.text")).otherwise(cut_text)
    out = joined.withColumn("_text", text)
    left = F.col("_text").rlike("[0-9A-Za-z]|[^\\x00-\\x7F]")
    out = out.filter(F.col("removed").isNull() | left)
    return unboxed(out, docs.columns, text=F.col("_text")).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op9_line_dedup")
def op9_line_dedup(spark, sf_dir):
    found = repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")
