"""How far the sources of a language differ in their terms, two by two, and which terms stand out.

Terms are counted where the texts lie and added up for each group (language and source); the terms of a language
that enough of its documents hold are kept. A group is a sorted list of (term id, price), cut into blocks of ids by a hash
of the term, so that no list grows with the vocabulary. The two lists of each unordered pair of sources meet a block at a
time: the ids of the shorter list are searched in the longer one, terms that both, one or none of them hold are priced, and
the sums serve both directions. All prices are whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scenetrail.llm.common import by_bytes, query, table
from scenetrail.session import cut

LEAST_DOCUMENTS = 10  # of a language that hold a kept term
SCALE = 1_000_000_000
TOP = 10  # terms of a group that are reported
BLOCK_IDS = 1024  # terms of a block, about
HELD_TERMS = 150_000  # counts that a task holds at once
PIECE = 1 << 20  # bytes of a text whose terms are held at once
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte that end where a term ends."""
    at = 0
    while at < len(text):
        to = at + PIECE
        if to < len(text):
            rest = _TERM.match(text, to)
            to = rest.end() if rest else to
        yield text[at:to]
        at = to


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of what a task holds, and one row without a term for each group."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def finish() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in n.items():
            terms = list(counts)
            held = docs[lang, source]
            for at in range(0, len(terms) + 1, 20_000):
                part: list[bytes | None] = terms[at : at + 20_000]
                if at == 0:
                    part = [None, *part]
                if part:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array([0 if t is None else counts[t] for t in part], pa.int64()), pa.array([0 if t is None else held[t] for t in part], pa.int64()),
                        ],
                        ["lang", "source", "term", "n", "docs"],
                    )

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            key = lang, source
            if key not in n:
                n[key], docs[key] = Counter(), Counter()
            seen: set[bytes] = set()
            for piece in _pieces((text.as_py() or "").encode().translate(_FOLD)):
                found = _TERM.findall(piece)
                n[key].update(found)
                seen.update(found)
            docs[key].update(seen)
            if sum(map(len, n.values())) > HELD_TERMS:
                yield from finish()
                n, docs = {}, {}
    yield from finish()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: one row for each term of a group, and one with a null term for each group."""
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    parts = docs.select(*text).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE x (count + 2) / (total + 2 x kept)), by long division, three digits of SCALE at a time.

    Exact while total + 2 x kept is below 9 x 10^15.
    """
    below = total + 2 * kept
    out, rest = F.lit(0).cast("bigint"), count + 2
    for _ in range(3):
        out = out * 1000 + _div(rest * 1000, below)
        rest = (rest * 1000) % below
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _pair_sums(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """For each row, two sorted id lists with prices, and the price of an absent term on each side."""

    def apart(p, q):
        return (p - q) * (p - q) // (p + q)

    def lists(ids: pa.Array, prices: pa.Array):
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
        flat, price = ids.flatten().to_numpy(), prices.flatten().to_numpy()
        return [(flat[a:b], price[a:b]) for a, b in zip(ends[:-1], ends[1:])]

    for ids_a, ids_b, price_a, price_b, none_a, none_b in columns:
        sums, held = [], []
        for (a, p), (b, q), p0, q0 in zip(lists(ids_a, price_a), lists(ids_b, price_b), none_a.to_pylist(), none_b.to_pylist()):
            if len(a) > len(b):  # the price is the same both ways
                a, p, p0, b, q, q0 = b, q, q0, a, p, p0
            at = np.searchsorted(b, a)
            both = np.zeros(len(a), bool)
            inside = at < len(b)
            both[inside] = b[at[inside]] == a[inside]
            only_b = np.ones(len(b), bool)
            only_b[at[both]] = False
            total = int(apart(p[both], q[at[both]]).sum()) + int(apart(p[~both], q0).sum()) + int(apart(p0, q[only_b]).sum())
            sums.append(total)
            held.append(len(a) + int(only_b.sum()))
        yield pa.StructArray.from_arrays([pa.array(sums, pa.int64()), pa.array(held, pa.int64())], ["value", "held"])


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, block_ids: int = BLOCK_IDS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each ordered pair of sources, ``term`` rows for the terms of a group.

    Null text, lang or source counts as empty, and rows with an empty one are a group like any other. Repeated rows count
    each time. Ties of a value go by the item's bytes. A language whose terms all fall short has pairs of value 0 and no
    term rows; one of a single source has no pairs; an empty table gives no rows. Other columns are ignored.
    """
    counts = cut(term_counts(docs), "counts")
    of_term = W.partitionBy("lang", "term")
    kept = cut(
        counts.filter("term IS NOT NULL")
        .withColumn("row", F.monotonically_increasing_id())
        .withColumns(
            {
                "lang_docs": F.sum("docs").over(of_term),
                "lang_n": F.sum("n").over(of_term),
                "id": F.min("row").over(of_term),  # of no other term
            }
        )
        .filter(F.col("lang_docs") >= least)
        .select("lang", "source", "term", "n", "lang_n", "id", (F.col("id") == F.col("row")).alias("leads")),
        "kept",
    )
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("leads").cast("bigint")).alias("leads"))
    of_lang = W.partitionBy("lang")
    groups = cut(  # one row a group
        counts.filter("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").fillna(0, ["total", "leads"])
        .withColumns({"lang_total": F.sum("total").over(of_lang), "terms": F.sum("leads").over(of_lang)})
        .withColumn("none", F.when(F.col("terms") > 0, _price(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))).otherwise(1))
        .drop("leads"),
        "groups",
    )
    priced = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "id",
        _price(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _price(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        "terms", "none",
    )
    return _pairs(priced, groups, block_ids).unionByName(_terms(priced, top))


def _pairs(priced: DataFrame, groups: DataFrame, block_ids: int) -> DataFrame:
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / block_ids)).cast("int")
    entries = priced.select("lang", "source", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), F.struct("id", "p").alias("entry"), "terms", "none")
    # Every group has every block of its language, so that a pair meets where one of the two has no terms.
    empty = groups.select("lang", "source", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(None).cast("struct<id:bigint,p:bigint>").alias("entry"), "terms", "none")
    lists = (
        entries.unionByName(empty)
        .repartition("lang", "block")  # for the lists and their meeting
        .groupBy("lang", "block", "source")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"), F.max("terms").alias("terms"), F.max("none").alias("none"))
        .select("lang", "block", "source", F.col("entries.id").alias("ids"), F.col("entries.p").alias("prices"), "terms", "none")
    )
    a, b = lists.alias("a"), lists.drop("terms").alias("b")
    met = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.source") < F.col("b.source")))
    summed = by_bytes(_pair_sums, "struct<value:bigint,held:bigint>")(*[F.col(f"{side}.{c}") for c in ("ids", "prices") for side in "ab"], "a.none", "b.none")
    pairs = (
        met.select("a.lang", F.col("a.source").alias("one"), F.col("b.source").alias("other"), "terms", F.col("a.none").alias("p0"), F.col("b.none").alias("q0"), summed.alias("sums"))
        .groupBy("lang", "one", "other", "terms", "p0", "q0")
        .agg(F.sum("sums.value").alias("value"), F.sum("sums.held").alias("held"))
        .withColumn("value", F.col("value") + (F.col("terms") - F.col("held")) * _apart(F.col("p0"), F.col("q0")))
    )
    both = F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item")))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.select("lang", F.inline(both), "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(priced: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        priced.filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )


@query(
    "op13_source_divergence",
    r"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
    ), words AS (
      SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ), kept AS (
      SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
    ), groups AS (
      SELECT DISTINCT lang, source FROM docs
    ), langs AS (
      SELECT lang, CAST(sum(n) AS HUGEINT) AS n_all, count(*) AS v FROM kept GROUP BY lang
    ), counts AS (
      SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
    ), totals AS (
      SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n_all FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
    ), prices AS (
      SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (t.n_all + 2 * l.v) AS p,
        1 + 1000000000::HUGEINT * (k.n + 2) // (l.n_all + 2 * l.v) AS q
      FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
    ), found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((
        SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM prices x JOIN prices y USING (lang, term)
        WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM prices WHERE n > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
)
def op13_source_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))
