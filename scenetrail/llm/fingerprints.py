"""Merkle fingerprints of texts.

A text is cut, without a gap, into pieces of a few words (after a line end, and after a word whose hash is a multiple
of four), so an edit changes the pieces around it only. Pieces make paragraphs (lines), and paragraphs make sections,
which end at a blank line or after a paragraph whose hash is a multiple of four. The hash of a paragraph covers its
pieces, that of a section its paragraphs, and the root the sections.

The fingerprint is text: the root, then the tree with 32 bits of each piece, as in
``root:piece piece,piece;piece`` (blank between pieces, comma between paragraphs, semicolon between sections).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from scenetrail.llm.common import arrow_function, query, table
from scenetrail.llm.words import mixed, pieces, segment_hash, text_bytes, words_of

_CUT = np.uint64(3)  # one word in four ends a piece, one paragraph in four a section
SLICE_ROWS = 4096


def _digest(parts: bytes) -> bytes:
    return hashlib.blake2b(parts, digest_size=16).digest()


def fingerprints(texts: pa.Array) -> list[str]:
    """The fingerprint of each text; null counts as empty."""
    out: list[str] = []
    raw, ends = text_bytes(texts)
    for _, _, part, borders in pieces(raw, ends):
        words = words_of(part, borders)
        cut = words.end[(words.hash & _CUT) == 0]
        line = np.flatnonzero(part == 10) + 1
        stops = np.unique(np.concatenate([cut, line, borders[1:]]))
        stops = stops[stops > 0]
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        hashes = segment_hash(part, starts, stops) if len(stops) else np.zeros(0, np.uint64)
        is_line = np.zeros(len(stops), bool)
        is_line[np.searchsorted(stops, line)] = True
        blank = is_line & (part[starts] == 10) if len(stops) else is_line
        first = np.searchsorted(stops, borders, "right")
        names = [f"{h:08x}" for h in (hashes >> np.uint64(32)).tolist()]
        body = hashes.astype(">u8").tobytes()
        marks, line_marks, blanks = mixed(hashes + np.uint64(1)) & _CUT, is_line.tolist(), blank.tolist()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            out.append(_tree(a, b, names, body, line_marks, blanks, marks))
    return out


def _tree(a: int, b: int, names: list[str], body: bytes, line: list[bool], blank: list[bool], marks: np.ndarray) -> str:
    sections, paragraphs, texts, done = [], [], [], []
    at = a
    for k in range(a, b):
        if line[k] or k == b - 1:
            paragraphs.append(_digest(body[8 * at : 8 * (k + 1)]))
            texts.append(" ".join(names[at : k + 1]))
            at = k + 1
            if blank[k] or marks[k] == 0 or k == b - 1:
                sections.append(_digest(b"".join(paragraphs)))
                done.append(",".join(texts))
                paragraphs, texts = [], []
    return _digest(b"".join(sections)).hex() + ":" + ";".join(done)


def likeness(a: str, b: str) -> float:
    """1 for equal roots; else the pieces in common, counted twice, by all pieces of both."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = _leaves(a), _leaves(b)
    both = sum((left & right).values())
    return 2.0 * both / (left.total() + right.total())


def _leaves(fingerprint: str) -> Counter:
    return Counter(fingerprint[33:].replace(",", " ").replace(";", " ").split())


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a``, counted from 0, that ``b`` does not hold; only differing branches are opened."""
    if a[:32] == b[:32]:
        return []
    sections = Counter(b[33:].split(";"))
    rest, out = [], []
    for i, section in enumerate(a[33:].split(";")):
        if sections[section]:
            sections[section] -= 1
        else:
            rest.append((i, section))
    there = Counter(p for section in sections.elements() for p in section.split(","))
    for i, section in rest:
        for j, paragraph in enumerate(section.split(",")):
            if there[paragraph]:
                there[paragraph] -= 1
            else:
                out.append((i, j))
    return out


def fingerprint(text: Column | str) -> Column:
    """The fingerprint of a text column; null counts as empty, equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(fingerprints(batch), pa.string())

    return arrow_function(run, "string")(text)


def _slices(docs: DataFrame, rows: int) -> list[tuple]:
    """The least (doc_id is null, doc_id, text hash) of even slices of the documents, in order.

    One small row for a slice of ``rows`` documents comes to the driver.
    """
    keys = docs.select(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"))
    n = max(1, -(-keys.count() // rows))
    sorted_keys = keys.repartitionByRange(n, "no_id", "doc_id", "hash")
    least = sorted_keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("no_id", "doc_id", "hash")).alias("k"))
    return sorted(((r["k"]["no_id"], r["k"]["doc_id"], r["k"]["hash"]) for r in least.collect()), key=_order)


def _order(key: tuple) -> tuple:
    return (key[0], 0 if key[0] else key[1], key[2])


def _placer(bounds: list[tuple]):
    """The slice of a document, and whether it is the first of its slice."""

    def place(no_id: pa.Array, doc_id: pa.Array, key: pa.Array) -> pa.Array:
        from bisect import bisect_right

        firsts = [_order(b) for b in bounds]
        keys = [_order(k) for k in zip(no_id.to_pylist(), doc_id.to_pylist(), key.to_pylist())]
        at = [bisect_right(firsts, k) - 1 for k in keys]
        return pa.StructArray.from_arrays(
            [pa.array(at, pa.int32()), pa.array([firsts[i] == k for i, k in zip(at, keys)], pa.bool_())], ["slice", "first"]
        )

    return arrow_function(place, "struct<slice:int,first:boolean>")


def edited_fingerprints(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Fingerprints of each document and of its edited text.

    In the edited text the last floor(n_chars / 2) code points are replaced by the first as many of the next document
    (or all it has); the next is by ascending doc_id, null last, equal ids by the hash of the text; after the last
    comes the first. Null counts as empty; rows that are repeated follow each other; an empty table gives no rows.
    Result: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Other columns of
    ``docs`` are ignored.

    Documents are dealt to slices of ids; the first document of a slice also goes to the slice before it, so no
    slice needs another, and each text moves once.
    """
    docs = docs.select("doc_id", "text")
    bounds = _slices(docs, slice_rows)
    if not bounds:
        bounds = [(True, None, 0)]
    n = len(bounds)
    id_type = docs.schema["doc_id"].dataType
    keyed = docs.select("doc_id", "text", F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("hash"))
    placed = keyed.withColumn("at", _placer(bounds)("no_id", "doc_id", "hash"))
    own = F.struct(F.col("at.slice").alias("slice"), F.lit(False).alias("lead"))
    lead = F.struct(F.pmod(F.col("at.slice") - 1, F.lit(n)).alias("slice"), F.lit(True).alias("lead"))
    dealt = placed.select("doc_id", "text", "no_id", "hash", F.explode(F.when(F.col("at.first"), F.array(own, lead)).otherwise(F.array(own))).alias("to"))
    ordered = (
        dealt.select("doc_id", "text", "no_id", "hash", "to.slice", "to.lead")
        .repartition(n, "slice")
        .sortWithinPartitions("slice", "lead", "no_id", "doc_id", "hash")
        .select("slice", "lead", "doc_id", "text")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    arrow_id = to_arrow_type(id_type)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (slice, doc_id, text, fingerprint, is lead) of the row before
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                marks = fingerprints(part.column(3))
                rows = list(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), marks, part.column(1).to_pylist()))
                pairs = []
                for row in rows:
                    if before is not None and before[0] == row[0] and not before[4]:
                        pairs.append((before, row))
                    before = row
                if not pairs:
                    continue
                edited = []
                for own, following in pairs:
                    text, other = own[2] or "", following[2] or ""
                    half = len(text) // 2
                    edited.append(text[: len(text) - half] + other[:half])
                new = fingerprints(pa.array(edited, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[1] for own, _ in pairs], arrow_id),
                        pa.array([len(own[2] or "") for own, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                        pa.array([own[3] for own, _ in pairs], pa.string()),
                        pa.array(new, pa.string()),
                        pa.array([likeness(own[3], e) for (own, _), e in zip(pairs, new)], pa.float64()),
                        pa.array([likeness(own[3], following[3]) for own, following in pairs], pa.float64()),
                    ],
                    names,
                )

    return ordered.mapInArrow(run, schema)


@query("op6_fingerprints")
def op6_fingerprints(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))
