"""Token counts without token ids.

Each task reduces a block of documents of bounded size to its distinct pre-tokens, each with the documents that hold
it and how often. Pre-tokens that are vocabulary entries are counted from a table of the vocabulary's size; for all
others, the blocks' frequencies meet by pre-token (and by range of blocks, in a corpus of many), its pieces are counted
once there and joined to them, and the products are summed for each document.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from scenetrail.llm.common import query, small_batches, table

BLOCK_BYTES = 32 << 20  # texts of one block
RANGE_BITS = 12  # pieces of a pre-token are counted once for each 4096 tasks whose texts hold it
LIMIT = 1024
_PLAIN_END = 0x530  # below this code point the classes here and in the tokenizer library are known to agree


def _ranges(wanted) -> str:
    out = []
    for _, run in groupby(enumerate(c for c in range(_PLAIN_END) if wanted(c)), lambda x: x[1] - x[0]):
        codes = [c for _, c in run]
        out.append(f"\\u{codes[0]:04x}-\\u{codes[-1]:04x}")
    return "".join(out)


def _plain_pattern() -> re.Pattern:
    """The byte-level pre-tokens of a text without rare characters, for the standard library."""
    letter = _ranges(lambda c: unicodedata.category(chr(c)).startswith("L"))
    number = _ranges(lambda c: unicodedata.category(chr(c)).startswith("N"))
    space = _ranges(lambda c: c in (*range(9, 14), 0x20, 0x85, 0xA0))
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{space}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class Splitter:
    """Pre-tokens of a text, and the number of special strings in it."""

    def __init__(self, path: str):
        self.library = _tokenizer(path).pre_tokenizer
        self.special = re.compile("|".join(re.escape(t.content) for t in _tokenizer(path).get_added_tokens_decoder().values()) or r"(?!)")
        self.plain = _plain_pattern().findall
        self.rare = re.compile(f"[^\\u0000-\\u{_PLAIN_END - 1:04x}]").search

    def split(self, text: str) -> list[str]:
        if self.rare(text) is None:
            return self.plain(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def __call__(self, text: str) -> tuple[list[str], int]:
        parts = self.special.split(text)
        if len(parts) == 1:
            return self.split(text), 0
        return [t for part in parts if part for t in self.split(part)], len(parts) - 1


def _sizes(tokenizer, tokens: list[str]) -> list[int]:
    out: list[int] = []
    for at in range(0, len(tokens), 4096):
        out += [len(e.ids) for e in tokenizer.encode_batch(tokens[at : at + 4096], add_special_tokens=False)]
    return out


def vocabulary_sizes(path: str) -> dict[str, int]:
    """Pieces of the pre-tokens that are vocabulary entries; its size is the vocabulary's."""
    tokenizer = _tokenizer(path)
    entries = [tokenizer.decode([i]) for i in tokenizer.get_vocab(with_added_tokens=False).values()]
    entries = [e for e in entries if e and "�" not in e]
    return dict(zip(entries, _sizes(tokenizer, entries)))


def _uses_byte_level(path: str) -> bool:
    kind = _tokenizer(path)
    return kind.normalizer is None and type(kind.pre_tokenizer).__name__ == "ByteLevel" and not kind.pre_tokenizer.add_prefix_space


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``; other columns are ignored.

    ``path`` is a byte-level BPE file of the tokenizers library, without a normalizer or a prefix space. Null counts
    as empty, with no tokens. Special strings inside a text count as one token, the library's default. Repeated rows
    each give a row; an empty table gives none.
    """
    small_batches()
    if not _uses_byte_level(path):
        raise ValueError("the file must be byte-level BPE without a normalizer or prefix space")
    id_type = docs.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)
    known = vocabulary_sizes(path)
    names = ["block", "token", "postings"]
    head_schema = pa.schema([("doc_id", arrow_id), ("size", pa.int64()), ("count", pa.int64())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        splitter = Splitter(path)
        ids, sizes, counts, places, held = [], [], [], [], 0
        code: dict[str, int] = {}

        def finish() -> Iterator[pa.RecordBatch]:
            block = (task << 32) + number
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head_schema) as head:
                head.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, arrow_id), pa.array(sizes), pa.array(counts)], schema=head_schema))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.nulls(1, pa.string()), pa.array([sink.getvalue().to_pybytes()])], names)
            # Places are (token << 24) + document; a run of equal places is one posting.
            place, times = np.unique(np.concatenate([np.zeros(0, np.int64), *places]), return_counts=True)
            token, first = np.unique(place >> 24, return_index=True)
            posting = np.stack([(place & 0xFFFFFF).astype("<u4"), times.astype("<u4")], axis=1)
            ends = [*first[1:].tolist(), len(place)]
            texts = list(code)
            for at in range(0, len(token), 20_000):
                rows = range(at, min(at + 20_000, len(token)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(rows)),
                        pa.array([texts[token[k]] for k in rows], pa.string()),
                        pa.array([_packed(posting[first[k] : ends[k]]) for k in rows], pa.binary()),
                    ],
                    names,
                )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                tokens, n = splitter(text)
                other = []
                for token in tokens:
                    size = known.get(token)
                    if size is None:
                        other.append(code.setdefault(token, len(code)))
                    else:
                        n += size
                size = len(text.encode())
                places.append((np.array(other, np.int64) << 24) + len(ids))
                ids.append(doc_id), sizes.append(size), counts.append(n)
                held += size + 64
                if held > block_bytes or len(ids) >= 1 << 24:
                    yield from finish()
                    number += 1
                    ids, sizes, counts, places, held = [], [], [], [], 0
                    code = {}
        if ids:
            yield from finish()

    # A block gives a row for each of its pre-tokens, and one without a pre-token with its ids, sizes and known counts.
    blocks = docs.select("doc_id", "text").mapInArrow(split, "block long, token string, postings binary")
    # A frequent pre-token meets its postings in ranges of blocks, so that none of its tasks grows with the corpus.
    met = blocks.repartition(F.coalesce("token", F.col("block").cast("string")), F.shiftright("block", 32 + RANGE_BITS)).sortWithinPartitions("token")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of each pre-token, joined to its postings and summed by document, a part of each block at a time."""
        tokenizer = _tokenizer(path)
        sums: dict[int, list] = {}
        held, size_of = 0, {}

        def rows(block: int, head: bytes | None, postings: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([head], pa.binary()), pa.array([postings], pa.binary())], ["block", "head", "postings"])

        def finish() -> Iterator[pa.RecordBatch]:
            for block, parts in sums.items():
                place, n = _summed(parts)
                yield rows(block, None, _packed(np.stack([place.astype("<u4"), n.astype("<u4")], axis=1)))

        for batch in batches:
            blocks_, tokens, postings = (column.to_pylist() for column in batch.columns)
            new = [t for t in dict.fromkeys(tokens) if t is not None and t not in size_of]
            size_of.update(zip(new, _sizes(tokenizer, new)))
            for block, token, packed in zip(blocks_, tokens, postings):
                if token is None:
                    yield rows(block, packed, None)
                else:
                    sums.setdefault(block, []).append((size_of[token], packed))
                    held += len(packed) + 100
            last = tokens[-1] if tokens else None
            size_of = {last: size_of[last]} if last is not None else {}  # its rows may go on in the next batch
            if held > 64 << 20:
                yield from finish()
                sums, held = {}, 0
        yield from finish()

    result = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )

    def total(rows: pa.Table) -> pa.Table:
        head = next(h for h in rows.column("head").to_pylist() if h is not None)
        docs_ = pa.ipc.open_stream(head).read_all()
        n = np.array(docs_.column("count").to_numpy(), np.int64)
        place, more = _summed([(1, p) for p in rows.column("postings").to_pylist() if p is not None])
        n[place] += more
        return pa.Table.from_arrays([docs_.column("doc_id"), docs_.column("size"), pa.array(n), pa.array(n > limit)], result.names)

    return met.mapInArrow(count, "block long, head binary, postings binary").groupBy("block").applyInArrow(total, result)


def _packed(rows: np.ndarray) -> bytes:
    """(document, number) rows as bytes: two bytes a value where all fit, else four."""
    if rows.size and rows.max() > 0xFFFF:
        return b"\x04" + rows.tobytes()
    return b"\x02" + rows.astype("<u2").tobytes()


def _summed(parts: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(document, sum of weight times number) over weighted packed rows."""
    rows = [np.frombuffer(p, "<u2" if p[0] == 2 else "<u4", offset=1).reshape(-1, 2).astype(np.int64) for _, p in parts]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    weight = np.repeat([w for w, _ in parts], [len(r) for r in rows])
    all_rows = np.concatenate(rows)
    sums = np.bincount(all_rows[:, 0], weights=all_rows[:, 1] * weight)
    place = np.flatnonzero(sums)
    return place, sums[place].astype(np.int64)


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
