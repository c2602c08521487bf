"""Words of whole Arrow string columns as arrays of hashes, without a Python object per word.

A word is a run of ASCII letters, digits and all bytes of non-ASCII characters; A-Z count as a-z. The bytes of
a column are treated as one array, cut into pieces of a bounded number of bytes (a longer text is a piece of its own).
Word hashes are 64-bit polynomials of the bytes, mixed; equal words have equal hashes in every task.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 17  # small enough for the working arrays to stay in a core's cache
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
IS_WORD = ((_bytes >= 48) & (_bytes <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_bytes >= 128)


def mapped(raw: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The one-byte value of each byte; much faster than to index by the bytes, which numpy widens first."""
    return np.frombuffer(raw.tobytes().translate(values.tobytes()), values.dtype)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the n + 1 borders of its texts. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, borders, data = column.buffers()
    ends = np.frombuffer(borders, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def pieces(raw: np.ndarray, ends: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after the last, bytes, borders) for runs of texts of at most ``most`` bytes, or of one text."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, to, raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        gc.collect()  # a worker has these functions anew in each task; earlier tasks' tables wait for the collector
        size = max(n, PIECE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            table = np.cumprod(steps, dtype=np.uint64)
            if size > 8 * PIECE_BYTES:  # of one very long text: not kept
                _powers.pop(name, None)
                if name == "up":
                    up = table
                else:
                    return up, table
            else:
                _powers[name] = table
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of a piece in order. ``doc`` is the text's place in the piece, ``first`` the n + 1 borders by text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def words_of(raw: np.ndarray, ends: np.ndarray, hashes: bool = True) -> Words:
    n_docs, n = len(ends) - 1, len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), none, np.zeros(n_docs + 1, np.int64))
    inside = mapped(raw, IS_WORD)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    border = ends[:-1][ends[:-1] < n]
    before[border] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    border = ends[1:][ends[1:] > 0] - 1
    after[border] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, ends)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    return Words(start, end, segment_hash(mapped(raw, LOWER), start, end) if hashes else start.astype(np.uint64), doc, first)


def segment_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes [start, end)."""
    up, down = _power_table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, borders by text) of all runs of n words; a text of fewer words, but not none, is one shingle."""
    counts = np.diff(words.first)
    per_doc = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    doc = np.repeat(np.arange(len(counts)), per_doc)
    at = np.arange(first[-1]) - first[doc] + words.first[doc]
    length = np.minimum(counts[doc], n)
    out = length.astype(np.uint64)
    for k in range(n):
        have = length > k
        next_word = words.hash[np.where(have, at + k, 0)] if len(words.hash) else out
        out = np.where(have, mixed(out * np.uint64(_BASE) + next_word), out)
    return out, doc, first


def binary_keys(parts: list[np.ndarray]) -> pa.Array:
    """One binary value a row from the big-endian bytes of 64-bit columns."""
    table = np.stack(parts, axis=1).astype(">u8")
    n, width = len(table), 8 * len(parts)
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(table.tobytes())]
    )


def text_keys(words: Words) -> list[np.ndarray]:
    """128 bits of each text's word sequence, as two columns: equal sequences, and only they, agree."""
    n = len(words.first) - 1
    place = (np.arange(len(words.hash)) - words.first[words.doc]).astype(np.uint64)
    out = []
    for seed in (0x1D8E4E27C47D124F, 0x632BE59BD9B4E019):
        term = mixed(words.hash ^ mixed(place + np.uint64(seed)))
        sums = np.zeros(len(term) + 1, np.uint64)
        np.cumsum(term, out=sums[1:])
        out.append(mixed(sums[words.first[1:]] - sums[words.first[:-1]] + np.diff(words.first).astype(np.uint64)))
    return out if n else [np.zeros(0, np.uint64)] * 2


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its joined values and the length of each row."""
    borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))
