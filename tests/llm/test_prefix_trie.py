"""The prefix trie against plain Python: shared turns, exact copies, long conversations, many blocks and rounds."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from scenetrail.llm import prefix_trie


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), mark, role, text))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
        ending[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = sum(saved[c] for c in children[path]) + (len(members[path]) - 1) * words
    return sorted(
        (
            min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), len(children[path]), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ending[path]))).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


def built(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def many(n, seed, deepest):
    """Conversations over few different turns, so that they share prefixes of any length; some are copies."""
    rng, rows = np.random.default_rng(seed), []
    for c in range(n):
        turns = [f"turn {t}" * int(t % 3) for t in rng.integers(0, 3, rng.integers(1, deepest))]
        if c % 5 == 0:
            turns = ["turn 1"] * int(rng.integers(1, deepest))
        if c % 3 == 0:
            turns = [f"turn {k % 7}" for k in range(deepest)]
        rows += [(c * 7, k, "user" if k % 2 else "system", t) for k, t in enumerate(turns)]
    return rows


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("block_bytes, whole_rows", [(1, 20), (2_000, 50), (1 << 20, 50_000)])
def test_blocks_and_rounds(spark, block_bytes, whole_rows):
    rows = many(600, 3, 12)
    made = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), block_bytes, whole_rows)
    assert built(made) == plain(rows)


def test_deep(spark):
    """A trie of a thousand levels takes no more rounds than a flat one."""
    rows = many(40, 5, 1000) + [(10_000 + c, k, "user", f"x {min(k, 900 + c)}") for c in range(30) for k in range(1000)]
    assert built(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), 100_000)) == plain(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (0, 0, "user", "a b"), (0, 1, "user", None), (0, None, None, "first"), (0, 1, "user", ""), (0, 1, "assistant", " x y\tz"),
        (1, 0, "user", "a b"), (1, 0, "user", "a b"), (21, 0, "user", "lent by nobody"), (2, 3, None, None), (3, 1, "", ""),
        (None, 0, "user", "no conversation"), (-5, 0, "user", "a b"), (40, 0, "us", "er"), (41, 0, "u", "ser"), (5, 0, "user", "w " * 200_000),
        *((60 + c, 0, "user", "one") for c in range(20)),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", path string, depth int")
    assert built(prefix_trie.trie(df)) == plain(rows)


def test_many_ends(spark):
    """More copies of one conversation than a text of ids holds."""
    rows = [(c * 20, 0, "user", "same") for c in range(3 * prefix_trie.CHUNK_IDS)]
    assert built(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(7))) == plain(rows)


def test_empty(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
