"""Divergence of sources against plain Python: null columns, several blocks of ids, groups without terms, long texts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scenetrail.llm import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top=10):
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(FOLD))
        groups[lang or "", source or ""].update(found)
        held[lang or ""].update(set(found))
    out = []
    for lang in held:
        kept = sorted(t for t, d in held[lang].items() if d >= least)
        sources = [s for x, s in groups if x == lang]

        def prices(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        mine = {s: prices(groups[lang, s]) for s in sources}
        whole = prices(sum((groups[lang, s] for s in sources), Counter()))
        for s in sources:
            p = mine[s]
            pairs = [(o, sum((p[t] - mine[o][t]) ** 2 // (p[t] + mine[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[t] - whole[t]) ** 2 // (p[t] + whole[t])) for t in kept if groups[lang, s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def frame(spark, rows):
    made = [(k, *r, "clash", 2, 3) for k, r in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, term string, n int, block int").repartition(4)


def made_rows(seed, n=400):
    rng = np.random.default_rng(seed)
    letters = ["a", "B", "b", "é", "Z", "ü"]
    words = ["".join(rng.choice(letters, int(rng.integers(1, 4)))) for _ in range(120)]
    rows = []
    for k in range(n):
        source = [None, "", "s1", "s2", "s3", "hot", "hot", "hot"][int(rng.integers(0, 8))]
        lean = 40 if source == "s1" else 0
        text = " 1_".join(words[min(119, lean + int(z))] for z in rng.zipf(1.4, int(rng.integers(0, 40))) if z < 200)
        rows.append((text if k % 50 else None, [None, "", "en", "en", "de"][k % 5], source))
    return rows + [("!!! 12", "en", "no terms"), (None, "de", "no text"), ("lonely word", "xx", "only"), ("rare", "yy", "a"), ("rarer", "yy", "b")]


@pytest.mark.parametrize("least, block_ids", [(10, 4096), (3, 5), (1, 2)])
def test_against_plain(spark, least, block_ids):
    rows = made_rows(least)
    got = source_divergence.divergence(frame(spark, rows), least, block_ids=block_ids)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, least)


def test_long_texts_and_full_counters(spark, monkeypatch):
    """Texts of several pieces, a term across their border, and counters that are handed on often."""
    monkeypatch.setattr(source_divergence, "PIECE", 1 << 10)
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 50)
    long = "x" * 3000 + " " + "Été lang " * 2000 + "y" * 1500
    rows = [(long, "en", f"s{k % 3}") for k in range(11)] + made_rows(8, 100)
    got = source_divergence.divergence(frame(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 10)


def test_empty(spark):
    assert source_divergence.divergence(frame(spark, [("a", "b", "c")]).limit(0)).collect() == []


def test_large_counts(spark):
    """Prices are exact where their products leave 64 bits."""
    from pyspark.sql import functions as F

    cases = [(0, 1, 1), (10**12, 10**13, 10**7), (123_456_789_012_345, 10**15, 10**9), (7, 3 * 10**15, 10**12)]
    df = spark.createDataFrame(cases, "count long, total long, kept long")
    got = [r[0] for r in df.select(source_divergence._price(F.col("count"), F.col("total"), F.col("kept"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in cases]
