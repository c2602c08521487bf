"""Near duplicates against all pairs: a large bucket of texts on one template, and every document of a test table."""

import re
from itertools import combinations

import numpy as np

from scenetrail.llm import near_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def classes(texts):
    """(class of each text by its least member, number of links) over all pairs of different sets."""
    sets = {}
    for i, text in enumerate(texts):
        sets.setdefault(shingles(text), []).append(i)
    sets.pop(frozenset(), None)
    order, parent = list(sets), {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    by_shingle, met, links = {}, set(), 0
    for k, s in enumerate(order):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    for ks in by_shingle.values():
        met.update(combinations(ks, 2))
    for a, b in met:
        if len(order[a] & order[b]) / len(order[a] | order[b]) >= 0.8:
            links += 1
            parent[max(find(a), find(b))] = min(find(a), find(b))
    of = {i: i for i in range(len(texts))}
    members = {}
    for k, s in enumerate(order):
        members.setdefault(find(k), []).extend(sets[s])
    for ids in members.values():
        of.update(dict.fromkeys(ids, min(ids)))
    return of, links


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    of, links = classes(texts)
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()} == of
    return of, links


def test_bucket_of_one_template(spark):
    """Texts about 0.6 to 0.9 alike, most below the threshold, in common buckets."""
    rng = np.random.default_rng(5)
    base = [f"w{int(k)}" for k in rng.integers(0, 5000, 150)]
    texts = []
    for k in range(400):
        words = list(base)
        for at in rng.choice(150, int(rng.choice([2, 3, 4, 5, 6], p=[0.05, 0.1, 0.25, 0.3, 0.3])), replace=False):
            words[at] = f"new{rng.integers(0, 10**9)}"
        texts.append(" ".join(words))
    of, links = check(spark, texts + texts[:40] + [None, "", "short", "short"])
    assert links > 50 and len(set(of.values())) > 50


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    _, links = check(spark, [r.text for r in docs])
    assert links
