"""Licence scan of lines and paragraphs, in DataFrame functions only.

A softmax regression over word n-grams (one to three words) is trained on licence notices, cut-down and framed forms of
them, and sentences of the unknown class; a soft threshold keeps the weights sparse, and a temperature fitted on held-out
forms calibrates the probabilities. Every n-gram of the model holds an anchor, a word that is not a common one, so a
line without an anchor is unknown without further work. For all others, n-grams are joined to the weights, a table
of the size of the notices, and summed by line, and by paragraph, for which each line takes in the words next to it. A
prediction is confirmed if the line or paragraph holds enough of a notice of its family.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scenetrail.llm.common import query, table
from scenetrail.llm.licence_texts import OTHER, TEMPLATES

UNKNOWN = "unknown"
MOST_WORDS = 3
CONFIRMED = 0.6  # share of a notice's n-grams that a paragraph must hold
_EDGE = 200  # characters of a neighbouring line in which its two nearest words are looked for
_LETTERS = r"[\p{L}\p{N}]"  # a line without any is blank
# Fixed value: common words, which are no anchors.
COMMON = frozenset(
    "a after all an and any are as at be been by can for from had has he his in including into is it its may no not of on one or other that "
    "the their they this to was were which who will with without you your new year last people see each".split()
)


def split_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def ngrams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, MOST_WORDS + 1) for i in range(len(words) - n + 1)}


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]  # n-gram -> weight of each class
    intercept: tuple[float, ...]

    @property
    def anchors(self) -> list[str]:
        return sorted({w for gram in self.weights for w in gram.split(" ")} - COMMON)

    def probabilities(self, text: str) -> np.ndarray:
        """Of each class, for one paragraph."""
        logit = np.array(self.intercept)
        for gram in ngrams(split_words(text)):
            logit = logit + np.array(self.weights.get(gram, np.zeros(len(self.classes))))
        e = np.exp(logit - logit.max())
        return e / e.sum()


def _forms(text: str) -> list[list[str]]:
    """A notice as it stands, framed by other words, and shortened at either end."""
    words = split_words(text)
    frame_a, frame_b = "copyright 2021 the authors".split(), "see the file for details".split()
    out = [words, frame_a + words, words + frame_b]
    if len(words) >= 8:
        out += [words[: -(len(words) // 5)], words[len(words) // 5 :]]
    return out


@lru_cache(maxsize=1)
def train(rounds: int = 400, shrink: float = 2e-4) -> Model:
    """The model; the notices and sentences are fixed, so it is the same everywhere."""
    classes = (*TEMPLATES, UNKNOWN)
    rows = [(form, c, k) for c, family in enumerate(TEMPLATES) for text in TEMPLATES[family] for k, form in enumerate(_forms(text))]
    rows += [(split_words(text), len(TEMPLATES), k) for k, text in enumerate(OTHER)]
    rows += [(split_words(text)[:3], len(TEMPLATES), k) for k, text in enumerate(OTHER)]
    rows += [([w], len(TEMPLATES), 0) for w in sorted({w for t in TEMPLATES.values() for x in t for w in split_words(x)})]
    held_out = np.array([k % 5 == 3 for _, _, k in rows])
    grams = sorted({g for words, _, _ in rows for g in ngrams(words) if not COMMON.issuperset(g.split(" "))})
    place = {g: i for i, g in enumerate(grams)}
    x = np.zeros((len(rows), len(grams)))
    for r, (words, _, _) in enumerate(rows):
        x[r, [place[g] for g in ngrams(words) if g in place]] = 1
    y = np.eye(len(classes))[[c for _, c, _ in rows]]

    def fit(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, t = x[chosen], y[chosen]
        balance = (1 / t.sum(axis=0).clip(1))[t.argmax(axis=1)][:, None] * len(t) / t.shape[1]
        w, b = np.zeros((a.shape[1], t.shape[1])), np.zeros(t.shape[1])
        b[-1] = 2.0
        step = 4.0 / max(1.0, (a * a).sum(axis=1).mean() ** 0.5)
        for _ in range(rounds):
            g = balance * (_softmax(a @ w + b) - t) / len(t)
            w -= step * a.T @ g
            w = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0)
            b[:-1] -= step * g.sum(axis=0)[:-1]
        return w, b

    w, b = fit(~held_out)
    logits = x[held_out] @ w + b
    right = y[held_out].argmax(axis=1)
    heats = np.geomspace(0.2, 3, 40)
    loss = [-np.log(_softmax(logits / h)[np.arange(len(right)), right].clip(1e-12)).mean() for h in heats]
    heat = heats[int(np.argmin(loss))]
    w, b = fit(np.ones(len(rows), bool))
    w, b = w / heat, b / heat
    kept = np.abs(w).max(axis=1) > 0
    return Model(classes, {g: tuple(row) for g, row, k in zip(grams, w.round(6).tolist(), kept) if k}, tuple(b.round(6).tolist()))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _runs(words: Column, n: int) -> Column:
    """The runs of n words of an array."""
    run = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, run).otherwise(F.array().cast("array<string>"))


def _ngrams(words: Column) -> Column:
    """Distinct n-grams of an array of words."""
    return F.array_distinct(F.concat(*[_runs(words, n) for n in range(1, MOST_WORDS + 1)]))


def _fixed_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of fixed rows, as SQL."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _split(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, row, at (from 0), line, the edges of the lines next to it, top and end of its paragraph; blank lines give none.

    Lines are dealt to their paragraphs before they become rows, so the work is linear in the lines of a text.
    """
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.split("text", "\n").alias("lines"))

    def near(line: Column, i: Column) -> Column:
        before, after = F.get("lines", i - 1), F.get("lines", i + 1)
        return F.struct(
            line.alias("line"),
            F.when(F.rlike(before, F.lit(_LETTERS)), F.concat_ws(" ", F.right(F.get("lines", i - 2), F.lit(_EDGE)), F.right(before, F.lit(_EDGE)))).alias("before"),
            F.when(F.rlike(after, F.lit(_LETTERS)), F.concat_ws(" ", F.left(after, F.lit(_EDGE)), F.left(F.get("lines", i + 2), F.lit(_EDGE)))).alias("after"),
        )

    blank = F.array_compact(F.transform("lines", lambda line, i: F.when(~F.rlike(line, F.lit(_LETTERS)), i)))
    # A generated row holds its arrays; a projection might work them out again for each paragraph.
    parts = F.struct(blank.alias("blank"), F.size("lines").alias("n"), F.transform("lines", near).alias("near"))
    held = split.filter("lines IS NOT NULL").select("doc_id", "row", F.inline(F.array(parts)))
    borders = F.arrays_zip(F.concat(F.array(F.lit(-1)), "blank").alias("before"), F.concat("blank", F.array("n")).alias("after"))
    between = F.filter(borders, lambda b: b["after"] - b["before"] > 1)
    paragraphs = F.transform(
        between,
        lambda b: F.struct(
            (b["before"] + 1).alias("begin"), b["after"].alias("end"), F.slice("near", b["before"] + 2, b["after"] - b["before"] - 1).alias("near")
        ),
    )
    dealt = held.select("doc_id", "row", F.inline(paragraphs))
    found = dealt.select("doc_id", "row", "begin", "end", F.posexplode("near").alias("pos", "_l"))
    return found.select("doc_id", "row", (F.col("begin") + F.col("pos")).alias("at"), (F.col("begin") + 1).alias("top"), "end", "_l.*")


def _units(lines: DataFrame, anchors: Column) -> DataFrame:
    """doc_id, row, top (of the paragraph), first, last, whole, grams: lines with an anchor, and their part of a longer paragraph."""
    found = lines.filter(F.arrays_overlap(F.split(F.lower("line"), "[^a-z0-9]+"), anchors)).withColumn("words", _split(F.col("line")))
    before, after = (F.coalesce(_split(F.col(c)), F.array().cast("array<string>")) for c in ("before", "after"))
    wide = F.concat(F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), 2), F.col("words"), F.slice(after, 1, 2))
    found = found.select("doc_id", "row", (F.col("at") + 1).alias("number"), "top", "end", "words", wide.alias("wide"))
    line = F.struct(F.col("number").alias("first"), F.col("number").alias("last"), F.lit(False).alias("whole"), _ngrams(F.col("words")).alias("grams"))
    part = F.struct(F.col("top").alias("first"), F.col("end").alias("last"), F.lit(True).alias("whole"), _ngrams(F.col("wide")).alias("grams"))
    units = F.when(F.col("top") < F.col("end"), F.array(line, part)).otherwise(F.array(line))
    return found.select("doc_id", "row", "top", F.explode(units).alias("_u")).select("doc_id", "row", "top", "_u.*")


def _told(judged: DataFrame) -> DataFrame:
    """Which lines and paragraphs are told, and by which notice.

    A paragraph is told by a notice that none of its lines holds, or if no line of it is of its family. A line that is not
    confirmed goes if it is a piece of the notice of its paragraph, that is, if half of its n-grams are in that notice.
    """
    whole = Window.partitionBy("row", "top")
    whether = F.col("whole")
    sure = F.filter("notices", lambda o: o["overlap"] >= CONFIRMED)
    tags = F.transform(sure, lambda o: F.struct(F.col("family").alias("family"), o["t"].alias("t")))
    seen = judged.withColumn("families", F.collect_set(F.when(~whether, F.col("family"))).over(whole)).withColumn(
        "held", F.flatten(F.collect_set(F.when(~whether, tags)).over(whole))
    )
    new = F.filter(sure, lambda o: ~F.array_contains("held", F.struct(F.col("family").alias("family"), o["t"].alias("t"))))
    seen = seen.withColumn("new", F.when(whether, new))
    seen = seen.withColumn("best", F.array_max(F.when(F.size("new") > 0, F.col("new")).otherwise(F.col("notices"))))
    seen = seen.withColumn("piece_of", F.max(F.when(F.size("new") > 0, F.col("best.notice"))).over(whole))
    piece = F.size(F.array_intersect("grams", "piece_of")) >= 0.5 * F.size("grams")
    gone = (F.col("best.overlap") < CONFIRMED) & F.coalesce(piece, F.lit(False))
    return seen.filter(F.when(whether, (F.size("new") > 0) | ~F.array_contains("families", F.col("family"))).otherwise(~gone))


def scan(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, paragraph, family, probability, template, overlap, confirmed, last_line: one row for each licence line or paragraph.

    Lines are numbered from 1. A paragraph is a run of lines with a letter or digit in each. ``paragraph`` is the first line
    and ``last_line`` the last; they are equal for a line. A line, or a paragraph of several, counts if a family, not unknown,
    is the likeliest class with at least ``threshold``; a paragraph is left out where its lines say the same, and a line
    that is a piece of the notice of its paragraph. ``template`` is the notice of the family (counted from 0) of which the
    line or paragraph holds the largest share of n-grams, ``overlap``; confirmed from 0.6 on. Null, empty and other texts
    give no rows. Each of several equal rows gives its own rows. Other columns of ``docs`` are ignored.
    """
    model = model or train()
    spark = docs.sparkSession
    k = len(model.classes)
    weights = F.broadcast(_fixed_table(spark, [{"gram": g, "w": w} for g, w in model.weights.items()], "gram:string,w:array<double>"))
    anchors = F.array(*map(F.lit, model.anchors))
    unit = ["row", "top", "first", "last", "whole"]
    # explode_outer: explode adds a filter on the n-grams, which the optimizer puts before the filter on anchors.
    found = _units(_lines(docs), anchors).select(*unit, "doc_id", F.explode_outer("grams").alias("gram"))
    # The lines of a paragraph share n-grams, which count once.
    found = found.join(weights.select("gram"), "gram", "left_semi").distinct().join(weights, "gram")
    sums = found.groupBy(*unit).agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_set("gram").alias("grams"),  # n-grams of the model only
        *[F.sum(F.col("w")[c]).alias(f"s{c}") for c in range(k)],
    )
    logits = [F.col(f"s{c}") + F.lit(model.intercept[c]) for c in range(k)]
    top = F.greatest(*logits)
    total = sum((F.exp(v - top) for v in logits[1:]), F.exp(logits[0] - top))
    family = F.element_at(F.array(*map(F.lit, model.classes)), F.array_position(F.array(*logits), top).cast("int"))
    judged = sums.select(*unit, "doc_id", "grams", family.alias("family"), (1 / total).alias("probability"))
    judged = judged.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= threshold))
    known = [
        {"family": f, "notices": [{"t": -i, "notice": sorted(ngrams(split_words(t)) & model.weights.keys())} for i, t in enumerate(texts)]}
        for f, texts in TEMPLATES.items()
    ]
    notices = F.broadcast(_fixed_table(spark, known, "family:string,notices:array<struct<t:int,notice:array<string>>>"))

    def compared(n: Column) -> Column:
        overlap = F.size(F.array_intersect("grams", n["notice"])) / F.size(n["notice"])
        return F.struct(overlap.alias("overlap"), n["t"].alias("t"), n["notice"].alias("notice"))

    return _told(judged.join(notices, "family").withColumn("notices", F.transform("notices", compared))).select(
        "doc_id", F.col("first").alias("paragraph"), "family", "probability", (-F.col("best.t")).alias("template"),
        F.col("best.overlap").alias("overlap"), (F.col("best.overlap") >= CONFIRMED).alias("confirmed"), F.col("last").alias("last_line"),
    )


@query("op10_licences")
def op10_licences(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
