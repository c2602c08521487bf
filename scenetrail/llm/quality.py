"""Quality classifier without hand labels.

Heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation over the counts of all vote
patterns (at most 3 ** labellers rows, whatever the corpus) estimates how each labeller votes on good and on bad
documents, and so the probability that a pattern is good. These posteriors are the soft labels that train a linear
scorer on hashed character shapes, on a sample of documents of bounded size; the scorer judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import arrow_function, boxed, query, table, unboxed
from scenetrail.llm.words import Words, mixed, pieces, shingles, text_bytes, words_of

TRAINING_DOCS = 2500  # bound of the sample that trains the scorer
DIMENSIONS = 2048
LABELLERS = (
    "symbols", "symbol_runs", "capitals", "shouting", "repeated_threes", "repeated_sixes", "bars", "bar_lines", "sentences", "word_length",
)
BAD, GOOD, NONE = 0, 1, 2

_codes = np.arange(256)
_LETTER = ((_codes >= 65) & (_codes <= 90)) | ((_codes >= 97) & (_codes <= 122))
_SYMBOL = np.isin(_codes, list(b"#$%&*+<=>@^_`{|}~\\!"))
_STOP = np.isin(_codes, list(b".?!:;"))
# Shape of a character: letters by case, digits, non-ASCII and white space as classes, other characters themselves.
_SHAPE = np.select(
    [(_codes >= 65) & (_codes <= 90), (_codes >= 97) & (_codes <= 122), (_codes >= 48) & (_codes <= 57), _codes >= 128, _codes <= 32],
    [65, 97, 48, 97, 32], _codes,
).astype(np.uint64)


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def _graded(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def _distinct_share(words: Words, n: int) -> np.ndarray:
    """Distinct runs of n words by all runs, for each text; 1 for a text without words."""
    gram, doc, first = shingles(words, n)
    order = np.lexsort((gram, doc))
    new = np.ones(len(gram), bool)
    new[1:] = (np.diff(gram[order]) != 0) | (np.diff(doc[order]) != 0)
    total = np.diff(first)
    return np.where(total > 0, np.bincount(doc[order][new], minlength=len(total)) / np.maximum(total, 1), 1.0)


def statistics(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x labellers) what each labeller looks at, and the number of words of each text."""
    words = words_of(raw, ends)
    n = np.diff(words.first)
    some = np.maximum(n, 1)
    upper = (raw >= 65) & (raw <= 90)
    symbol = _SYMBOL[raw]
    run = np.zeros(len(raw), bool)
    run[1:] = symbol[1:] & (raw[1:] == raw[:-1])
    second = np.minimum(words.start + 1, words.end - 1)
    lines = _per_text(raw == 10, ends) + 1
    bar = np.flatnonzero(raw == ord("|"))
    line = np.searchsorted(np.flatnonzero(raw == 10), bar)  # place of the line in the piece
    doc = np.searchsorted(ends, bar, "right") - 1
    barred = np.unique(doc * (len(raw) + 2) + line) // (len(raw) + 2)
    out = [
        _per_text(symbol, ends) / some,
        _per_text(run, ends) / some,
        _per_text(upper, ends) / np.maximum(_per_text(_LETTER[raw], ends), 1),
        _per_text(upper[second] & (words.end - words.start > 1), words.first) / some,
        _distinct_share(words, 3),
        _distinct_share(words, 6),
        _per_text(raw == ord("|"), ends) / some,
        np.bincount(barred, minlength=len(n)) / lines,
        some / np.maximum(_per_text(_STOP[raw], ends), 1),
        _per_text(words.end - words.start, words.first) / some,
    ]
    return np.stack(out, axis=1), n


def votes(stats: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """(texts x labellers) votes. A text without words gets none."""
    symbols, runs, capitals, shouting, threes, sixes, bars, bar_lines, sentence, length = stats.T
    long = n_words >= 20
    out = np.stack(
        [
            _graded(symbols < 0.05, symbols > 0.25),
            _graded(runs < 0.02, runs > 0.25),
            _graded(capitals < 0.2, capitals > 0.6),
            _graded(shouting < 0.1, shouting > 0.5),
            _graded(threes > 0.8, (threes < 0.6) & long),
            _graded(sixes > 0.8, (sixes < 0.6) & long),
            _graded(bars < 0.02, bars > 0.2),
            _graded(bar_lines < 0.1, bar_lines > 0.5),
            _graded((sentence > 3) & (sentence < 60), (sentence > 200) | ((sentence < 1.5) & long)),
            _graded((length > 2.5) & (length < 9), (length > 15) | (length < 1.5)),
        ],
        axis=1,
    )
    out[n_words == 0] = NONE
    return out


def pattern_codes(vote: np.ndarray) -> np.ndarray:
    return vote @ (3 ** np.arange(vote.shape[1]))


def fit_labellers(patterns: dict[int, int], n_labellers: int, rounds: int = 100) -> dict[int, float]:
    """Probability of good by vote pattern, from the count of each pattern (Dawid and Skene's model)."""
    if not patterns:
        return {}
    codes = np.array(sorted(patterns))
    counts = np.array([patterns[c] for c in codes], float)
    vote = (codes[:, None] // 3 ** np.arange(n_labellers)) % 3
    bad_votes = (vote == BAD).sum(axis=1)
    good = np.array([0.95, 0.5, 0.05])[np.minimum(bad_votes, 2)]  # to begin with: bad votes are rare and mean much
    for _ in range(rounds):
        share = np.average(good, weights=counts).clip(1e-6, 1 - 1e-6)
        log = np.tile(np.log([1 - share, share]), (len(codes), 1))
        for k in range(n_labellers):
            seen = vote[:, k][:, None] == np.arange(3)
            for side, weight in ((0, counts * (1 - good)), (1, counts * good)):
                rate = (weight @ seen + 1.0) / (weight.sum() + 3.0)
                log[:, side] += np.log(rate)[vote[:, k]]
        log -= log.max(axis=1, keepdims=True)
        new = np.exp(log[:, 1]) / np.exp(log).sum(axis=1)
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return dict(zip(codes.tolist(), good.tolist()))


def shape_buckets(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of the shapes of each three characters, and the text they belong to."""
    shape = _SHAPE[raw]
    if len(shape) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = shape[:-2] * np.uint64(65536) + shape[1:-1] * np.uint64(256) + shape[2:]
    bucket = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(53)).astype(np.int64) % DIMENSIONS
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    whole = doc[:-2] == doc[2:]
    return bucket[whole], doc[:-2][whole]


_STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 1.0, 1.5, 2.5, 5, 10, 20, 60, 200])


def statistic_buckets(stats: np.ndarray) -> np.ndarray:
    """(texts x labellers) hash bucket of each statistic's grade."""
    grade = np.searchsorted(_STEPS, stats).astype(np.uint64)
    code = grade + np.arange(stats.shape[1]).astype(np.uint64) * np.uint64(100) + np.uint64(1 << 40)
    return (mixed(code) % np.uint64(DIMENSIONS)).astype(np.int64)


def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        raw, ends = text_bytes(batch)
        for _, _, part, borders in pieces(raw, ends):
            bucket, doc = shape_buckets(part, borders)
            n = len(borders) - 1
            share = np.bincount(doc * DIMENSIONS + bucket, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
            share = share / np.maximum(share.sum(axis=1, keepdims=True), 1)
            np.add.at(share, (np.arange(n)[:, None], statistic_buckets(statistics(part, borders)[0])), 0.1)
            out += [row.tobytes() for row in share.astype(np.float32)]
        yield pa.array(out, pa.binary())


def fit_scorer(features: np.ndarray, labels: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic model, by gradient steps with adapted sizes."""
    scale = np.sqrt(np.maximum(features.mean(axis=0), 1e-6))
    x = np.ones((len(features), features.shape[1] + 1), np.float32)
    np.divide(features, scale, out=x[:, :-1], casting="unsafe")
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = x.T @ (p - labels).astype(np.float32) / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    w[:-1] /= scale
    return w


@dataclass
class Model:
    posterior: dict[int, float]
    weights: np.ndarray


def _vote_codes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        raw, ends = text_bytes(batch)
        out = [pattern_codes(votes(*statistics(part, borders))) for _, _, part, borders in pieces(raw, ends)]
        yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.int32())


def fit(docs: DataFrame, training_docs: int = TRAINING_DOCS) -> Model:
    """The label model from all documents, the scorer from at most ``training_docs`` of them.

    The sample holds the documents with the least hash of id and text, so that reruns agree.
    """
    code = arrow_function(_vote_codes, "int")
    counted = docs.select(code("text").alias("code")).groupBy("code").count()
    patterns = {r["code"]: r["count"] for r in counted.collect()}  # at most 3 ** labellers rows
    posterior = fit_labellers(patterns, len(LABELLERS))
    total = sum(patterns.values())
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("h"))
    share = min(1.0, 1.5 * training_docs / max(total, 1))
    most = min(2**63 - 1, int(-(2**63) + share * 2**64))
    near = hashed.filter(F.col("h") <= F.lit(most)).orderBy("h").limit(training_docs)
    rows = near.select(arrow_function(_features, "binary")("text").alias("x"), code("text").alias("code")).collect()
    if not rows:
        return Model(posterior, np.zeros(DIMENSIONS + 1))
    labels = np.array([posterior[r["code"]] for r in rows])
    features = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(len(rows), DIMENSIONS)
    del rows
    return Model(posterior, fit_scorer(features, labels))


def _scorer(model: Model):
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_code = np.full(3 ** len(LABELLERS), 0.5)
        by_code[list(model.posterior)] = list(model.posterior.values())
        weights, intercept = model.weights[:-1], model.weights[-1]
        for batch in batches:
            raw, ends = text_bytes(batch)
            post, scores = [], []
            for _, _, part, borders in pieces(raw, ends):
                stats, n_words = statistics(part, borders)
                bucket, doc = shape_buckets(part, borders)
                n = len(borders) - 1
                total = np.bincount(doc, weights=weights[bucket], minlength=n)
                mean = total / np.maximum(np.bincount(doc, minlength=n), 1) + 0.1 * weights[statistic_buckets(stats)].sum(axis=1)
                p = 1 / (1 + np.exp(-np.clip(mean + intercept, -30, 30)))
                post.append(by_code[pattern_codes(votes(stats, n_words))])
                scores.append(np.where(n_words > 0, p, 0.0))
            join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0), pa.float64())
            yield pa.StructArray.from_arrays([join(post), join(scores)], ["posterior", "score"])

    return arrow_function(score, "struct<posterior:double,score:double>")


def classify(docs: DataFrame, model: Model | None = None, threshold: float = 0.3) -> DataFrame:
    """``docs`` with posterior (label model), score (scorer) and keep (score at least ``threshold``).

    A null text, an empty one and one without words have score 0 and are not kept. Equal texts score alike; an empty
    table gives an empty result. Columns of ``docs`` with the names of the results are replaced.
    """
    model = model or fit(docs)
    rows = boxed(docs).withColumn("_judged", _scorer(model)(F.col("_row.text")))
    score = F.col("_judged.score")
    return unboxed(rows, docs.columns, posterior=F.col("_judged.posterior"), score=score, keep=score >= threshold)


@query("op5_quality")
def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs).select("doc_id", "posterior", "score", "keep")
