"""Benchmark decontamination by Wu-Manber search over words.

Patterns are all windows of ten consecutive words of the benchmark items; an item of fewer words, but not none, is
one window. Windows of one length form one machine. For a machine of windows of m words, every block of B words
that occurs in some window at word j has a shift of m - B - j, the least over all windows; any other block
shifts by m - B + 1. The search looks at the block that ends the current m words of the text and moves on by its shift.
At shift 0, the windows that end in this block (the bucket of the suffix) are compared word for word.

The windows are sent to the tasks in blocks of bounded size, one pass over the documents each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import arrow_function, boxed, query, table, unboxed
from scenetrail.session import cut

WINDOW = 10
BLOCK_BYTES = 32 << 20  # windows of one pass
_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_FOLD = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    """Words of a text, as UTF-8: runs of ASCII letters (A-Z as a-z), digits and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class WuManber:
    """Windows of one length with their shift table and suffix buckets."""

    def __init__(self, windows: dict[tuple, tuple], length: int):
        self.length, self.block = length, min(2, length)
        self.shift: dict = {}
        self.buckets: dict = {}
        last = length - self.block
        for words, items in windows.items():
            for j in range(last + 1):
                block = words[j] if self.block == 1 else words[j : j + 2]
                if self.shift.get(block, length) > last - j:
                    self.shift[block] = last - j
            suffix = words[-1] if self.block == 1 else words[-2:]
            self.buckets.setdefault(suffix, []).append((words, items))

    def search(self, text: tuple) -> Iterator[tuple[int, tuple]]:
        """(first word, items) of every occurrence of a window."""
        m, n, far = self.length, len(text), self.length - self.block + 1
        shift, buckets, end = self.shift, self.buckets, self.length
        while end <= n:
            block = text[end - 1] if self.block == 1 else text[end - 2 : end]
            step = shift.get(block, far)
            if step:
                end += step
                continue
            found = text[end - m : end]
            for words, items in buckets[block]:
                if words == found:
                    yield end - m, items
            end += 1


def _scanner(rows: list[tuple[tuple, tuple]]):
    """An Arrow function: words, hit ranges and items found for each text."""
    by_length: dict[int, dict] = {}
    for words, items in rows:
        by_length.setdefault(len(words), {})[words] = items

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machines = [WuManber(w, m) for m, w in sorted(by_length.items())]
        for batch in batches:
            out = []
            for text in batch:
                words = tuple(split_words(text.as_py()))
                ranges, items = [], set()
                for machine in machines:
                    for start, found in machine.search(words):
                        ranges.append((start, start + machine.length))
                        items.update(found)
                merged: list[list[int]] = []
                for start, end in sorted(ranges):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                out.append({"n_words": len(words), "hits": [{"start": a, "end": b} for a, b in merged], "items": sorted(items)})
            yield pa.array(out, kind)

    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )
    return arrow_function(scan, FOUND)


FOUND = "struct<n_words:bigint,hits:array<struct<start:bigint,end:bigint>>,items:array<string>>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, items): the distinct windows, words joined by one space, with the ids of the items that hold them."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = split_words(text)
                size = min(window, len(words))
                found = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
                ids += [item] * len(found)
                out += [w.decode("utf-8", "surrogatepass") for w in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())], ["item", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    found = items.mapInArrow(windows, "item string, words string")
    return found.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hits (ranges of hit words), n_hit, items (ids found, sorted as strings), contaminated.

    A word is hit if it lies in any occurrence of a window. A null or empty text has no words and no hits. An item
    without words gives no window; an item with a null id hits without being listed; items with equal ids count once.
    Repeated documents get equal results. Columns of ``docs`` with the names of the results are replaced.
    """
    windows = cut(benchmark_windows(benchmark, window), "windows")
    total = windows.agg(F.sum(F.octet_length("words") + F.coalesce(F.octet_length(F.array_join("items", ",")), F.lit(0)) + 64)).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    rows, columns = boxed(docs), docs.columns
    for block in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        scan = _scanner([(tuple(r["words"].encode("utf-8", "surrogatepass").split(b" ")), tuple(r["items"])) for r in part.collect()])
        rows = rows.withColumn("_new", scan(F.col("_row.text")))
        if block == 0:
            rows = rows.withColumnRenamed("_new", "_found")
        else:
            rows = rows.select("_row", F.struct(
                F.col("_new.n_words").alias("n_words"),
                F.concat("_found.hits", "_new.hits").alias("hits"),
                F.array_distinct(F.concat("_found.items", "_new.items")).alias("items"),
            ).alias("_found"))
        if block + 1 < blocks:
            rows = cut(rows, "decontaminate")
    if blocks > 1:
        rows = rows.withColumn("_found", F.col("_found").withField("hits", _merged(F.col("_found.hits"))))
    n_hit = F.aggregate("_found.hits", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    rows = rows.withColumn("_n_hit", n_hit)
    return unboxed(
        rows, columns, n_words=F.col("_found.n_words"), hits=F.col("_found.hits"), n_hit=F.col("_n_hit"),
        items=F.array_sort("_found.items"), contaminated=F.col("_n_hit") > 0,
    )


def _merged(ranges):
    """Overlapping ranges joined, in order."""
    kind = "array<struct<start:bigint,end:bigint>>"
    return F.aggregate(
        F.array_sort(ranges),
        F.array().cast(kind),
        lambda done, r: F.when(
            (F.size(done) > 0) & (r["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], r["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op2_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
    ),
    pos AS (
      SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS s
      FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)
    ),
    occ AS (SELECT r, i, pos.m, item_id FROM pos JOIN win ON pos.m = win.m AND pos.s = win.s),
    hit AS (
      SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM occ) GROUP BY r
    ),
    found AS (
      SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM occ WHERE item_id IS NOT NULL) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
    """,
)
def op2_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
