"""URL filter: glob rules as one bit-parallel automaton (Shift-And with wildcards) over each canonical URL.

The canonical URL is ``.host``, a border mark, then the path. Every glob is a run of bits, one for each of its
characters, packed over as many 64-bit words as needed. A step shifts all runs at once and keeps the bits whose
character fits; ``?`` fits any character, ``*`` keeps the bit before it on. All URLs of a batch step together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import arrow_function, boxed, query, table, unboxed
from scenetrail.llm.words import text_bytes

BORDER = "\x01"
_ANY, _STAR = 256, 257


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains and all paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int]:
        return [_STAR, *f".{self.host}{BORDER}{self.path}".encode(), _STAR]


# Rules of the query; the longest that fits decides.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

# Globs of hosts that are blocked where no rule fits; * is any run of characters, ? any one.
BLOCKED_HOSTS = ("*.ads-*", "*.adult-*", "*.casino-*", "*.cheap-*", "*.free-bets.*", "*.spam-*")


def glob_symbols(host_glob: str) -> list[int]:
    """Symbols of a glob for hosts; a leading ``*.`` also fits the host without a subdomain."""
    host = [_STAR if c == 42 else _ANY if c == 63 else c for c in host_glob.encode()]
    return [*([] if host[:1] == [_STAR] else [ord(".")]), *host, ord(BORDER), _STAR]


class Automaton:
    """All patterns in one set of masks of ``width`` 64-bit words."""

    def __init__(self, patterns: list[list[int]]):
        bits = sum(sum(s != _STAR for s in p) for p in patterns)
        self.width = max(1, -(-bits // 64))
        fits = np.zeros((256, self.width * 64), bool)
        stays, first, floating = (np.zeros(self.width * 64, bool) for _ in range(3))
        self.last = []
        at = 0
        for pattern in patterns:
            begun = False
            for symbol in pattern:
                if symbol == _STAR:
                    if begun:
                        stays[at - 1] = True
                    else:
                        floating[at] = True
                    continue
                if not begun:
                    first[at], begun = True, True
                fits[slice(None) if symbol == _ANY else symbol, at] = True
                at += 1
            self.last.append(at - 1)
        pack = lambda x: np.packbits(x, axis=-1, bitorder="little").view(np.uint64)
        self.fits, self.stays, self.first, self.floating = pack(fits), pack(stays), pack(first), pack(floating)

    def match(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(texts x patterns): which patterns fit each whole text."""
        lengths = np.diff(ends)
        order = np.argsort(-lengths, kind="stable")
        start, length = ends[:-1][order], lengths[order]
        state = np.zeros((len(length), self.width), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        n, step = len(length), 0
        while True:
            n = int(np.searchsorted(-length[:n], -step, "left"))  # texts longer than step
            if n == 0:
                break
            now = state[:n]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved = (moved & ~self.first) | (self.first if step == 0 else self.floating)
            state[:n] = (moved & self.fits[raw[start[:n] + step]]) | (now & self.stays)
            step += 1
        out = np.empty((len(length), len(self.last)), bool)
        for k, bit in enumerate(self.last):
            out[order, k] = (state[:, bit >> 6] >> np.uint64(bit & 63)) & one == one
        return out


def _judge(rules: tuple[Rule, ...], blocked: tuple[str, ...]):
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = Automaton([r.symbols() for r in ranked] + [glob_symbols(g) for g in blocked])
        names = np.array([r.name for r in ranked] + [None], object)
        verdicts = np.array([r.verdict for r in ranked] + ["allow", "block"], object)
        for batch in batches:
            found = machine.match(*text_bytes(batch))
            rules_fit, globs_fit = found[:, : len(ranked)], found[:, len(ranked) :].any(axis=1)
            best = np.where(rules_fit.any(axis=1), rules_fit.argmax(axis=1) if ranked else 0, len(ranked))
            verdict = verdicts[np.where(best < len(ranked), best, len(ranked) + globs_fit)]
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], ["rule", "verdict"])

    return arrow_function(judge, "struct<rule:string,verdict:string>")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """``pages`` with host, path, rule (the longest that fits, or null) and verdict (allow or block).

    Where no rule fits, a host glob blocks, and all else is allowed; so is a null, an empty text or one without a
    host. Of two rules of one length, a block goes first, then the lesser name. Repeated rows are judged alike.
    Columns of ``pages`` with the names of the results are replaced.
    """
    if any(not g.strip("*") for g in blocked):
        raise ValueError("a glob needs a character besides *")
    rows = boxed(pages)
    host, path = host_and_path(F.col("_row").getField(url))
    rows = rows.withColumns({"_host": host, "_path": path})
    mark = lambda c: F.translate(c, BORDER, "\x02")
    canonical = F.concat(F.lit("."), mark(F.col("_host")), F.lit(BORDER), mark(F.col("_path")))
    rows = rows.withColumn("_judged", _judge(rules, blocked)(canonical))
    return unboxed(
        rows, pages.columns, host=F.col("_host"), path=F.col("_path"),
        rule=F.col("_judged.rule"), verdict=F.col("_judged.verdict"),
    )


def _fits_sql(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


@query(
    "op3_url_rules",
    f"""
    WITH u AS (
      SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages
    ),
    p AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM u
    ),
    r AS (
      SELECT *, CASE WHEN {_fits_sql("example.org", "/en/1")} THEN 'example.org/en/1'
                     WHEN {_fits_sql("example.org", "/es/")} THEN 'example.org/es/'
                     WHEN {_fits_sql("com", "/de/")} THEN 'com/de/'
                     WHEN {_fits_sql("com", "/fr/")} THEN 'com/fr/'
                     WHEN {_fits_sql("org", "/")} THEN 'org/' END AS rule
      FROM p
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN '.' || host LIKE '%.ads-%' OR '.' || host LIKE '%.adult-%' OR '.' || host LIKE '%.casino-%'
                  OR '.' || host LIKE '%.cheap-%' OR '.' || host LIKE '%.free-bets.%' OR '.' || host LIKE '%.spam-%'
                THEN 'block' ELSE 'allow' END AS verdict
    FROM r
    """,
)
def op3_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
