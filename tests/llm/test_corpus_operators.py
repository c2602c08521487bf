"""The operators against plain Python on small cases: nulls, empty texts, ties, repeats, empty tables, clashing names."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenetrail.llm import decontaminate, fingerprints, html_text, licences, line_dedup, mix, near_dedup, quality, token_counts, url_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
RNG = np.random.default_rng(7)
VOCABULARY = ["".join(chr(97 + k) for k in RNG.integers(0, 26, 5)) for _ in range(400)] + ["Über", "naïve"]


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def edited(text, changes, seed):
    rng, out = np.random.default_rng(seed), text.split()
    for at in rng.integers(0, len(out), changes):
        out[at] = f"new{rng.integers(0, 10**9)}"
    return " ".join(out)


BASE = prose(200, 1)
TEXTS = [
    BASE, BASE, BASE.upper(), edited(BASE, 2, 5), edited(BASE, 3, 6), edited(BASE, 60, 7), None, "", "   ", "one", "One!", "two words",
    prose(30, 2) + "\n" + prose(12, 3) + "\nOf.", prose(12, 3) + "\n" + edited(prose(30, 2), 1, 8) + "\nOf.", "!!! ---\n\n...", prose(5000, 4),
    "Licensed under the Apache License, Version 2.0.", *(edited(BASE, 4, 100 + k) for k in range(12)), *(prose(40, 200 + k) for k in range(12)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 1, "clash") for i, t in enumerate(TEXTS)]
    rows += [(None, prose(20, 9), "en", "s0", 1, "clash"), (3, TEXTS[3], "en", "s0", 1, "clash"), (3, prose(25, 10), "en", "s0", 1, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int, key string").repartition(3)


@pytest.fixture(scope="module")
def listed(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_mix(docs, listed, none):
    found = mix.mix(docs, slice_rows=4).collect()
    assert len(found) == len(listed)
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sorted(r.size for r in found) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in listed)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
        open_ -= over
    goal |= share
    longest = max(r.size for r in found)
    for s in order:
        assert target[s] == pytest.approx(goal[s])
        assert abs(taken[s] - goal[s]) <= longest
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = {(r.doc_id, r.mark): r.taken for r in mix.mix(docs.repartition(5), slice_rows=9).collect()}
    assert again == {(r.doc_id, r.mark): r.taken for r in found}
    assert mix.mix(none).count() == 0 and mix.mixed_documents(none).count() == 0
    kept = mix.mixed_documents(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "key", "size", "source_size", "target", "taken"]
    assert kept.agg(F.sum("taken")).first()[0] == sum(taken.values())


def test_decontaminate(spark, docs, listed, none):
    items = [(1, " ".join(BASE.split()[20:45])), (2, "One"), (None, "two, words"), (3, ""), (4, None), (1, "TWO words"), (10, prose(30, 2))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = []
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        windows += [(item, tuple(w[i : i + m])) for i in range(len(w) - m + 1) if m]
    expected = []
    for doc_id, text, _ in listed:
        w, hit, ids = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    ids |= {str(item)} - {"None"}
        expected.append((str(doc_id), len(w), len(hit), ",".join(sorted(ids)), bool(hit)))
    for block_bytes in (decontaminate.BLOCK_BYTES, 900):
        found = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in found) == sorted(expected)
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count()


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://A.Example.org/es/x?y", "http://example.org/en/12#t", "http://example.org/en/2",
        "http://badexample.org/es/", "http://x.com/fr/1", "http://x.com/de/", "http://x.com/de", "http://x.net/com/fr/", "a://b.c://d.org/x", "http://casino-win.net/",
        "http://www.adult-x.net", "http://x.com/fr/" + "a" * 5000, "http://\x01.org/", "http://free-bets.net/a", "http://freeXbets.net/",
    ]
    rows = url_rules.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit(1))).collect()

    def expect(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(FOLD)
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [r for r in url_rules.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        glob = any(re.fullmatch(g.replace(".", "[.]").replace("*", ".*"), "." + host) for g in url_rules.BLOCKED_HOSTS)
        return host, path, best and best.name, best.verdict if best else "block" if glob else "allow"

    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == expect(r.url), r.url
    machine = url_rules.Automaton([url_rules.glob_symbols("a?c*"), url_rules.glob_symbols("*.b*b.c")])
    raw = b".abc\x01/" + b".x.bb.c\x01" + b".ac\x01"
    assert machine.match(np.frombuffer(raw, np.uint8), np.array([0, 6, 14, 18])).tolist() == [[True, False], [False, True], [False, False]]


def _components(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_near_dedup(docs, listed, none):
    sets = []
    for _, text, _ in listed:
        w = words(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    ]
    classes = _components(range(len(sets)), links)
    groups = {}
    for i, c in classes.items():
        groups.setdefault(c, []).append(listed[i][0])
    expected = sorted(
        (str(listed[i][0]), str(min((d for d in groups[c] if d is not None), default=None)), len(groups[c])) for i, c in classes.items()
    )
    found = near_dedup.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == expected
    assert len(links) > 20
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.deduplicate(none).count() == 0


def test_dart_signatures():
    elements = RNG.integers(0, 2**63, 1000).astype(np.uint64)
    both = np.concatenate([elements[:900], elements[100:]])
    marks = near_dedup.dart_signatures(both, np.repeat([0, 1], 900), 2, 2000)
    assert abs((marks[0] == marks[1]).mean() - 0.8) < 0.04
    a, b = RNG.uniform(0.1, 3, 300), RNG.uniform(0.1, 3, 300)
    marks = near_dedup.dart_signatures(np.tile(elements[:300], 2), np.repeat([0, 1], 300), 2, 3000, np.concatenate([a, b]))
    assert abs((marks[0] == marks[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_quality(spark, docs, none):
    good = [(i, ". ".join(prose(12, 1000 + 10 * i + k).capitalize() for k in range(6)) + ".", 1) for i in range(300)]
    bad = [(1000 + i, (" ".join(f"{w}{'#$%&'[k % 4] * 3}" for k, w in enumerate(prose(60, 5000 + i).split()))), 0) for i in range(30)]
    bad += [(2000 + i, (prose(6, 6000 + i) + " ") * 20, 0) for i in range(30)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, label int").withColumn("score", F.lit("x"))
    found = quality.classify(table).collect()
    right = sum(r.keep == bool(r.label) for r in found)
    assert right / len(found) > 0.97
    assert [r.keep for r in found] == [r.keep for r in quality.classify(table).collect()]
    odd = {(r.doc_id, r.text): r for r in quality.classify(docs).collect()}
    for text in (None, "", "   "):
        assert all(r.score == 0 and not r.keep for (_, t), r in odd.items() if t == text)
    assert quality.classify(none).count() == 0


def test_fingerprints(docs, listed, none):
    found = fingerprints.edited_fingerprints(docs, slice_rows=6).collect()
    assert len(found) == len(listed)
    ids = [r for r in listed if r[0] is not None and r[0] != 3]
    ids.sort()
    by_id = {r.doc_id: r for r in found}
    for (a, text, _), (b, other, _) in zip(ids, ids[1:]):
        if b == a + 1:
            text, other = text or "", other or ""
            new = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
            assert by_id[a].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert by_id[a].n_chars == len(text)
            assert by_id[a].near_next == fingerprints.likeness(by_id[a].fingerprint, by_id[b].fingerprint)
    prints = {}
    for r in found:
        if r.doc_id is not None and r.doc_id != 3:
            prints.setdefault(r.fingerprint, set()).add(TEXTS[r.doc_id] or "")
    assert all(len(v) == 1 for v in prints.values())
    assert 0.3 < by_id[15].near_edited < 0.7
    assert fingerprints.edited_fingerprints(none).count() == 0
    assert fingerprints.edited_fingerprints(docs.filter("doc_id = 0")).first().near_next == 1.0


def test_differing():
    import pyarrow as pa

    lines = [prose(15, k) for k in range(40)]
    a, b = fingerprints.fingerprints(pa.array(["\n".join(lines), "\n".join(lines[:20] + ["changed"] + lines[21:])]))
    assert len(fingerprints.differing(a, b)) == 1 and fingerprints.differing(a, a) == []


def test_token_counts(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    more = ["a <|endoftext|> b<|endoftext|>", "don't  we'll\n\n  x\t\t y", "日本語 текст \u0558\u10940", "½²³ 12ab", "\u00a0\u2003 x", "😀😀 ok", "<|endoftext|>"]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(500 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    for block_bytes in (token_counts.BLOCK_BYTES, 2000):
        found = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(table, path, block_bytes=block_bytes).collect())
        expected = []
        for r in table.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            expected.append((str(r.doc_id), len((r.text or "").encode()), n, n > 1024))
        assert found == sorted(expected)
    assert token_counts.count_tokens(none, path).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies.</p></div>
<aside class="sidebar"><p>Popular now</p></aside><main><article><header><h1>Title &amp; more</h1></header><p>First   paragraph&nbsp;with <b>bold
words</b> in it, long enough to count.<p>Short.</p><div class="ad">Buy this</div><ul><li>item one<li>item two</ul><blockquote>A quote</blockquote>
<form><label>Mail</label><input name="m"><button>Go</button></form><p>Last paragraph of the article with some more words.</p></article>
<section id="comments"><h2>Comments</h2><p>I like this long comment, which is not part of the article.</p></section></main>
<footer>&copy; nobody</footer></body></html>"""


def test_html_text(spark):
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph with bold words in it, long enough to count.", "Short.", "item one", "item two", "A quote",
        "Last paragraph of the article with some more words.",
    ]
    assert html_text.main_text("<body><div id=x><p>One two three four five six.</p><p>Seven.</p></div></body>") == "One two three four five six.\nSeven."
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (5, "u", "plain &lt;text&gt;"), (1, "u", PAGE)], "page_id int, url string, html string")
    found = html_text.extract_pages(pages.withColumn("text", F.lit("clash"))).collect()
    assert sorted((r.page_id, r.n_chars) for r in found if r.page_id > 1) == [(2, 0), (3, 0), (4, 0), (5, 12)]
    assert {r.text for r in found if r.page_id == 1} == {html_text.main_text(PAGE)}
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 2999) == "deep"


def test_html_text_open_head():
    """The end tag of a head may be left out."""
    text = html_text.main_text
    assert text("<html><head><title>x</title><body><article><p>Text</p></article>") == "Text"
    assert text("<html><head><title>x</title><meta charset=utf-8><article><p>Text</p></article>") == "Text"
    assert text("<head><title>x</title>Text without an element") == "Text without an element"
    assert text("<head><noscript><div>Switch it on</div></noscript><style>p{}</style><p>Text</p>") == "Text"
    assert text("<head><noscript><link href=x><body><p>Text</p>") == "Text"
    assert text("<head><title>x</title></head><body><p>Text</p>") == "Text"


LONG = "A sentence of the article that is long enough to be counted as text of a cluster."


@pytest.mark.parametrize(
    "page",
    [
        "<div class='elementor-widget elementor-widget-text-editor'><p>{0}</p></div>",
        "<div class='elementor widget'><p>{0}</p></div>",
        "<article class='post tag-social'><p>{0}</p></article>",
        "<article class='post social'><p>{0}</p></article>",
        "<div id='content' class='has-sidebar'><p>{0}</p></div>",
        "<div id='content' class='no-sidebar'><p>{0}</p></div>",
        "<form id='aspnetForm'><input type=hidden><div class='content'><p>{0}</p></div><div class='comments'><p>{0} {0} Mine.</p></div></form>",
        "<div class='modal'><article><p>{0}</p></article></div><div class='cookie_notice'><p>{0} {0} {0} We use cookies.</p></div>",
        "<div class='ad'><p>{0}</p></div>",
        "<div class='widget'><p>{0}</p></div><div class='Share Buttons' id='share-buttons'><p>Share this page</p></div>",
        "<div class='content'><p>{0}</p></div><form><p>Your mail, please</p></form><div class='related'><article><p>Read on</p></article></div>",
    ],
)
def test_html_text_marks(page):
    """Parts of names mark nothing, and no mark takes the article."""
    assert html_text.main_text("<body>" + page.format(LONG) + "</body>") == LONG


def test_html_text_entry_header():
    page = "<body><article><div class='entry-header'><h1>Title</h1></div><div class='header'>By me</div><p>" + LONG + "</p><div class='ad'>Buy</div></article></body>"
    assert html_text.main_text(page) == "Title\nBy me\n" + LONG


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<main><h1>Title</h1><article><p>{0}</p></article></main>", "Title\n{0}"),
        ("<main><article><p>{0} {0} {0}</p></article><article><p>{0} {0}</p></article></main>", "{0} {0} {0}\n{0} {0}"),
        ("<div id=a><article><p>{0} {0} {0}</p></article><article><p>{0} {0}</p></article></div>", "{0} {0} {0}\n{0} {0}"),
        ("<div id=a><h1>Title</h1><p>A lead.</p><div class='body'><p>{0} {0}</p><p>{0}{0}</p><p>{0}{0}</p></div></div>", "Title\nA lead.\n{0} {0}\n{0}{0}\n{0}{0}"),
        ("<div id=a><h2>T</h2><p>A</p><div class='body'><p>{0} {0}</p><p>{0}{0}</p><p>{0}{0}</p></div></div>", "T\nA\n{0} {0}\n{0}{0}\n{0}{0}"),
        ("<div id=t><h1>T</h1></div><ul><li>a<li>b<li>c</ul><div class='body'><p>{0} {0}</p><p>{0}{0}</p></div>", "T\na\nb\nc\n{0} {0}\n{0}{0}"),
        ("<div id=l><h1>Site</h1></div><ul><li>a<li>b<li>c</ul><main><p>{0}</p><section><p>{0}</p></section></main>", "{0}\n{0}"),
        ("<div id=l><a href=x>a</a><a href=y>b</a><a href=z>c</a></div><article><h1>T</h1><p>{0} {0}</p><p>{0}</p></article>", "T\n{0} {0}\n{0}"),
    ],
)
def test_html_text_containers(page, expected):
    """All clusters belong to the article, and what stands beside them."""
    assert html_text.main_text("<body>" + page.format(LONG) + "</body>") == expected.format(LONG)


PARAGRAPHS = "".join(f"<p>{LONG} {i}</p>" for i in range(4))
TEXT = "\n".join(f"{LONG} {i}" for i in range(4))
LINKS = "<div class=topbar><a href=a>Home</a> <a href=b>News</a></div>"


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (LINKS + "<div class=content>{0}</div><div class=legal>Copyright 2024 Somebody</div>", "{1}"),
        (LINKS + "<div class=t><h1>T</h1></div><div class=content>{0}</div><div class=legal>Copyright 2024 Somebody</div>", "T\n{1}"),
        ("<div class=content>{0}</div><p>Copyright</p>", "{1}"),
        ("<div class=content>{0}</div><h3>More stories</h3>", "{1}"),
        ("<div class=content>{0}<div class=user-comments><p>{0}</p></div></div>", "{1}"),
        ("<article>{0}<div class=reader-reactions><p>Mine, and a long one it is.</p></div></article>", "{1}"),
        ("<article><div class=ad-box-300>Buy</div>{0}<div class=advert-slot>Buy</div><div class=google-ad>Buy</div></article>", "{1}"),
        ("<article class='post comments-open'>{0}</article>", "{1}"),
        ("<main><article><h1>T</h1>{0}{0}</article><div class=voices><p>A long voice of a reader, on everything.</p></div></main>", "T\n{1}\n{1}"),
        ("<article><p>Alpha <script>x()</script> beta <svg><text>z</text></svg> gamma</p>{0}</article>", "Alpha beta gamma\n{1}"),
        ("<article><p>Alpha <math><mi>x</mi></math> and <label>beta</label> gamma</p>{0}</article>", "Alpha x and beta gamma\n{1}"),
        ("<article><h1>T</h1><div class=by>By <a href=x>Jane Doe</a></div>{0}<div class=end>The end.</div></article>", "T\nBy Jane Doe\n{1}\nThe end."),
        ("<div id=c><div>{1}</div><div>{1}</div><div>Short end.</div></div>", None),
    ],
)
def test_html_text_by_ratio(page, expected):
    """Unlisted names: regions go by links, ratio and place, and what stands in a line does not end it."""
    expected = (TEXT.replace("\n", " ") + "\n") * 2 + "Short end." if expected is None else expected.format(PARAGRAPHS, TEXT)
    assert html_text.main_text("<body>" + page.format(PARAGRAPHS, TEXT) + "</body>") == expected


@pytest.mark.parametrize("piece", ["<font>", "<div>x", "</b>", "<form>", "<p><td><form>", "<li>x", "<div class=ad>x", "<head><noscript><font>", "<section><h1>x", "<table><tr><td>x"])
def test_html_text_unclosed(piece):
    """50,000 tags that are never closed, or never opened, take time in proportion."""
    began = time.process_time()
    html_text.main_text(piece * 50_000)
    assert time.process_time() - began < 20


def test_html_text_clusters():
    """The smoothed ratios against a plain version, and what is in a cluster by definition."""
    rows = random.Random(5)
    for n in (1, 2, 3, 40):
        blocks = [html_text.Block("x" * rows.randint(1, 300), rows.randint(0, 4), 0, 0, "", 0, 0) for _ in range(n)]
        ratio = [len(b.text) / max(b.tags, 1) for b in blocks]
        kernel = {d: math.exp(-d * d / 2) for d in range(-2, 3)}
        mean = [sum(kernel[d] * ratio[i + d] for d in kernel if 0 <= i + d < n) / sum(kernel[d] for d in kernel if 0 <= i + d < n) for i in range(n)]
        assert np.allclose(html_text.smoothed(np.array(ratio)), mean)
        middle = sum(mean) / n
        threshold = min(middle, math.sqrt(sum((m - middle) ** 2 for m in mean) / n))
        assert [w > 0 for w in html_text.cluster_weights(blocks)] == [m >= threshold for m in mean]


def _order(row):
    return (row[0] is None, row[0] if row[0] is not None else 0)


def test_line_dedup(docs, listed, none):
    keyed = [r for r in listed if r[0] != 3]
    found = {(r.doc_id, r.n_lines): r for r in line_dedup.repeated_lines(docs.filter("doc_id is null or doc_id != 3")).collect()}
    earlier, expected = [], {}
    for doc_id, text, _ in sorted(keyed, key=_order):
        lines, gone = (text or "").split("\n"), []
        for i, line in enumerate(lines, 1):
            s = frozenset(words(line))
            if s:
                if any(len(s & e) / len(s | e) >= 0.8 for e in earlier):
                    gone.append(i)
                earlier.append(s)
        expected[(doc_id, len(lines))] = gone
    assert {k: r.removed for k, r in found.items()} == expected
    assert sum(map(len, expected.values())) >= 10
    kept = line_dedup.drop_lines(docs)
    assert kept.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert (0, BASE) in texts and (None, prose(20, 9)) in texts and not any(d == 1 for d, _ in texts)
    assert {(6, None), (7, ""), (8, "   "), (14, TEXTS[14])} <= texts
    assert line_dedup.repeated_lines(none).count() == 0 and line_dedup.drop_lines(none).count() == 0


def test_licences(spark, docs, none):
    model = licences.train()
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            p = model.probabilities("Copyright by Someone. " + text + " More words follow here.")
            assert model.classes[int(p.argmax())] == family, text
    for text in licences.OTHER:
        assert model.classes[int(model.probabilities(text).argmax())] == licences.UNKNOWN, text
    lines = ["plain words", "Released under the MIT License.", "", "He has a license.", "x " + licences.TEMPLATES["bsd"][2], "Licensed under the EUPL 1.2"]
    table = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, ""), (1, "\n".join(lines)), (4, "of the to")], "doc_id long, text string")
    found = licences.scan(table.withColumn("row", F.lit("clash"))).collect()
    expected = []
    for n, line in enumerate(lines, 1):
        p = model.probabilities(line)
        if model.classes[int(p.argmax())] != licences.UNKNOWN and p.max() >= 0.5:
            expected += [(1, n, model.classes[int(p.argmax())])] * 2
    assert sorted((r.doc_id, r.paragraph, r.family) for r in found) == sorted(expected) and len(expected) == 4
    assert all(math.isclose(r.probability, model.probabilities(lines[r.paragraph - 1]).max(), rel_tol=1e-6) and r.confirmed for r in found)
    assert licences.scan(docs).count() == 1 and licences.scan(none).count() == 0


def test_licences_wrapped(spark):
    """Notices wrapped at 72 columns are one paragraph; notices on a line are still found."""
    import textwrap

    wrapped = {f: textwrap.wrap(licences.TEMPLATES[f][i], 72) for f, i in (("mit", 3), ("bsd", 2), ("gpl", 1), ("lgpl", 1))}
    rows, expected = [], []
    for n, (family, lines) in enumerate(wrapped.items()):
        assert len(lines) > 1
        rows.append((n, "\n".join(["Plain words.", "", *lines, " * ", "More plain words."])))
        expected.append((n, 3, len(lines) + 2, family, True))
    lines = [*wrapped["mit"], "Released under the BSD 3-Clause License.", "", "Released under the MIT License.", *wrapped["mit"]]
    rows.append((9, "\r\n".join(lines)))
    n = len(wrapped["mit"])
    found = sorted((r.doc_id, r.paragraph, r.last_line, r.family, r.confirmed) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [f for f in found if f[0] < 9] == expected
    assert [f for f in found if f[0] == 9] == [(9, 1, n + 1, "mit", True), (9, n + 1, n + 1, "bsd", True), (9, n + 3, n + 3, "mit", True), (9, n + 3, 2 * n + 3, "mit", True)]


def test_licences_of_a_text_of_many_lines(spark):
    """The time follows the lines of a text and not their square; each notice is found in its place."""
    import time

    notice = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."
    block = [notice, "", "plain words of another kind", ""]
    took = {}
    for n in (2_000, 25_000):
        df = spark.createDataFrame([(1, "\n".join(block * n))], "doc_id long, text string")
        begin = time.time()
        found = licences.scan(df).filter("confirmed").select("paragraph", "last_line").collect()
        took[n] = time.time() - begin
        assert sorted(r.paragraph for r in found) == [4 * k + 1 for k in range(n)]
    assert took[25_000] < 40
