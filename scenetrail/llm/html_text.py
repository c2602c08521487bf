"""Main text of web pages.

The standard library's parser gives events; text is gathered into blocks (lines). Each block has its text-to-tag ratio,
links left out; the ratios of a page are smoothed by a Gaussian, and blocks above a threshold form clusters. Main, an
article element, or else the innermost container that holds the cores of all clusters holds the article. Of what it holds
besides, regions without a core that are mostly links, or lie before the title or behind all cores, do not belong to it, whatever
their names. Elements that are never article text (menus, scripts and so on) go beforehand, and so do a form or an element
whose class, id or role says so, unless it is, or holds, the article or most of the text of the clusters. A dropped
element inside a line does not end the line. The time for a page grows with its length, whatever stays open.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import arrow_function, boxed, query, table, unboxed

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul".split()
)
DROPPED = frozenset(
    "head title script style noscript template nav footer aside button select textarea input fieldset iframe object embed "
    "svg canvas audio video menu dialog search".split()
)
# What may stand in a head; anything else ends it, because its end tag can be left out.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body main article section div td blockquote".split())
LISTS = frozenset("ul ol dl table".split())
INLINE_GAPS = frozenset("br td th img wbr".split()) - {"wbr"}
# An open one of these ends where the same, or one of its group, begins.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

# Names in a class, an id or a role that mark an element as no article text; whole names count, not their parts.
_SURE_TOPICS = "comment comments ad ads advert adverts advertisement advertising cookie cookies cookie-consent gdpr consent".split()
_TOPICS = (
    "sponsor sponsored promo promotion banner sidebar rail nav navbar navigation menu toolbar breadcrumb breadcrumbs pagination related recommended share sharing social newsletter subscribe subscription "
    "signup login search popup modal"
).split()
_PARTS = "area banner bar block box buttons container form icons links list menu message notice overlay panel popup section unit widget wrap wrapper".split()
SURE = (  # said of no article: comments, adverts, cookies
    frozenset(_SURE_TOPICS)
    | {f"{topic}-{part}" for topic in _SURE_TOPICS for part in _PARTS}
    | frozenset("commentlist post-comments respond replies disqus disqus-thread advertorial adsbygoogle ad-slot".split())
)
MARKS = (
    SURE
    | frozenset(_TOPICS)
    | {f"{topic}-{part}" for topic in _TOPICS for part in _PARTS}
    | frozenset(
        "promoted notice notices alert overlay side-bar left-sidebar right-sidebar primary-sidebar secondary-sidebar "
        "main-nav site-nav top-nav primary-nav main-navigation site-navigation primary-navigation main-menu primary-menu nav-links pager header masthead "
        "site-header footer site-footer page-footer related-posts related-articles recommended-posts share-this social-share widget widgets widget-area "
        "skip skip-link contentinfo complementary".split()
    )
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# The first or last part of a name that says the same as a sure one, unless another end of the name only tells a state.
_SURE_ENDS = frozenset(_SURE_TOPICS) | frozenset("reactions replies".split())
_STATES = frozenset("no has have with without show hide hidden is not open closed on off enabled disabled free".split())


def _surely(name: str) -> bool:
    parts = name.split("-")
    ends = {parts[0], parts[-1]}
    return name in SURE or len(parts) > 1 and bool(ends & _SURE_ENDS) and not ends & _STATES


class Block(NamedTuple):
    text: str
    tags: int
    container: int
    mark: int  # innermost
    prose: str  # the element, if a paragraph or heading
    linked: int  # characters inside links
    links: int


class Open(NamedTuple):
    name: str
    container: int
    dropped: bool
    mark: int
    prose: str  # the open paragraph or heading of the innermost container
    near: dict[str, int]  # where the last open one of each name of CLOSED_BY stands, in the innermost container or list


_NOTHING = Open("", 0, False, 0, "", {})


class PageBlocks(HTMLParser):
    """Blocks of a page without those that are never article text.

    A mark is an open form, or an element marked by its names; whether its text goes is told at the end of the page. What an
    event needs to know of the open elements is kept with the innermost one, so a page takes time in proportion to its length.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.count: Counter[str] = Counter()  # open elements by name
        self.blocks: list[Block] = []
        self.parents: list[int] = [0]  # of each container; numbers grow in page order
        self.elements: list[tuple[str, str]] = [("", "")]  # of each container: its element and class
        self.marks: list[int] = [0]  # of each mark: the one around it
        self.kinds: list[str] = [""]
        self.titled: list[int] = []  # the innermost mark of each top heading
        self.articles: list[tuple[int, int]] = []  # of each article or main: its container, its innermost mark
        self.text: list[str] = []
        self.tags = self.linked = self.links = 0
        self.head = 0

    def _state(self) -> Open:
        return self.open[-1] if self.open else _NOTHING

    def finish_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            state = self._state()
            self.blocks.append(Block(text, self.tags, state.container, state.mark, state.prose, min(self.linked, len(text)), self.links))
        self.text, self.tags, self.linked, self.links = [], 0, 0, 0

    def _close(self, at: int) -> None:
        outer = self.open[at - 1].mark if at else 0
        if self.open[-1].mark != outer or any(o.name in BLOCKS for o in self.open[at:]):
            self.finish_block()
        while len(self.open) > at:
            self.count[self.open.pop().name] -= 1

    def _end_head(self, tag: str) -> None:
        """End an open head, and what is open in it, where an element begins that may not stand in it.

        A noscript or template in a head may hold any element; only a body ends these too.
        """
        if self.count["head"] and tag not in HEAD and (tag == "body" or not (self.count["noscript"] or self.count["template"])):
            self._close(self.head)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._state().dropped:
            self._end_head(tag)
        ended = [at for name, at in self._state().near.items() if tag in CLOSED_BY[name]]
        if ended:
            self._close(max(ended))
        if tag in BLOCKS:
            self.finish_block()
        elif tag in INLINE_GAPS:
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        state = self._state()
        names = dict(attrs)
        kind = "" if state.dropped else self._kind(tag, names)
        inline = tag not in BLOCKS and tag not in CONTAINERS and bool(state.prose)
        drop = state.dropped or self._drops(tag, names) or inline and kind == "sure"
        mark = state.mark
        if kind and not drop and not inline:
            self.finish_block()
            self.marks.append(mark)
            self.kinds.append(kind)
            mark = len(self.marks) - 1
        container, prose, near = state.container, state.prose, state.near
        if tag in CONTAINERS:
            self.parents.append(container)
            self.elements.append((tag, names.get("class") or ""))
            container, prose, near = len(self.parents) - 1, "", {}
        elif tag in LISTS:
            near = {}
        elif tag in PROSE:
            prose = tag
        if tag in CLOSED_BY:
            near = near | {tag: len(self.open)}
        if tag == "h1" and not drop:
            self.titled.append(mark)
        elif tag in ("article", "main") and not drop:
            self.articles.append((container, mark))
        elif tag == "head" and not self.count["head"]:
            self.head = len(self.open)
        if tag == "a" and not drop:
            self.links += 1
        self.count[tag] += 1
        self.open.append(Open(tag, container, drop, mark, prose, near))

    def _in_article(self) -> bool:
        return bool(self.count["article"] or self.count["main"])

    def _drops(self, tag: str, attrs: dict) -> bool:
        if tag in DROPPED or tag == "label" and "for" in attrs:
            return True
        if tag in ("html", "body", "main"):
            return False
        if tag == "header":
            return not self._in_article()
        return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style") or ""))

    def _kind(self, tag: str, attrs: dict) -> str:
        """Of the mark that begins with an element: sure, likely, or none."""
        if tag in ("html", "body", "main", "header"):
            return ""
        names = {n for k in ("class", "id", "role") for n in (attrs.get(k) or "").lower().replace("_", "-").split()}
        if any(map(_surely, names)):
            return "sure"
        names &= MARKS
        return "likely" if tag == "form" or names - {"header"} or names and not self._in_article() else ""

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.count[tag]:
            at = len(self.open) - 1
            while self.open[at].name != tag:
                at -= 1
            self._close(at)
        elif tag in BLOCKS:
            self.finish_block()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].name == "head" and data.strip(" \t\n\f\r"):
            self._close(len(self.open) - 1)
        if self._state().dropped:
            return
        self.text.append(data)
        if self.count["a"]:
            self.linked += len(data.strip())

    def ended(self) -> list[Block]:
        self.close()
        self.finish_block()
        return self.blocks


class Tree:
    """Containers or marks, numbered in page order, with the last one inside each."""

    def __init__(self, parents: list[int]):
        self.parents, self.last = parents, list(range(len(parents)))
        for n in range(len(parents) - 1, 0, -1):
            self.last[parents[n]] = max(self.last[parents[n]], self.last[n])

    def within(self, n: int, top: int) -> bool:
        return top <= n <= self.last[top]

    def above(self, n: int) -> Iterator[int]:
        while n:
            yield n
            n = self.parents[n]

    def common(self, nodes: Iterable[int]) -> int:
        """The innermost one that holds all of some."""
        nodes = list(nodes)
        top, last = min(nodes, default=0), max(nodes, default=0)
        while self.last[top] < last:
            top = self.parents[top]
        return top

    def sums(self, values: Iterable[tuple[int, float]]) -> np.ndarray:
        """Of all values inside each."""
        found = np.zeros(len(self.parents))
        for n, value in values:
            found[n] += value
        for n in range(len(found) - 1, 0, -1):
            found[self.parents[n]] += found[n]
        return found

    def inside(self, tops: Iterable[int]) -> list[bool]:
        """Whether each is one of some, or in one."""
        tops, found = set(tops), []
        for n, parent in enumerate(self.parents):
            found.append(n in tops or n > 0 and found[parent])
        return found


def smoothed(ratio: np.ndarray, width: float = 1.0) -> np.ndarray:
    """A Gaussian mean over neighbouring blocks."""
    reach = int(np.ceil(2 * width))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[reach : reach + len(ratio)]
    return np.convolve(ratio, kernel, "full")[reach : reach + len(ratio)] / weight


def _sizes(blocks: list[Block]) -> np.ndarray:
    """Characters of each block outside links, or all where a page has links only."""
    free = np.array([len(b.text) - b.linked for b in blocks], float)
    return free if free.any() else np.array([len(b.text) for b in blocks], float)


def cluster_weights(blocks: list[Block]) -> np.ndarray:
    """Characters outside links of each block that is in a cluster, 0 for the others."""
    size = _sizes(blocks)
    smooth = smoothed(size / np.maximum([b.tags for b in blocks], 1))
    chosen = smooth >= min(smooth.std(), smooth.mean())  # the usual threshold, never above the mean
    return size * chosen


def cluster_cores(blocks: list[Block]) -> np.ndarray:
    """The blocks of clusters that are no links and whose own ratio is a third of the mean of the page's characters at least."""
    size, weight = _sizes(blocks), cluster_weights(blocks)
    ratio = size / np.maximum([b.tags for b in blocks], 1)
    core = (weight > 0) & (2 * size >= [len(b.text) for b in blocks]) & (3 * ratio >= np.average(ratio, weights=size))
    return core if core.any() else weight > 0


def main_text(html: str | None) -> str:
    """Text of the article, one line a block; empty for a null, an empty page and a page without one."""
    if not html:
        return ""
    page = PageBlocks()
    page.feed(html)
    blocks = page.ended()
    if not blocks:
        return ""
    if len(page.marks) > 1:
        gone = Tree(page.marks).inside(_gone(page, blocks))
        blocks = [b for b in blocks if not gone[b.mark]]
    return "\n".join(b.text for b, kept in zip(blocks, _article(page, blocks)) if kept)


def _gone(page: PageBlocks, blocks: list[Block]) -> set[int]:
    """The marks whose text goes.

    A likely mark stays if it holds most of the text of the clusters, or is or holds the article: the article element with
    most of that text, a quarter at least. A sure one must hold most of that text and, besides, all top headings or, directly,
    all articles of the page. Marks stay if no cluster would be left without them.
    """
    weight, tree = cluster_weights(blocks), Tree(page.marks)

    def held(skipped: set[int]) -> np.ndarray:
        out = tree.inside(skipped)
        return tree.sums((b.mark, w) for b, w in zip(blocks, weight) if not out[b.mark])

    share = held(set())
    title = tree.common(page.titled)
    direct = {mark for _, mark in page.articles}
    sure = set()
    for m in range(1, len(page.marks)):
        told = page.titled and tree.within(title, m) or direct == {m}
        if page.kinds[m] == "sure" and not (share[m] == share[0] or told and share[m] > 0.5 * share[0]):
            sure.add(m)
    share, out = held(sure), tree.inside(sure)
    if not share[0]:
        return set()
    text = Tree(page.parents).sums((b.container, w) for b, w in zip(blocks, weight) if not out[b.mark])
    articles = [(text[c], -c, mark) for c, mark in page.articles if page.elements[c][0] == "article" and text[c] >= 0.25 * share[0]]
    spared = set(tree.above(max(articles)[2])) if articles else set()
    likely = {m for m in range(1, len(page.marks)) if page.kinds[m] == "likely" and m not in spared and share[m] <= 0.5 * share[0]}
    return sure | likely if held(sure | likely)[0] else sure


def _article(page: PageBlocks, blocks: list[Block]) -> list[bool]:
    """Whether each block belongs to the article.

    Cores of clusters count, those in article elements alone if these hold half of them. The root is main, an article
    element, or else the innermost container that holds all cores and, without a top heading in it, those of the page;
    it grows while paragraphs or headings that are no links stand before the cores directly beside it. Inside the root, a
    region is a container without a core or top heading. A region goes if it is mostly links (three at least inside an article
    element), and, outside article elements, if it comes before the top heading or after all cores, unless a container
    beside it of the same element and class has a core. Blocks that stand by themselves beside the containers of the cores,
    outside main and article, go if they are mostly links or come after all cores.
    """
    tree = Tree(page.parents)
    in_article = tree.inside(c for c, (name, _) in enumerate(page.elements) if name == "article")
    core, size = cluster_cores(blocks), _sizes(blocks)
    headed = [b.prose == "h1" for b in blocks]
    inner = np.array([in_article[b.container] for b in blocks]) & core
    if inner.any() and 2 * size[inner].sum() >= size[core].sum():
        core = inner
    first, last = int(core.argmax()), len(core) - 1 - int(core[::-1].argmax())
    root = tree.common(b.container for b, c in zip(blocks, core) if c)
    named = {page.elements[c][0]: c for c in tree.above(root) if page.elements[c][0] in ("article", "main")}  # outermost ones
    if named:
        root = named.get("main", named.get("article", root))
    else:
        titles = [b.container for b, h in zip(blocks, headed) if h]
        if not any(tree.within(c, root) for c in titles):
            root = tree.common([root, *titles])
    if "main" not in named and "article" not in named:
        beside = {b.container for b in blocks[:first] if b.prose and 2 * b.linked <= len(b.text)}
        for c in list(tree.above(root)):
            if page.parents[c] in beside:
                root = page.parents[c]
    elif "main" not in named:
        outside = [b.container for b, h in zip(blocks, headed) if h]
        if not any(tree.within(c, root) for c in outside):
            root = tree.common([root, *outside])
    top = min((at for at, h in enumerate(headed) if h and tree.within(blocks[at].container, root)), default=-1)
    cores = tree.sums((b.container, float(c)) for b, c in zip(blocks, core))
    direct = {b.container for b, c in zip(blocks, core) if c}
    solid = tree.sums((b.container, float(c or h)) for b, c, h in zip(blocks, core, headed))
    length = tree.sums((b.container, float(len(b.text))) for b in blocks)
    linked = tree.sums((b.container, float(b.linked)) for b in blocks)
    links = tree.sums((b.container, float(b.links)) for b in blocks)
    alike = {(page.parents[c], page.elements[c]) for c in range(1, len(page.parents)) if cores[c]}
    region = [0] * len(page.parents)  # the outermost container without a core or top heading, below the root
    for c in range(1, len(region)):
        if not solid[c] and c != root:
            region[c] = region[page.parents[c]] or c

    def belongs(at: int, b: Block) -> bool:
        if not tree.within(b.container, root):
            return False
        if core[at] or headed[at]:
            return True
        r = region[b.container]
        if not r:
            if b.container in direct or in_article[b.container] or "main" in named:
                return True
            return at < last and 2 * b.linked <= len(b.text)
        if page.elements[r][0] != "blockquote" and 2 * linked[r] > length[r] and (links[r] > 2 or not in_article[r]):
            return False
        if in_article[r] or (page.parents[r], page.elements[r]) in alike:
            return True
        return top < at < last if top < first else at < last

    return [belongs(at, b) for at, b in enumerate(blocks)]


def extract(html: Column | str) -> Column:
    """Main text of a column of pages."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py()) for page in batch], pa.string())

    return arrow_function(run, "string")(html)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points) instead of the markup.

    Null, empty and markup-only pages give an empty text. Equal pages give equal texts. Columns of ``pages`` with the
    names of the results are replaced.
    """
    rows = boxed(pages).withColumn("_text", extract(F.col("_row").getField(html)))
    kept = [c for c in pages.columns if c != html]
    return unboxed(rows, kept, text=F.col("_text"), n_chars=F.char_length("_text").cast("bigint"))


@query("op8_html_text")
def op8_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages)
