"""Main text of web pages by a site style tree.

Pass one merges the DOMs of a host: every block element is a node, named by the
path of its tags, classes and ids (long numbers masked). A page adds to each
node a hash of its presentation (the sequence of child tags) and of its content.
Grouped counts give each node's normalised entropies; its importance is the
larger of the two. A node is noise if at least ``LEAST_PAGES`` occurrences were
seen and the importance is below ``NOISE``: the same thing on page after page.

Pass two removes, from each page, branches that are noise in its host, and
branches whose tag, class, id or role says what they are (menus, headers,
footers, sidebars, notices, adverts, forms, comments): such a declared role is
importance 0 even where the wording changes from page to page. A class or id
says so by whole tokens (``sidebar``, ``cookie-notice``, ``site-footer``; not
``has-sidebar``), and never of an element that holds an ``article`` or ``main``
region; only comments, adverts, related links, ``nav``, ``aside`` and ``footer``
keep articles below them (teasers) unless the page has no other text. Ids of
headings, and of sections inside a region, are names of places, not of roles
(but for reader comments). An ``article`` or
``main`` region is declared importance 1: entropy never removes anything in it,
so an article that is published twice stays whole. Text outside such a region
stays too, unless its branch is noise by the tree or by declaration.

The noise of a host (a few paths) meets its pages in a join; the planner
broadcasts it only if its stored size is small, and splits hot hosts otherwise.

Blocks: text between block boundaries, character references decoded, runs of
white space one blank, trimmed; empty blocks go; joined by a line feed. ``<br>``
is white space.

Defined results: null or empty html and pages without text give the empty
string; a null or odd url has the host ''; unclosed or cut markup is read to its
end, as far as it is text; repeated rows are extracted alike (and count as
pages of the host); other columns are ignored.
"""

from __future__ import annotations

import functools
import html as references
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged

LEAST_PAGES = 8
NOISE = 0.2

# Fixed values of HTML: elements without text of the page, block and empty elements.
SKIPPED = frozenset("script style noscript template iframe object svg math canvas head button select "
                    "textarea datalist audio video map dialog".split())
RAW = frozenset("script style textarea iframe noscript title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("html body address article aside blockquote center dd details dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr caption ul".split())
#: Elements every page has, written or not; they are no branches.
ROOTS = frozenset(("html", "body"))
#: An opening tag ends an open element of these kinds (optional end tags).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}}
#: ... but not beyond the nearest of these.
FENCES = frozenset("ul ol dl table article section div body main aside nav header footer form blockquote".split())
NOT_TEXT = frozenset("nav footer aside form header menu".split())
#: Articles in these are teasers.
WITH_TEASERS = frozenset("nav footer aside".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
#: Words of a class or id that name a branch beside the article.
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar banner "
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies "
    "cookiebar consent notice gdpr popup modal overlay newsletter subscribe subscription signup login search comment comments "
    "disqus respond reply replies share sharing social related recommended recommendations widget pagination pager "
    "skip copyright legal".split())
#: The ones whose articles are comments and teasers.
NAMES_WITH_TEASERS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments "
    "disqus respond reply replies related recommended recommendations widget".split())
NAMES_OF_HEADERS = frozenset(("header", "masthead"))
NAMES_OF_COMMENTS = frozenset("comment comments disqus respond".split())
#: Words that leave the meaning of a token's other words.
NEUTRAL = frozenset("site box bar wrapper container list links buttons area body div form left right top bottom main "
                    "page user global mobile primary secondary sticky fixed".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Their header is a row or cell of the text.
TABLE_PARTS = frozenset("table thead tbody tr th td".split())
MAIN = frozenset(("article", "main"))
#: The same for an article or main element, which often names what it has beside it.
NAMES_OF_MAIN = frozenset("comment reply ad advert advertisement sponsored promo related recommended teaser".split())

_TOKEN = re.compile(
    r"<!--(?:.*?)(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d{3,}")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


@dataclass(slots=True)
class Node:
    """An open element."""

    tag: str
    at: int       # number of the nearest block element: itself or one around it
    main: bool    # inside article or main
    role: int     # 0: text of the page; 1: no text; 2: header of an article (headings stay)
    mark: int = -1  # nearest element around it, or itself, that is declared noise by name
    children: list[str] = field(default_factory=list)
    first: int = 0  # first block of it


@dataclass
class Page:
    """What a parse leaves: lists whose length is the number of elements or of blocks, however deep they nest."""

    #: (text, number of the block element it stands in, in main, kept by role)
    blocks: list[tuple[str, int, bool, bool]] = field(default_factory=list)
    #: Of each block element: number of the one around it, hash of the path of names to it.
    around: list[int] = field(default_factory=lambda: [-1])
    keys: list[int] = field(default_factory=lambda: [0])
    #: Closed block elements: (number, child tags, first block, block after the last, in main)
    nodes: list[tuple[int, str, int, int, bool]] = field(default_factory=list)


@functools.lru_cache(1 << 14)
def _names(token: str) -> frozenset[str]:
    """Words of a class or id if all of them name a branch, numbers and neutral words aside."""
    parts = _PART.findall(token)
    if sum(map(len, parts)) != len(token) - token.count("-") - token.count("_"):
        return frozenset()
    words = {w.lower() for w in parts if not w.isdigit()} - NEUTRAL
    return frozenset(words) if words <= NAMES | NAMES_OF_MAIN else frozenset()


def _role(tag: str, attrs: str, parent: Node) -> tuple[int, str, int, int]:
    """Declared role of an element, its name in a path, its mark (0: none; 1: noise unless it
    holds a region; 2: noise whose articles are teasers) and its region (0: none; 1: article; 2: main)."""
    role, name, mark = parent.role, tag, 0
    region = 2 if tag == "main" else int(tag == "article")
    if attrs:
        values: dict[str, str] = {}
        for k, a, b, c in _ATTR.findall(attrs):
            values.setdefault(k.lower(), a or b or c)
        classes, ids = values.get("class", "").split(), values.get("id", "").split()
        if classes or ids:
            name += "." + ".".join(sorted({_DIGITS.sub("#", x) for x in classes + ids}))
        said = values.get("role", "").lower()
        region = max(region, 2 if said == "main" else int(said == "article"))
        if "hidden" in values or _HIDDEN.search(values.get("style", "")) or values.get("aria-hidden") == "true":
            role = 1
        elif tag not in ROOTS:
            place = tag in HEADINGS or parent.main and (tag == "section" or "section" in classes)
            words = frozenset().union(*map(_names, classes if place else classes + ids))
            if place and tag not in HEADINGS:  # reader comments are no section of the text
                words |= frozenset().union(*map(_names, ids)) & NAMES_OF_COMMENTS
            if region:
                words = words & NAMES_OF_MAIN if region == 1 else frozenset()
            elif tag in HEADINGS or parent.main and tag in TABLE_PARTS:
                words = words - NAMES_OF_HEADERS
            elif parent.main and words and words <= NAMES_OF_HEADERS:
                role, words = role or 2, frozenset()
            if words or said in ROLES:
                mark = 2 if region or words & NAMES_WITH_TEASERS or said in ("navigation", "complementary") else 1
    if tag in SKIPPED:
        role = 1
    elif tag in NOT_TEXT:
        if tag == "header" and parent.main:
            role = role or 2
        else:
            mark = max(mark, 2 if tag in WITH_TEASERS else 1)
    elif role == 2 and tag in HEADINGS:
        role = 0
    return role, name, mark, region


#: Elements that the search for optional end tags has to look at.
_FIXED = FENCES | {"p", *(t for ends in ENDS.values() for t in ends)}


def parse(html: str) -> Page:
    """Blocks and elements of a page, in page order. Time and memory are linear in the page."""
    page = Page()
    stack = [Node("", 0, False, 0)]
    open_tags: Counter[str] = Counter()
    fixed: list[int] = []  # places of the elements in _FIXED on the stack
    parts: list[str] = []
    marks: list[list[int]] = []  # declared noise: mark, 1 or 2 if it holds an article or main, the mark around it
    found: list[tuple[str, int, bool, bool, int]] = []

    def flush() -> None:
        if parts:
            top = stack[-1]
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append((text, top.at, top.main, top.role == 0, top.mark))

    def close() -> None:
        node = stack.pop()
        open_tags[node.tag] -= 1
        if fixed and fixed[-1] == len(stack):
            fixed.pop()
        if node.tag in BLOCKS and node.tag not in ROOTS:
            page.nodes.append((node.at, " ".join(node.children), node.first, len(found), node.main))

    def text(raw: str) -> None:
        if raw:
            parts.append(references.unescape(raw))

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # end tag
            if open_tags[tag] > 0:
                if tag in BLOCKS:
                    flush()
                while stack[-1].tag != tag:
                    if stack[-1].tag in BLOCKS:
                        flush()
                    close()
                close()
            continue
        if not m[4]:
            break  # a tag cut off at the end of the page
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            flush()
            ends = ENDS.get(tag, frozenset()) | {"p"}
            for k in reversed(fixed):
                if stack[k].tag in ends:
                    while len(stack) > k:
                        close()
                    break
                if stack[k].tag in FENCES:
                    break
            stack[-1].children.append(tag)
        parent = stack[-1]
        role, name, mark, region = _role(tag, m[3], parent)
        number = parent.at
        if tag in BLOCKS and tag not in ROOTS:
            number = len(page.around)
            page.around.append(parent.at)
            page.keys.append(xxhash.xxh64_intdigest(name, page.keys[parent.at]))
        if role == 1 or mark:
            region = 0
        node = Node(tag, number, parent.main or region > 0, role, parent.mark, first=len(found))
        if region:
            k = parent.mark  # marks further out hold at least what those inside hold
            while k >= 0 and marks[k][1] < region:
                marks[k][1] = region
                k = marks[k][2]
        if mark:
            node.mark = len(marks)
            marks.append([mark, 0, parent.mark])
        if tag in RAW:  # its content is no markup
            end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(html, at)
            stop = end.start() if end else size
            at = html.find(">", stop) + 1 if end and html.find(">", stop) >= 0 else size
            continue
        if not m[3].endswith("/") or tag in BLOCKS:
            if tag in _FIXED:
                fixed.append(len(stack))
            stack.append(node)
            open_tags[tag] += 1
    flush()
    while len(stack) > 1:
        close()

    def kept(noisy: list[bool]) -> list[tuple[str, int, bool, bool]]:
        return [(text, number, main, ok and not (k >= 0 and noisy[k])) for text, number, main, ok, k in found]

    page.blocks = kept(_below(marks, lambda mark, holds: holds < mark))
    if marks and not any(ok for *_, ok in page.blocks):  # the articles are the only text
        page.blocks = kept(_below(marks, lambda mark, holds: holds < mark and not holds))
    return page


def _below(marks: list[list[int]], is_noise: Callable[[int, int], bool]) -> list[bool]:
    """Whether a mark, or one around it, is noise."""
    out: list[bool] = []
    for mark, holds, outer in marks:
        out.append(is_noise(mark, holds) or outer >= 0 and out[outer])
    return out


_SPREAD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def content_hashes(page: Page) -> list[int]:
    """Hash of the texts inside each of ``page.nodes``, from one running hash over all blocks."""
    run, power = [0], [1]
    for block in page.blocks:
        run.append((run[-1] * _SPREAD + xxhash.xxh64_intdigest(block[0])) & _MASK)
        power.append(power[-1] * _SPREAD & _MASK)
    return [(run[last] - run[first] * power[last - first]) & _MASK for _, _, first, last, _ in page.nodes]


def _signed(h: int) -> int:
    return h - (1 << 63)


def main_text(page: Page, noise: frozenset[int]) -> str:
    """Blocks left when noise branches go."""
    noisy = [False] * len(page.around)
    if noise:
        for i in range(1, len(noisy)):
            noisy[i] = noisy[page.around[i]] or _signed(page.keys[i]) in noise
    return "\n".join(text for text, number, main, ok in page.blocks if ok and (main or not noisy[number]))


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, seen, content, presentation): entropies of every node of every host."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, node, kind, mark = [], [], [], []
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = parse(text)
                for (number, children, _, _, main), content in zip(page.nodes, content_hashes(page), strict=True):
                    if main:
                        continue  # declared importance
                    for what, value in ((0, content), (1, xxhash.xxh64_intdigest(children))):
                        host.append(h), node.append(_signed(page.keys[number])), kind.append(what)
                        mark.append(_signed(value))
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(node, pa.int64()), pa.array(kind, pa.int32()),
                 pa.array(mark, pa.int64())], ["host", "node", "kind", "mark"])

    rows = pages.select(_host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    counts = (rows.mapInArrow(run, "host string, node long, kind int, mark long")
              .groupBy("host", "node", "kind", "mark").agg(F.count("*").alias("c")))
    # H = log n - sum(c log c) / n, over log n: 0 for one style or text, 1 if all differ
    n = F.sum("c")
    h = 1 - F.sum(F.col("c") * F.log("c")) / (n * F.log(n.cast("double")))
    return (counts.groupBy("host", "node", "kind").agg(n.alias("n"), F.when(n > 1, h).otherwise(1.0).alias("h"))
            .groupBy("host", "node").agg(F.max("n").alias("seen"),
                                         F.max(F.when(F.col("kind") == 0, F.col("h"))).alias("content"),
                                         F.max(F.when(F.col("kind") == 1, F.col("h"))).alias("presentation")))


def noise_nodes(tree: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = NOISE) -> DataFrame:
    """(host, noise): hashes of the paths whose importance is low."""
    low = tree.where((F.col("seen") >= least_pages) & (F.greatest("content", "presentation") < threshold))
    # one entry per element path of a site's templates
    return low.groupBy("host").agg(F.collect_set("node").alias("noise"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    noise = staged(noise_nodes(style_tree(pages)), "style_noise")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                         F.coalesce("html", F.lit("")).alias("html"), _host(F.col("url")).alias("host"))
            .join(noise, "host", "left").select("page_id", "url", "html", "noise"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(parse(h), frozenset(x or ()))
                   for h, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
