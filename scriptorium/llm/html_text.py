"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at its block-level tags. A block is described by its words and link density, those
of the blocks before and behind it, and where it stands (inside what pages use for menus, notices and the like; inside an
article). A small decision tree, trained on the labelled table below when a task starts, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements that end a block of text, elements whose content is never shown as text, and elements that
# pages use for what is not the article.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
RAW_TAGS = "script|style|noscript|template|iframe|textarea|title"
#: Elements whose content is no article text as long as no block begins in them; one that is not closed before is an ordinary tag.
INLINE_RAW_TAGS = "svg|math|button|select|canvas|audio|video"
BREAKS = "p|div|article|section|main|h[1-6]|ul|ol|li|table|blockquote|body|header|footer|nav|aside|form"
SIDE_TAGS = frozenset("nav header footer aside form menu dialog search".split())
MAIN_TAGS = frozenset("article main".split())
VOID_TAGS = frozenset("hr br img input meta link area base col embed source track wbr".split())
#: Words in class, id and role by which pages name what is not the article, and what is.
SIDE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pagination pager paywall popup promo promotion related remark remarks replies reply respond "
    "search share sharing sidebar sidenav sitemap skip social sponsor sponsored sponsors subscribe tags toolbar topbar widget widgets".split()
)
MAIN_WORDS = frozenset("article articlebody body content entry main post story".split())
#: Words that may stand beside those in one name (``site-header``, ``comments-area``); other company makes it a name of something else
#: (``has-sidebar``, ``header-image``, ``social-science``).
COMPANY_WORDS = frozenset(
    "area bar block bottom box column container content footer global group head holder inner item items left link links list main "
    "nav outer page panel post primary region right row secondary section site slot small text top unit user wrap wrapper".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<shut>svg|math)(?=[\s/>])[^>]*/>"
    rf"|<(?P<inline>{INLINE_RAW_TAGS})(?=[\s/>])[^>]*>(?:[^<]++|<(?!/?(?:{BREAKS})[\s/>])(?!/(?P=inline)\s*>))*+</(?P=inline)\s*>"
    rf"|<(?P<raw>{RAW_TAGS})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?>\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

COLUMNS = "words links before before_links after after_links side main has_main heading"
#: Labelled blocks: the columns above, then 1 for main text. Words and link densities of a block and its neighbours, whether it
#: stands in a side element, in an article, on a page that has one, and whether it is a heading.
LABELLED = """
  1 1.00   0 0.00   1 1.00 1 0 1 0 0
  2 1.00   1 1.00   3 1.00 1 0 0 0 0
  9 0.00   1 1.00  12 0.00 1 0 1 0 0
 14 0.10   6 1.00  40 0.00 1 0 0 0 0
 40 0.00   2 1.00  11 0.00 1 0 1 0 0
 85 0.02  12 0.00  90 0.00 1 0 0 0 0
 10 0.00 120 0.00   0 0.00 1 0 1 0 0
 30 0.00 120 0.00   0 0.00 1 0 0 0 0
 22 0.00  80 0.00  25 0.00 1 1 1 0 0
 60 0.00  30 0.00  45 0.00 1 1 1 0 0
  6 0.00  70 0.00  22 0.00 1 1 1 1 0
  3 1.00  50 0.00  60 0.00 1 1 1 0 0
 12 0.00   5 1.00  60 0.00 0 1 1 1 1
  4 0.00   8 0.00  80 0.00 0 1 1 1 1
  9 0.00  75 0.00  90 0.00 0 1 1 1 1
  1 0.00  60 0.00  20 0.00 0 1 1 0 1
  3 0.00   2 0.00   4 0.00 0 1 1 0 1
  8 0.00  12 0.00  11 0.00 0 1 1 0 1
 15 0.20  40 0.00  50 0.05 0 1 1 0 1
 35 0.00  12 0.00  44 0.00 0 1 1 0 1
 70 0.00  35 0.00   0 0.00 0 1 1 0 1
110 0.05  70 0.00  95 0.00 0 1 1 0 1
240 0.00  12 0.00  10 0.00 0 1 1 0 1
 20 0.45  60 0.00  70 0.00 0 1 1 0 1
  5 0.60  45 0.00  30 0.00 0 1 1 0 1
 12 0.00   4 1.00  30 0.20 0 1 1 1 1
  4 0.00  60 0.00   5 1.00 0 1 1 0 1
 16 0.00  20 0.30  12 0.60 0 1 1 0 1
 28 0.00  10 0.00   3 1.00 0 1 1 0 1
 33 0.25   6 1.00   8 0.50 0 1 1 0 1
 48 0.00  44 0.10   9 0.90 0 1 1 0 1
  2 0.00   9 0.00  14 0.40 0 1 1 0 1
 65 0.10  12 0.00   4 1.00 0 1 1 0 1
  9 0.30  70 0.20   2 1.00 0 1 1 0 1
  6 0.00   5 1.00   7 1.00 0 1 1 0 1
  7 1.00  90 0.00   6 1.00 0 1 1 0 0
  4 1.00  80 0.00  40 0.00 0 1 1 0 0
  3 1.00   4 1.00   5 1.00 0 1 1 0 0
  2 1.00  60 0.00   2 1.00 0 1 1 0 0
  6 0.00   1 1.00  12 0.00 0 0 1 0 0
 14 0.00   2 1.00  60 0.00 0 0 1 0 0
 25 0.00  90 0.00  12 0.00 0 0 1 0 0
 60 0.00  10 0.00  80 0.00 0 0 1 0 0
120 0.00  40 0.10  30 0.00 0 0 1 0 0
  5 1.00   4 1.00   6 1.00 0 0 1 0 0
  8 0.00  12 0.00  70 0.00 0 0 1 1 0
 44 0.00  12 0.00   3 1.00 0 0 1 0 0
 80 0.10   2 1.00   5 1.00 0 0 1 0 0
 30 0.00   5 0.00   6 0.50 0 0 1 0 0
 12 0.00  70 0.00   4 1.00 0 0 1 0 0
 70 0.00  60 0.00  50 0.20 1 0 0 0 0
 90 0.00  80 0.00   3 1.00 1 1 1 0 0
 45 0.10  10 0.50   8 1.00 1 0 1 0 0
 25 0.00   6 0.00   2 1.00 1 0 0 0 0
  7 0.00  60 0.00   9 1.00 1 1 1 1 0
  3 1.00   2 1.00   4 1.00 0 0 0 0 0
  4 1.00  70 0.00  80 0.00 0 0 0 0 0
 10 0.90  40 0.00  35 0.00 0 0 0 0 0
  8 1.00  20 0.00   7 1.00 0 0 0 0 0
 18 0.80   6 1.00  20 0.70 0 0 0 0 0
 25 0.60  30 0.50  40 0.00 0 0 0 0 0
 12 0.50  70 0.00   8 0.90 0 0 0 0 0
  2 0.00   3 1.00   4 1.00 0 0 0 0 0
  5 0.00   2 0.00   3 1.00 0 0 0 0 0
  7 0.00   4 0.00   0 0.00 0 0 0 0 0
  9 0.00  10 0.50   6 0.00 0 0 0 0 0
  4 0.00   0 0.00   6 1.00 0 0 0 0 0
 11 0.00   3 1.00   8 0.20 0 0 0 0 0
  6 0.00   5 1.00  80 0.00 0 0 0 1 1
  9 0.00  60 0.00  75 0.00 0 0 0 1 1
  3 0.00  90 0.00  55 0.00 0 0 0 1 1
  5 0.00  48 0.00  62 0.00 0 0 0 0 1
 10 0.05  80 0.00  66 0.00 0 0 0 0 1
  8 0.00 120 0.00  42 0.00 0 0 0 0 1
 18 0.00  60 0.00  40 0.00 0 0 0 0 1
 22 0.00  35 0.00   8 0.00 0 0 0 0 1
 26 0.10  12 0.00  70 0.00 0 0 0 0 1
 40 0.00   6 0.00  28 0.00 0 0 0 0 1
 55 0.15   9 0.00  60 0.00 0 0 0 0 1
 75 0.00   4 1.00  80 0.00 0 0 0 0 1
 90 0.20  70 0.00   5 1.00 0 0 0 0 1
150 0.05   8 0.00   3 1.00 0 0 0 0 1
 20 0.00   1 1.00   2 1.00 0 0 0 0 1
 24 0.00   0 0.00   1 1.00 0 0 0 0 1
 30 0.20   2 1.00   6 1.00 0 0 0 0 1
 36 0.10  40 0.00   4 1.00 0 0 0 0 1
 21 0.00   2 1.00   0 0.00 0 0 0 0 1
 16 0.00  50 0.00  20 0.60 0 0 0 0 1
  8 0.00  50 0.00   3 1.00 0 0 0 0 0
  6 0.00   3 1.00  12 0.80 0 0 0 0 0
 10 0.00   9 0.00   8 0.00 0 0 0 0 0
  5 0.00  80 0.00   2 1.00 0 0 0 0 0
 12 0.00   4 1.00   5 1.00 0 0 0 0 0
"""


@dataclass
class Node:
    """A leaf, or a test ``value[column] <= limit`` with its two branches."""

    label: int
    column: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def __call__(self, value: list[float]) -> int:
        node = self
        while node.column >= 0:
            node = node.low if value[node.column] <= node.limit else node.high
        return node.label


def grow(rows: list[list[float]], depth: int = 7) -> Node:
    """A decision tree on rows whose last value is the label, by the largest fall in Gini impurity; ties go to the first column."""
    ones = sum(row[-1] for row in rows)
    leaf = Node(int(2 * ones > len(rows)))
    if not depth or ones in (0, len(rows)):
        return leaf
    best = (_impurity(rows) - 1e-9, -1, 0.0)
    for column in range(len(rows[0]) - 1):
        values = sorted({row[column] for row in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            parts = [[r for r in rows if r[column] <= limit], [r for r in rows if r[column] > limit]]
            left = sum(_impurity(p) * len(p) for p in parts) / len(rows)
            if left < best[0] - 1e-12:
                best = (left, column, limit)
    if best[1] < 0:
        return leaf
    _, column, limit = best
    low, high = [r for r in rows if r[column] <= limit], [r for r in rows if r[column] > limit]
    return Node(leaf.label, column, limit, grow(low, depth - 1), grow(high, depth - 1))


def _impurity(rows: list[list[float]]) -> float:
    p = sum(row[-1] for row in rows) / len(rows)
    return 2 * p * (1 - p)


def labelled_rows() -> list[list[float]]:
    return [[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()]


@dataclass
class Block:
    text: str
    words: int
    links: float
    side: bool
    main: bool
    heading: bool


def blocks(page: str) -> Iterator[Block]:
    """Flat text blocks in page order, references decoded and white space collapsed; empty ones are left out."""
    open_tags: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    linked, in_link, in_head, heading = 0, False, False, False

    def flush() -> Iterator[Block]:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text and not in_head:
            words = len(text.split(" "))
            yield Block(text, words, min(1.0, linked / words), any(t[1] for t in open_tags), any(t[2] for t in open_tags), heading)
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.split())

    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        closing, rest = bool(token["close"] or token["close2"]), token["rest"] or token["rest2"] or ""
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            add(" ")
        if token["raw"] or token["inline"] or token["shut"]:
            add(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        yield from flush()
        if tag == "head":
            in_head = not closing
        elif tag == "body":
            in_head = False
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            heading = not closing
        elif tag in VOID_TAGS:
            continue
        elif closing:
            heading = False
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    del open_tags[i:]
                    break
        elif tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "html", "head") or rest.strip():
            open_tags.append((tag, *_place(tag, rest)))
    if at < len(page):
        add(page[at:])
    yield from flush()


def _is_side(name: str) -> bool:
    """Whether a class, id or role names what is not the article: a word of the list, alone or beside words that do not change it."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return any(w in SIDE_WORDS for w in words) and all(w in SIDE_WORDS or w in COMPANY_WORDS for w in words)


def _place(tag: str, rest: str) -> tuple[bool, bool]:
    """(side, main) of an element by its name and by the names it is given; elements for the article are not taken away by a name."""
    names = [n for m in NAMES.finditer(rest) for n in (m[1] or m[2] or m[3] or "").lower().split()] if rest else []
    named = tag not in MAIN_TAGS and tag not in ("body", "html") and any(map(_is_side, names))
    side = tag in SIDE_TAGS or named or (bool(rest) and bool(HIDDEN.search(rest)))
    words = {w for n in names for w in re.split(r"[^a-z]+", n)}
    return side, tag in MAIN_TAGS or (tag in ("div", "section") and bool(words & MAIN_WORDS) and not side)


@lru_cache(1)
def trained() -> Node:
    """The tree, grown once in a worker."""
    return grow(labelled_rows())


def main_text(page: str, tree: Node) -> str:
    """The blocks that the tree takes for main text, joined by line ends."""
    found = list(blocks(page))
    has_main = float(any(b.main and not b.side for b in found))
    edge = Block("", 0, 0.0, False, False, False)
    out = []
    for before, b, after in zip([edge, *found], found, [*found[1:], edge]):
        value = [b.words, b.links, before.words, before.links, after.words, after.links, b.side, b.main, has_main, b.heading]
        if tree([float(x) for x in value]):
            out.append(b.text)
    return "\n".join(out)


def text_of(page: Column | str) -> Column:
    """The main text of a page's html; null counts as empty, and a page without main text has the empty text."""

    def run(pages: pd.Series) -> pd.Series:
        tree = trained()
        return pd.Series([main_text(p or "", tree) for p in pages], dtype="object")

    return F.pandas_udf(run, "string")(page)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html); other columns are ignored.

    ``n_chars`` counts code points. A very long page is read whole, in one row. Repeated rows are all returned; an empty table gives an empty result.
    """
    found = pages.select("page_id", "url", text_of("html").alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
