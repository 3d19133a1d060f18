"""Main-text extraction from web pages by classifying flat text blocks.

A page is cut into text blocks at block-level tags. Each block is described by its word count and
link density, those of its two neighbours, and where it stands (inside page furniture, inside the
article, a heading, a list item). A decision tree, trained on the small labelled table below,
says which blocks are main text. Kept blocks are joined in page order.

Character references are decoded, white space inside a block becomes one space (a line break
counts as white space), and scripts, styles and comments never become text. Pages are handled on
their own: nothing is shuffled. Null html counts as empty; an empty page has the empty text; very
long pages are read whole; repeated rows give the same result. Other columns pass through
(columns named like an output are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# fixed values: element kinds of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hr html li main nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
_NO_TEXT = frozenset("script style template noscript svg math iframe object canvas video audio select textarea title head button".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FURNITURE = frozenset("nav footer aside form menu dialog fieldset".split())
# fixed values: words that pages use in class, id and role of furniture and of the article
_FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead sidebar aside ad ads adv advert adverts advertisement advertising "
    "adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social related recommended recommendations comment comments disqus reply replies "
    "respond pagination pager toolbar widget widgets skip copyright legal alert toast paywall contentinfo complementary dialog".split())
_HEADER_NAMES = frozenset("header topbar".split())
_ARTICLE_NAMES = frozenset("article main content post entry story".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    article: bool
    heading: bool
    item: bool


class _Open:
    """An open element and what holds inside it."""

    __slots__ = ("tag", "furniture", "article", "silent", "link", "heading", "item")

    def __init__(self, tag: str, attributes: str, parent: _Open | None):
        self.tag = tag
        up = parent or _ROOT
        names, hidden = (), False
        if attributes and "=" in attributes or "hidden" in attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id", "role"):
                    names += tuple(w.lower() for w in _NAMES.findall(value))
                hidden |= name == "hidden" or name == "style" and bool(re.search(r"display\s*:\s*none", value))
        body = tag in ("html", "body", "article", "main")
        self.article = up.article or tag in ("article", "main") or not body and not _ARTICLE_NAMES.isdisjoint(names)
        outer = tag == "header" or not _HEADER_NAMES.isdisjoint(names)
        named = not _FURNITURE_NAMES.isdisjoint(names)
        self.furniture = up.furniture or hidden or not body and (tag in _FURNITURE or named or outer and not up.article)
        self.silent = up.silent or tag in _NO_TEXT
        self.link = up.link or tag == "a"
        self.heading = up.heading or tag in _HEADINGS
        self.item = up.item or tag in ("li", "dt", "dd")


class _Root:
    furniture = article = silent = link = heading = item = False


_ROOT = _Root()


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order."""
    out: list[Block] = []
    stack: list[_Open] = []
    runs: list[tuple[str, _Open | _Root]] = []

    def close_block() -> None:
        if not runs:
            return
        text = " ".join(unescape("".join(t for t, _ in runs)).split())
        if text:
            linked = sum(len(unescape(t).split()) for t, o in runs if o.link)
            at = next((o for t, o in runs if t.strip()), runs[0][1])
            out.append(Block(text, text.count(" ") + 1, linked, at.furniture, at.article, at.heading, at.item))
        runs.clear()

    def add(text: str) -> None:
        top = stack[-1] if stack else _ROOT
        if text and not top.silent:
            runs.append((text, top))

    at = 0
    while m := _TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m[1] or m[4], m[2] or m[5], m[3] or m[6] or ""
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BREAKS:
            close_block()
        elif tag == "br":
            add(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif tag not in _VOID:
            if tag == "body":
                stack = [o for o in stack if o.tag == "html"]
            if tag in _BREAKS:  # an open paragraph ends here, with what was left open in it
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if stack[k].tag in _BREAKS:
                        break
            if tag == "li":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "li":
                        del stack[k:]
                        break
                    if stack[k].tag in ("ul", "ol", "menu"):
                        break
            if tag == "a":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "a":
                        del stack[k]
                        break
                    if stack[k].tag in _BREAKS:
                        break
            if not attributes.rstrip().endswith("/") or tag in _BREAKS:
                stack.append(_Open(tag, attributes, stack[-1] if stack else None))
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
    add(page[at:])
    close_block()
    return out


#: Columns of the feature table.
FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "furniture", "article", "heading", "item")


def features(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; before the first and after the last stands an empty block."""
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    place = np.array([(b.furniture, b.article, b.heading, b.item) for b in found], float).reshape(-1, 4)
    return np.hstack([own, np.vstack([edge, own[:-1]])[: len(own)], np.vstack([own[1:], edge])[: len(own)], place])


# The labelled table: blocks of pages written for this purpose, in page order, as
# (words, linked words, furniture, article, heading, item, is main text).
LABELLED = (
    # an article element between a menu, an advert and a footer
    ((1, 1, 1, 0, 0, 1, 0), (1, 1, 1, 0, 0, 1, 0), (2, 2, 1, 0, 0, 1, 0), (9, 0, 1, 0, 0, 0, 0), (10, 0, 0, 1, 1, 0, 1), (60, 0, 0, 1, 0, 0, 1),
     (120, 4, 0, 1, 0, 0, 1), (1, 0, 0, 1, 0, 0, 1), (3, 0, 0, 1, 0, 0, 1), (4, 0, 0, 1, 1, 0, 1), (45, 0, 0, 1, 0, 0, 1), (12, 0, 1, 0, 0, 0, 0)),
    # lists, quotes and short lines inside an article, with a box of related links and an inner advert
    ((6, 0, 0, 1, 1, 0, 1), (25, 0, 0, 1, 0, 0, 1), (3, 0, 0, 1, 0, 1, 1), (5, 0, 0, 1, 0, 1, 1), (2, 2, 0, 1, 0, 1, 1), (8, 8, 0, 1, 0, 0, 1),
     (30, 2, 0, 1, 0, 0, 1), (15, 0, 1, 1, 0, 0, 0), (4, 4, 1, 1, 0, 1, 0), (6, 6, 1, 1, 0, 1, 0), (2, 0, 1, 1, 1, 0, 0), (50, 0, 0, 1, 0, 0, 1)),
    # reader comments below an article, long ones too, and a sign-up form
    ((40, 0, 0, 1, 0, 0, 1), (80, 0, 0, 1, 0, 0, 1), (2, 0, 1, 1, 1, 0, 0), (35, 0, 1, 1, 0, 0, 0), (70, 0, 1, 0, 0, 0, 0), (3, 0, 1, 0, 0, 0, 0),
     (18, 0, 1, 0, 0, 0, 0), (2, 1, 1, 0, 0, 0, 0)),
    # no article element: plain paragraphs under a heading
    ((2, 2, 0, 0, 0, 1, 0), (1, 1, 0, 0, 0, 1, 0), (3, 3, 0, 0, 0, 1, 0), (6, 0, 0, 0, 1, 0, 1), (55, 0, 0, 0, 0, 0, 1), (90, 3, 0, 0, 0, 0, 1),
     (14, 0, 0, 0, 0, 0, 1), (40, 0, 0, 0, 0, 0, 1), (5, 0, 0, 0, 1, 0, 1), (65, 0, 0, 0, 0, 0, 1), (4, 4, 0, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0, 0)),
    # no article element: a line of links, a short slogan, text in divisions, a row of links at the end
    ((5, 5, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0, 0), (6, 6, 0, 0, 0, 0, 0), (38, 0, 0, 0, 0, 0, 1), (72, 0, 0, 0, 0, 0, 1), (11, 0, 0, 0, 0, 0, 1),
     (33, 0, 0, 0, 0, 0, 1), (7, 7, 0, 0, 0, 0, 0), (5, 5, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0, 0)),
    # a cookie notice and a sidebar with long texts
    ((45, 2, 1, 0, 0, 0, 0), (60, 0, 1, 0, 0, 0, 0), (3, 0, 1, 0, 1, 0, 0), (28, 28, 1, 0, 0, 1, 0), (85, 0, 0, 0, 0, 0, 1), (40, 0, 0, 0, 0, 0, 1), (22, 0, 1, 0, 0, 0, 0)),
    # a page of links only, and one that is nothing but text
    ((2, 2, 0, 0, 0, 1, 0), (4, 4, 0, 0, 0, 1, 0), (3, 3, 0, 0, 0, 1, 0), (9, 9, 0, 0, 0, 1, 0), (2, 2, 0, 0, 0, 1, 0)),
    ((30, 0, 0, 0, 0, 0, 1),),
    ((12, 0, 0, 0, 0, 0, 1),),
)


@dataclass
class Node:
    """A split (``column`` at most ``at`` goes left) or, without children, a leaf."""

    keep: bool
    column: int = -1
    at: float = 0.0
    left: Node | None = None
    right: Node | None = None


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1) -> Node:
    """A decision tree that lowers Gini impurity the most at each split."""
    node = Node(bool(2 * y.sum() > len(y)))
    if depth == 0 or y.min() == y.max():
        return node
    impurity = lambda part: len(part) * part.mean() * (1 - part.mean())
    best = impurity(y) - 1e-9
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for at in (values[:-1] + values[1:]) / 2:
            low = x[:, column] <= at
            if min(low.sum(), (~low).sum()) >= least and (cost := impurity(y[low]) + impurity(y[~low])) < best:
                best, node.column, node.at = cost, column, float(at)
    if node.column >= 0:
        low = x[:, node.column] <= node.at
        node.left, node.right = fit_tree(x[low], y[low], depth - 1, least), fit_tree(x[~low], y[~low], depth - 1, least)
    return node


def predict(tree: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.left is None:
            out[rows] = node.keep
        elif len(rows):
            low = x[rows, node.column] <= node.at
            todo += [(node.left, rows[low]), (node.right, rows[~low])]
    return out


@cache
def tree() -> Node:
    """The tree for the labelled table."""
    x = [features([Block("", w, k, bool(f), bool(a), bool(h), bool(i)) for w, k, f, a, h, i, _ in page]) for page in LABELLED]
    return fit_tree(np.vstack(x), np.array([row[-1] for page in LABELLED for row in page]))


def main_text(page: str | None, model: Node) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, predict(model, features(found))) if keep)


def extracted(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``: the main text of each page."""
    model = tree()

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p.as_py(), model) for p in batch], pa.string())

    return pages.withColumn(out, run(F.col(html)))
