"""Main text of web pages: flat text blocks and a decision tree.

A page is read once, as a flat list of text blocks between block-level tags. A block is
described by its word count and link density, those of the blocks before and after it, and
by where it stands: inside the page's article, or inside a part that is named as chrome by
its tag, class, id or role. A decision tree, trained on a small labelled table below,
decides for all blocks of a batch of pages at once.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import text_slices, to_tasks

# Elements whose content is no text, that break blocks, or that hold chrome.
RAW = "script style noscript template iframe svg object textarea select title head button".split()
BLOCK = (
    "address article aside blockquote body br caption center dd details dialog div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main"
    " menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
CHROME_TAGS = "nav footer aside form menu dialog search".split()
CHROME_ROLES = (
    "navigation banner contentinfo complementary search form menu menubar dialog alert"
).split()
CHROME_NAMES = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments commentlist consent cookie cookies copyright discussion disqus dropdown footer"
    " gdpr legal login menu modal nav navbar navigation newsletter notice notices notification"
    " overlay pager pagination popup promo promotion recommended related replies reply respond"
    " search share sharebar sharing sidebar sidenav signin signup skip social sponsor sponsored"
    " subscribe subscription teaser toolbar topbar widget widgets"
).split()
# Elements whose content is raw text up to their end, or that of the page.
TO_THE_END = "script style noscript iframe textarea title".split()
# Names that may stand on a wrapper around a whole page, beside being chrome themselves.
WRAPPER_NAMES = (
    "banner dropdown login menu modal nav navbar navigation notice overlay search share sidebar"
    " sidenav signin skip subscribe toolbar topbar widget widgets"
).split()
# Share of a page's words that such a wrapper holds if there is no article in it.
WRAPPED_SHARE = 0.75
# These are chrome outside of an article; inside, they hold its title.
CHROME_OUTSIDE = "header masthead".split()

_RAW, _BLOCK, _VOID = frozenset(RAW), frozenset(BLOCK), frozenset(VOID)
_CHROME_TAGS, _CHROME_ROLES = frozenset(CHROME_TAGS), frozenset(CHROME_ROLES)
_CHROME_NAMES, _CHROME_OUTSIDE = frozenset(CHROME_NAMES), frozenset(CHROME_OUTSIDE)
_TO_THE_END, _WRAPPER_NAMES = frozenset(TO_THE_END), frozenset(WRAPPER_NAMES)
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_STATE_NAMES = ("has-", "has_", "with-", "with_", "no-", "no_", "is-", "is_", "show-", "show_")

_MARKUP = re.compile(
    r"<!---?>|<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(eq=False)
class _Open:
    """An open element; a wrapper is chrome that may hold a whole page."""

    tag: str
    chrome: bool
    wrapper: bool
    article: bool


def _chrome(tag: str, rest: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is chrome, and if so, whether it may be a wrapper."""
    if tag in ("html", "body"):
        return False, False
    if tag in _CHROME_TAGS or (tag == "header" and not in_article):
        return True, tag == "form"
    if not rest or "=" not in rest and "hidden" not in rest:
        return False, False
    for name, *values in _ATTRIBUTE.findall(rest):
        value = "".join(values)
        name = name.lower()
        if name == "hidden" or name == "style" and _HIDDEN.search(value):
            return True, False
        if name == "role" and value.lower() in _CHROME_ROLES:
            return True, False
        if name in ("class", "id"):
            for word in value.split():
                if word.lower().startswith(_STATE_NAMES):
                    continue
                apart = re.sub(r"([a-z])([A-Z])", r"\1 \2", word).lower()
                parts = set(re.findall(r"[a-z]+", apart))
                named = parts & _CHROME_NAMES
                if named or not in_article and parts & _CHROME_OUTSIDE:
                    return True, bool(named) and named <= _WRAPPER_NAMES
    return False, False


def text_blocks(page: str) -> list[tuple[str, float, bool, bool, bool]]:
    """(text, link density, in an article, in chrome, heading) of all non-empty blocks.

    A wrapper outside of all articles is no chrome if all article blocks of the page are in
    it, or if it holds most words of a page without any.
    """
    blocks: list[tuple[str, float, bool, bool, bool]] = []
    wrapped: list[list[_Open]] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked: list[str] = []
    in_link = heading = False
    at = 0

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                share = len(" ".join(html.unescape("".join(linked)).split())) / len(text)
                inner = max((i for i, o in enumerate(stack) if o.article), default=-1)
                article = inner >= 0
                around = [o for o in stack[: inner + 1] if o.chrome] if article else stack
                wrapped.append([o for o in around if o.wrapper])
                chrome = any(o.chrome for o in stack[inner + 1 :] if article or not o.wrapper)
                chrome = chrome or any(not o.wrapper for o in around if o.chrome)
                blocks.append((text, min(1.0, share), article, chrome, heading))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if in_link:
                linked.append(text)

    while found := _MARKUP.search(page, at):
        add(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        closing = bool(found["close"])
        if tag in _RAW and not closing:
            if not found["rest"].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if not end and tag not in _TO_THE_END:
                    continue
                at = end.end() if end else len(page)
            if tag != "button":
                close_block()
            continue
        if tag in _BLOCK:
            close_block()
            heading = tag in _HEADINGS and not closing
        if tag == "a":
            in_link = not closing
        elif closing and tag in _BLOCK:
            in_link = False
        if tag in _VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        in_article = any(o.article for o in stack)
        if tag in _BLOCK:
            # An open paragraph, or an item of the same list, ends here.
            while stack and (stack[-1].tag == "p" or stack[-1].tag not in _BLOCK):
                stack.pop()
            if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack:
                if stack[-1].tag == tag:
                    stack.pop()
        chrome, wrapper = _chrome(tag, found["rest"], in_article)
        if tag in _BLOCK or chrome:
            article = tag in ("article", "main") or 'role="main"' in found["rest"]
            if not found["rest"].endswith("/"):
                stack.append(_Open(tag, chrome, wrapper, article))
    add(page[at:])
    close_block()
    harmless = _harmless(blocks, wrapped)
    return [
        (*block[:3], block[3] or not harmless.issuperset(around), block[4])
        for block, around in zip(blocks, wrapped, strict=True)
    ]


def _harmless(
    blocks: list[tuple[str, float, bool, bool, bool]], wrapped: list[list[_Open]]
) -> set[_Open]:
    """Wrappers that are no chrome; ``wrapped`` has those around each block."""
    articles = [set(w) for b, w in zip(blocks, wrapped, strict=True) if b[2] and not b[3]]
    if articles:
        return set.intersection(*articles)
    if any(block[2] for block in blocks):
        return set()
    words: Counter = Counter()
    for block, around in zip(blocks, wrapped, strict=True):
        words.update(dict.fromkeys(around, len(block[0].split())))
    least = WRAPPED_SHARE * sum(len(block[0].split()) for block in blocks)
    return {wrapper for wrapper, count in words.items() if count >= least}


FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "in_article", "in_chrome", "heading", "page_has_article",
)

# Blocks of pages without an article, which size, links and neighbours tell apart.
_PLAIN = """
 60 0   40 0   55 0   0  1
 25 0.1  8 0   60 0   0  1
 18 0   35 0.1 30 0   0  1
 14 0.2 30 0   25 0   0  1
  5 0   40 0   35 0   0  1
  1 0   30 0   60 0   0  1
  7 0    2 1   50 0   1  1
  4 0   60 0   40 0   1  1
 90 0.1  6 0    2 1   0  1
 30 0   45 0    5 0   0  1
 40 0    0 0    0 0   0  1
 22 0    3 1    4 1   0  1
  9 0    0 0    0 0   0  1
  1 1    2 1    1 1   0  0
  3 1    2 1    4 1   0  0
  2 1   50 0    3 1   0  0
  1 1    0 0   60 0   0  0
  4 1    0 0   25 0   0  0
 12 0.9 40 0   10 0.9 0  0
 30 0.8  9 1   25 0.7 0  0
  4 0    2 1    3 1   0  0
  5 0   30 0    0 0   0  0
  6 0.5 25 0    2 1   0  0
  3 0    0 0    2 1   0  0
  4 0    5 1    3 1   1  0
"""


def labelled_table() -> np.ndarray:
    """A block per row: FEATURES, and whether it is main text.

    Blocks of an article are main text whatever their size; beside an article, and in
    chrome, none is. These rows are spelt out for typical sizes and neighbours.
    """
    rows = []
    sizes = [(1, 0), (4, 0), (9, 0), (25, 0.2), (70, 0), (140, 0.05), (3, 1)]
    near = [(0, 0), (3, 1), (8, 0), (50, 0)]
    for (words, links), before, after, head in product(sizes, near, near, (0, 1)):
        around = [words, links, *before, *after]
        rows += [[*around, 1, 0, head, 1, 1], [*around, 0, 0, head, 1, 0]]
        rows += [[*around, a, 1, head, max(a, b), 0] for a, b in ((0, 0), (0, 1), (1, 1))]
    plain = np.array(_PLAIN.split(), float).reshape(-1, 8)
    weight = len(rows) // len(plain)
    for *around, head, label in plain.tolist() * weight:
        rows.append([*around, 0, 0, head, 0, label])
    return np.array(rows, float)


@dataclass(frozen=True)
class Tree:
    """A binary tree in arrays; a leaf has no feature (-1)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), int)
        while (inner := self.feature[node] >= 0).any():
            at = np.nonzero(inner)[0]
            here = node[at]
            low = rows[at, self.feature[here]] <= self.threshold[here]
            node[at] = np.where(low, self.left[here], self.right[here])
        return self.value[node] > 0.5


def train_tree(table: np.ndarray, depth: int = 8) -> Tree:
    """Splits by Gini impurity until leaves are pure; the label is the last column."""
    rows, labels = table[:, :-1], table[:, -1]
    nodes: list[list] = []

    def impurity(part: np.ndarray) -> float:
        share = part.mean() if len(part) else 0.0
        return len(part) * share * (1 - share)

    def grow(at: np.ndarray, left_depth: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(labels[at].mean())])
        before = impurity(labels[at])
        if before == 0 or left_depth == 0:
            return number
        best = (before - 1e-9, -1, 0.0)
        for f in range(rows.shape[1]):
            values = np.unique(rows[at, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = rows[at, f] <= cut
                after = impurity(labels[at[low]]) + impurity(labels[at[~low]])
                if after < best[0] - 1e-9:
                    best = (after, f, float(cut))
        if best[1] >= 0:
            low = rows[at, best[1]] <= best[2]
            left, right = grow(at[low], left_depth - 1), grow(at[~low], left_depth - 1)
            nodes[number][:4] = [best[1], best[2], left, right]
        return number

    grow(np.arange(len(rows)), depth)
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(feature, threshold, left, right, value)


def block_features(blocks: list[tuple[str, float, bool, bool, bool]]) -> np.ndarray:
    """A row of FEATURES for every block of one page."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    own = np.array([[len(b[0].split()), b[1]] for b in blocks], float)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    flags = np.array([b[2:] for b in blocks], float)
    has_article = np.full((len(blocks), 1), flags[:, 0].max())
    return np.hstack([own, before, after, flags, has_article])


def _extract(tree: Tree):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "text", "blocks", "kept_blocks"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch, pages in text_slices(batches, "html"):
            blocks = [text_blocks(page) for page in pages]
            keep = tree.predict(np.vstack([block_features(b) for b in blocks]))
            texts, counts, at = [], [], 0
            for found in blocks:
                kept = [b[0] for b, k in zip(found, keep[at : at + len(found)], strict=True) if k]
                at += len(found)
                texts.append("\n".join(kept))
                counts.append(len(kept))
            columns = [
                batch.column("page_id"), batch.column("url"), texts, map(len, blocks), counts
            ]
            arrays = [
                c if isinstance(c, pa.Array) else pa.array(list(c), t)
                for c, t in zip(columns, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return extract


def extract_text(pages: DataFrame, labelled: np.ndarray | None = None) -> DataFrame:
    """page_id, url, text, blocks, kept_blocks of every page (page_id, url, html).

    Blocks are trimmed, their white space is one space, character references are decoded,
    and the kept ones are joined by a line feed. A null, empty or unreadable page has the
    empty text. Repeated rows give a row each; further columns are ignored. ``labelled``
    replaces the table that the tree is trained on.
    """
    tree = train_tree(labelled_table() if labelled is None else labelled)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    schema = "page_id long, url string, text string, blocks long, kept_blocks long"
    return to_tasks(rows, _extract(tree), schema)
