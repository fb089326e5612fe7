"""Main text of web pages from flat text blocks.

A page is read as a sequence of text blocks: what stands between block-level tags. Each block has a few shallow
features: its words, the share of them in links, the same of the block before and the block after, and what it lies in
(article, page furniture). A decision tree says which blocks are main text. It is trained on the small labelled table
``LABELLED``, once, on the driver.

Defined results: a null or empty page, and a page without main text, give an empty text; broken mark-up is read on (an
unclosed tag stays open until its parent closes, an unclosed script or comment takes the rest of the page); pages of
any length are read whole; rows that repeat are extracted each; other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|template)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<[a-z/!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[a-z]+|\d+", re.I)

#: Elements that don't part a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
#: Elements that hold blocks and tell what these are. Others leave no trace on the blocks inside.
CONTAINERS = frozenset("article aside body button dialog div fieldset figcaption footer form header iframe li main menu nav noscript ol section select svg table ul".split())
#: Elements, and words in class, id or role, that mark page furniture and main text.
FURNITURE_TAGS = frozenset("aside button dialog fieldset footer form iframe menu nav noscript select svg".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies disqus disclaimer "
    "footer form gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toolbar widget widgets".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset("article content entry main post story".split())

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "in_furniture", "page_has_main", "heading"]

#: The labelled table: a row per block (FEATURES, then 1 for main text). Links are shares of the words. Labelled by
#: hand.
LABELLED = [
    # Pages with an article: paragraphs of all lengths, headings, lists, links in the text.
    (80, 0.00, 9, 0.0, 60, 0.0, 1, 0, 1, 0, 1), (1, 0.00, 40, 0.0, 33, 0.0, 1, 0, 1, 0, 1), (9, 0.00, 7, 0.0, 12, 0.0, 1, 0, 1, 1, 1),
    (3, 0.00, 0, 0.0, 3, 0.0, 1, 0, 1, 1, 1), (12, 0.00, 12, 0.0, 8, 0.0, 1, 0, 1, 0, 1), (5, 0.00, 4, 0.0, 0, 0.0, 1, 0, 1, 0, 1),
    (45, 0.20, 30, 0.0, 25, 0.1, 1, 0, 1, 0, 1), (6, 1.00, 50, 0.0, 45, 0.0, 1, 0, 1, 0, 1), (14, 0.50, 20, 0.0, 6, 0.0, 1, 0, 1, 0, 1),
    (2, 0.00, 1, 1.0, 30, 0.0, 1, 0, 1, 1, 1), (7, 0.00, 8, 0.0, 9, 0.0, 1, 0, 1, 0, 1), (150, 0.02, 2, 0.0, 9, 0.1, 1, 0, 1, 0, 1),
    # Furniture inside and outside an article, long and short.
    (1, 1.00, 1, 1.0, 1, 1.0, 0, 1, 1, 0, 0), (2, 1.00, 0, 0.0, 1, 1.0, 0, 1, 1, 0, 0), (12, 0.00, 1, 1.0, 9, 0.0, 0, 1, 1, 0, 0),
    (40, 0.00, 30, 0.0, 0, 0.0, 0, 1, 1, 0, 0), (25, 0.00, 60, 0.0, 20, 0.0, 1, 1, 1, 0, 0), (8, 0.50, 40, 0.0, 7, 0.4, 1, 1, 1, 0, 0),
    (3, 0.00, 5, 0.0, 30, 0.0, 0, 1, 1, 1, 0), (60, 0.05, 3, 0.0, 55, 0.0, 0, 1, 1, 0, 0), (5, 0.00, 90, 0.0, 12, 0.0, 1, 1, 1, 1, 0),
    (70, 0.00, 6, 0.0, 80, 0.0, 1, 1, 1, 0, 0), (2, 0.00, 3, 0.0, 1, 0.0, 0, 1, 1, 0, 0),
    # Outside the article of a page that has one.
    (4, 0.00, 2, 1.0, 8, 0.0, 0, 0, 1, 0, 0), (9, 0.30, 40, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (3, 0.00, 0, 0.0, 1, 1.0, 0, 0, 1, 1, 0),
    (30, 0.00, 1, 1.0, 9, 0.0, 0, 0, 1, 0, 0), (18, 0.00, 50, 0.0, 4, 0.5, 0, 0, 1, 0, 0), (1, 1.00, 1, 1.0, 2, 1.0, 0, 0, 1, 0, 0),
    # Pages without an article: words and links decide, with the neighbours.
    (60, 0.00, 8, 0.0, 45, 0.0, 0, 0, 0, 0, 1), (35, 0.10, 50, 0.0, 30, 0.0, 0, 0, 0, 0, 1), (20, 0.00, 40, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (6, 0.00, 45, 0.0, 38, 0.0, 0, 0, 0, 0, 1), (7, 0.00, 2, 1.0, 40, 0.0, 0, 0, 0, 1, 1), (5, 0.00, 33, 0.0, 28, 0.1, 0, 0, 0, 1, 1),
    (11, 0.10, 24, 0.0, 31, 0.0, 0, 0, 0, 0, 1), (90, 0.05, 1, 1.0, 3, 1.0, 0, 0, 0, 0, 1), (16, 0.00, 18, 0.0, 22, 0.0, 0, 0, 0, 0, 1),
    (2, 1.00, 1, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (4, 0.00, 3, 1.0, 2, 0.0, 0, 0, 0, 0, 0), (6, 0.70, 2, 1.0, 5, 0.8, 0, 0, 0, 0, 0),
    (25, 0.80, 20, 0.7, 30, 0.9, 0, 0, 0, 0, 0), (8, 0.20, 40, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (3, 0.00, 1, 1.0, 4, 0.5, 0, 0, 0, 1, 0),
    (5, 0.00, 2, 1.0, 4, 0.0, 0, 0, 0, 0, 0), (1, 0.00, 2, 0.0, 1, 0.0, 0, 0, 0, 0, 0), (30, 0.60, 50, 0.0, 4, 1.0, 0, 0, 0, 0, 0),
    (50, 0.00, 9, 0.0, 40, 0.0, 0, 1, 0, 0, 0), (15, 0.00, 2, 1.0, 9, 0.0, 0, 1, 0, 0, 0), (4, 1.00, 5, 1.0, 30, 0.0, 0, 1, 0, 0, 0),
]


@dataclass
class Block:
    text: str
    words: int
    links: float
    in_main: int
    in_furniture: int
    heading: int


def _kind(tag: str, attributes: str, in_main: bool) -> tuple[int, int]:
    """Whether a container is main text and whether it is furniture. The header of an article is part of it."""
    names: set[str] = set()
    if "=" in attributes:
        for found in _NAMES.findall(attributes):
            names.update(w.lower() for w in _PARTS.findall(" ".join(found)))
    furniture = tag in FURNITURE_TAGS or (tag == "header" and not in_main) or bool(_HIDDEN.search(attributes)) if attributes or tag in CONTAINERS else False
    marked = names & FURNITURE_WORDS
    if marked and not (tag in MAIN_TAGS or tag == "body"):
        furniture = furniture or not (marked == {"header"} and in_main)
    main = tag in MAIN_TAGS or (tag in ("div", "section") and bool(names & MAIN_WORDS) and not marked)
    return int(main), int(bool(furniture))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order. White space inside is one space; character references are decoded."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked, in_link, heading = 0, False, 0
    main = furniture = 0

    def close() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            blocks.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), int(main > 0), int(furniture > 0), heading))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if in_link:
            linked += len(text.split())

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
            continue
        close()
        in_link = False
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            heading = int(not m["end"])
        elif tag in CONTAINERS:
            heading = 0
            if not m["end"]:
                if not m["rest"].endswith("/"):
                    own = _kind(tag, m["rest"], main > 0)
                    stack.append((tag, *own))
                    main, furniture = main + own[0], furniture + own[1]
            elif any(open_tag == tag for open_tag, _, _ in stack):
                while True:
                    open_tag, own_main, own_furniture = stack.pop()
                    main, furniture = main - own_main, furniture - own_furniture
                    if open_tag == tag:
                        break
        elif tag == "p":
            heading = 0
    if at < len(page):
        add(page[at:])
    close()
    return blocks


def features(blocks: Sequence[Block]) -> list[tuple]:
    """A row of FEATURES for each block of a page."""
    has_main = int(any(b.in_main and not b.in_furniture for b in blocks))
    ends = Block("", 0, 0.0, 0, 0, 0)
    rows = []
    for k, b in enumerate(blocks):
        before = blocks[k - 1] if k else ends
        after = blocks[k + 1] if k + 1 < len(blocks) else ends
        rows.append((b.words, b.links, before.words, before.links, after.words, after.links, b.in_main, b.in_furniture, has_main, b.heading))
    return rows


def train(table: Sequence[tuple], most_depth: int = 8):
    """A decision tree: (feature, bound, tree up to the bound, tree above it), or the label of a leaf. Splits by Gini
    impurity."""
    labels = [row[-1] for row in table]
    share = sum(labels) / len(labels)
    if most_depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = None
    for f in range(len(table[0]) - 1):
        values = sorted({row[f] for row in table})
        for low, high in zip(values, values[1:]):
            bound = (low + high) / 2
            left = [row[-1] for row in table if row[f] <= bound]
            right = [row[-1] for row in table if row[f] > bound]
            impurity = sum(len(s) * (p := sum(s) / len(s)) * (1 - p) for s in (left, right))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, bound)
    if best is None:
        return int(share >= 0.5)
    _, f, bound = best
    return (f, bound, train([r for r in table if r[f] <= bound], most_depth - 1), train([r for r in table if r[f] > bound], most_depth - 1))


def classify(tree, row: Sequence[float]) -> int:
    while not isinstance(tree, int):
        f, bound, low, high = tree
        tree = low if row[f] <= bound else high
    return tree


def main_text(page: str, tree) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, row in zip(blocks, features(blocks)) if classify(tree, row))


def extractor(tree):
    """A function of a column of pages that gives their main texts."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.fillna("").map(lambda page: main_text(page, tree))

    return extract


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labelled: Sequence[tuple] = tuple(LABELLED)) -> DataFrame:
    """One row for each row of ``pages``: id, url, text, n_chars."""
    text: Column = extractor(train(labelled))(pages[html_col])
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), text.alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
