"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is split into blocks at its block-level tags. A block is described by its word count and link density, those
of the blocks before and after it (none has -1 words), and whether it stands in an article element or in a part marked as something else
(navigation, form, advert, comments, ...). A small decision tree (Gini, trained on the labelled table below) says which
blocks are main text. Pages are handled one by one where they are read; nothing is shuffled.

Defined cases: a null or empty page, or one without main text, gives an empty string; unclosed and stray tags are tolerated
(an embedded element, such as svg or video, goes with its content only if it has an end tag; unclosed scripts run to the page's end);
text inside a block has its character references decoded and its white space turned into single spaces; blocks are joined by
one space in page order; repeated rows stay; other columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role, and words of class names that mark other parts of a page.
RAW = "script|style|textarea|title"
EMBEDDED = "noscript|template|select|svg|iframe|object|canvas|audio|video"
CONTAINERS = frozenset(
    "div section article main nav header footer aside form ul ol dl table body html dialog figure details fieldset menu".split()
)
LEAVES = frozenset(
    "p h1 h2 h3 h4 h5 h6 li td th tr dt dd pre blockquote figcaption caption address summary legend hr center".split()
)
OTHER_PARTS = frozenset("nav footer aside form menu dialog fieldset button".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal "
    "sidebar comment comments disqus nav navbar navigation menu breadcrumb breadcrumbs pagination pager share sharing social "
    "related recommended newsletter subscribe subscription signup login search toolbar widget copyright disclaimer".split()
)
WEAK_MARKS = frozenset("header footer masthead topbar bottom legal".split())
MAIN_WORDS = frozenset("article content main post entry story body text".split())
# Words that leave the meaning of a mark or a main word as it is: `sidebar-left`, `related-posts`, `content-wrapper`.
PART_WORDS = frozenset(
    "container wrapper wrap box block list section area inner outer left right top item items bar link links icon icons button "
    "buttons form media slot unit main primary secondary site page posts articles stories".split()
)
MAIN_TAGS = frozenset("article main div section td".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(?P<bad>/?[a-z][^>]*)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
EMBEDDINGS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<script(?=[\s/>])[^>]*>.*?(?:</script\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>{EMBEDDED})(?=[\s/>])(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S | re.I,
)
EMBEDDED_TAGS = frozenset(EMBEDDED.split("|"))
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none\b", re.I)
SPLIT = re.compile(r"[^a-z]+")

ARTICLE, PLAIN, OTHER = "article", "plain", "other"
# The labelled table, written for this purpose: pages of blocks (where, words, words in links, 1 for main text).
LABELLED = [
    [(OTHER, 1, 1, 0), (OTHER, 1, 1, 0), (OTHER, 2, 2, 0), (OTHER, 9, 0, 0), (ARTICLE, 8, 0, 1), (ARTICLE, 60, 0, 1),
     (ARTICLE, 2, 0, 1), (ARTICLE, 140, 3, 1), (ARTICLE, 25, 0, 1), (OTHER, 12, 0, 0)],
    [(OTHER, 3, 3, 0), (PLAIN, 4, 0, 0), (ARTICLE, 6, 0, 1), (ARTICLE, 1, 0, 1), (ARTICLE, 33, 4, 1), (OTHER, 40, 0, 0),
     (ARTICLE, 80, 0, 1), (OTHER, 55, 2, 0), (OTHER, 120, 0, 0), (PLAIN, 7, 2, 0), (PLAIN, 14, 0, 0)],
    [(PLAIN, 2, 2, 0), (PLAIN, 1, 1, 0), (PLAIN, 7, 0, 1), (PLAIN, 45, 1, 1), (PLAIN, 90, 0, 1), (PLAIN, 18, 0, 1),
     (PLAIN, 70, 6, 1), (PLAIN, 3, 3, 0), (PLAIN, 4, 4, 0), (PLAIN, 6, 1, 0)],
    [(PLAIN, 5, 5, 0), (PLAIN, 4, 4, 0), (PLAIN, 6, 6, 0), (PLAIN, 3, 3, 0), (PLAIN, 30, 0, 1), (PLAIN, 4, 0, 1),
     (PLAIN, 52, 2, 1), (PLAIN, 21, 0, 1), (PLAIN, 8, 8, 0), (PLAIN, 9, 9, 0), (PLAIN, 5, 2, 0)],
    [(OTHER, 200, 10, 0), (ARTICLE, 12, 0, 1), (ARTICLE, 3, 0, 1), (ARTICLE, 4, 0, 1), (ARTICLE, 2, 2, 1), (ARTICLE, 10, 1, 1),
     (PLAIN, 24, 0, 0), (PLAIN, 60, 0, 0), (OTHER, 15, 15, 0)],
    [(PLAIN, 20, 0, 0), (OTHER, 5, 5, 0), (ARTICLE, 400, 12, 1), (ARTICLE, 5, 0, 1), (ARTICLE, 350, 0, 1), (OTHER, 300, 0, 0),
     (PLAIN, 11, 0, 0), (OTHER, 2, 0, 0), (OTHER, 1, 0, 0)],
    [(PLAIN, 1, 1, 0), (PLAIN, 1, 1, 0), (PLAIN, 1, 1, 0), (PLAIN, 12, 0, 1), (PLAIN, 150, 5, 1), (PLAIN, 200, 0, 1),
     (OTHER, 90, 0, 0), (OTHER, 30, 4, 0), (PLAIN, 10, 9, 0), (PLAIN, 2, 2, 0)],
    [(ARTICLE, 5, 0, 1), (OTHER, 3, 0, 0), (ARTICLE, 17, 0, 1), (ARTICLE, 9, 0, 1), (OTHER, 7, 7, 0), (ARTICLE, 44, 20, 1),
     (ARTICLE, 6, 0, 1), (OTHER, 33, 0, 0), (OTHER, 8, 1, 0), (PLAIN, 9, 4, 0)],
    [(PLAIN, 1, 1, 0), (PLAIN, 1, 1, 0), (PLAIN, 48, 0, 1), (PLAIN, 50, 0, 1), (PLAIN, 3, 0, 0)],
    [(PLAIN, 2, 2, 0), (PLAIN, 3, 3, 0), (PLAIN, 85, 2, 1), (PLAIN, 40, 0, 1), (PLAIN, 4, 4, 0), (PLAIN, 5, 5, 0)],
    [(PLAIN, 2, 2, 0), (PLAIN, 6, 0, 1), (PLAIN, 110, 0, 1), (PLAIN, 7, 0, 1), (PLAIN, 95, 9, 1), (PLAIN, 3, 1, 0)],
    [(PLAIN, 4, 4, 0), (PLAIN, 26, 0, 1), (PLAIN, 64, 1, 1), (PLAIN, 2, 2, 0), (PLAIN, 2, 2, 0), (PLAIN, 8, 0, 0)],
    [(OTHER, 70, 0, 0), (OTHER, 25, 0, 0), (ARTICLE, 1, 0, 1), (ARTICLE, 1, 1, 1), (ARTICLE, 1, 0, 1)],
    [(ARTICLE, 3, 3, 1), (ARTICLE, 2, 0, 1), (ARTICLE, 4, 2, 1), (OTHER, 90, 0, 0), (ARTICLE, 1, 0, 1)],
    [(ARTICLE, 2, 0, 1), (OTHER, 35, 0, 0), (OTHER, 65, 1, 0), (ARTICLE, 1, 1, 1), (ARTICLE, 5, 5, 1)],
    [(OTHER, 48, 0, 0), (PLAIN, 30, 0, 0), (ARTICLE, 7, 7, 1), (ARTICLE, 3, 0, 1)],
    [(OTHER, 1, 0, 0), (ARTICLE, 210, 0, 1), (OTHER, 4, 0, 0), (ARTICLE, 48, 1, 1), (OTHER, 12, 1, 0), (ARTICLE, 95, 0, 1)],
    [(OTHER, 2, 0, 0), (OTHER, 180, 0, 0), (OTHER, 11, 0, 0), (PLAIN, 88, 0, 1), (OTHER, 9, 0, 0), (PLAIN, 130, 0, 1), (OTHER, 26, 0, 0)],
    [(PLAIN, 9, 0, 1), (PLAIN, 77, 0, 1), (OTHER, 5, 0, 0), (PLAIN, 61, 0, 1), (OTHER, 52, 0, 0), (OTHER, 140, 0, 0)],
    [(PLAIN, 4, 0, 0), (OTHER, 14, 0, 0), (ARTICLE, 300, 4, 1), (OTHER, 3, 0, 0), (ARTICLE, 72, 0, 1), (PLAIN, 13, 0, 0), (PLAIN, 70, 0, 0)],
    [(OTHER, n, 0, 0) for n in (3, 60, 7, 90, 15, 120, 30, 200, 45, 75, 2, 150, 24, 36, 1, 48, 5, 300, 18, 55, 28, 110, 65, 40)],
    [(OTHER, n, k, 0) for n, k in ((50, 2), (4, 0), (85, 0), (12, 3), (140, 9), (33, 0), (70, 7), (26, 1), (400, 0), (9, 0), (58, 0), (95, 4))],
    [(PLAIN, 210, 0, 1)],
    [(PLAIN, 35, 0, 1)],
    [(PLAIN, 38, 0, 1), (PLAIN, 55, 0, 1), (PLAIN, 62, 2, 1)],
    [(PLAIN, 75, 0, 1), (PLAIN, 58, 0, 1), (PLAIN, 1, 0, 0)],
    [(PLAIN, 66, 0, 1), (PLAIN, 34, 0, 1), (PLAIN, 1, 1, 0)],
    [(PLAIN, 2, 2, 0), (PLAIN, 95, 0, 1), (PLAIN, 150, 22, 1), (PLAIN, 64, 0, 1), (PLAIN, 3, 0, 0)],
    [(PLAIN, 1, 1, 0), (PLAIN, 6, 0, 1), (PLAIN, 118, 17, 1), (PLAIN, 70, 0, 1)],
]


def marked(tag: str, rest: str) -> tuple[bool, bool]:
    """Whether the attributes of a tag hide its content, and whether they name it as other than main text.

    A class, id or role is a mark as a whole, not by one of its words: `has-sidebar` and `comments-open` tell of something
    else. Of mixed names the main one decides on the elements that hold articles; a role decides by itself.
    """
    hidden = role = False
    tokens: list[set[str]] = []
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden":
            hidden = hidden or value not in ("false", "until-found")
        elif name == "style":
            hidden = hidden or bool(NO_DISPLAY.search(html.unescape(value)))
        elif name in ("class", "id", "role"):
            found = [{w for w in SPLIT.split(t) if w} for t in value.split()]
            role = role or name == "role" and any(t and t <= MARKS for t in found)
            tokens += found
    # A class of digits or signs alone says nothing.
    tokens = [t for t in tokens if t]
    marks = [t for t in tokens if t & MARKS and t <= MARKS | PART_WORDS]
    weak = [t for t in tokens if t & WEAK_MARKS and t <= WEAK_MARKS | MARKS | PART_WORDS]
    if any(t & MAIN_WORDS for t in tokens):
        weak = []
    main = tag in ("article", "main") and len(marks) < len(tokens)
    main = main or tag in MAIN_TAGS and any(t & MAIN_WORDS and t <= MAIN_WORDS | PART_WORDS for t in tokens)
    return hidden, role or bool(marks and not main) or bool(weak)


def embedded_ends(page: str) -> dict[int, int]:
    """Where each embedded element that has an end tag of its own begins and ends; others lose their tag only."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in EMBEDDINGS.finditer(page):
        if m["tag"] is None:
            continue
        begun = opened.setdefault(m["tag"].lower(), [])
        if not m["close"]:
            if not m["rest"].endswith("/"):
                begun.append(m.start())
        elif begun:
            ends[begun.pop()] = m.end()
    return ends


def page_blocks(page: str) -> list[tuple[str, str, int, int]]:
    """(text, where, words, words in links) of each block with a word, in page order."""
    out: list[tuple[str, str, int, int]] = []
    runs: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, other part, main part
    others = mains = 0
    leaf_other = linked = False

    def flush():
        if not runs:
            return
        text = " ".join("".join(r for r, _ in runs).split())
        if text:
            links = sum(len(r.split()) for r, in_link in runs if in_link)
            n = text.count(" ") + 1
            where = OTHER if others or leaf_other else ARTICLE if mains else PLAIN
            out.append((text, where, n, min(n, links)))
        runs.clear()

    at, ends = 0, None
    while m := TOKEN.match(page, at):
        at = m.end()
        text = m["text"]
        if text is not None:
            runs.append((html.unescape(text), linked))
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in EMBEDDED_TAGS:
            ends = embedded_ends(page) if ends is None else ends
            at = ends.get(m.start(), at)
            continue
        if m["close"]:
            if tag == "a":
                linked = False
            if tag in CONTAINERS or any(tag == s[0] for s in stack):
                flush()
                leaf_other = False
                if any(tag == s[0] for s in stack):
                    while True:
                        name, other, main = stack.pop()
                        others, mains = others - other, mains - main
                        if name == tag:
                            break
            elif tag in LEAVES:
                flush()
                leaf_other = False
            continue
        rest = m["rest"]
        hidden, named = marked(tag, rest) if rest else (False, False)
        other = tag in OTHER_PARTS or named or hidden or (tag == "header" and not mains)
        if tag == "body" or tag == "html":
            other = False
        if tag in CONTAINERS:
            flush()
            leaf_other = False
            main = tag in ("article", "main")
            if not rest.endswith("/"):
                stack.append((tag, other, main))
                others, mains = others + other, mains + main
        elif tag in LEAVES:
            flush()
            leaf_other = other
        elif tag == "br":
            runs.append((" ", False))
        elif other and not rest.endswith("/"):
            flush()
            stack.append((tag, True, False))
            others += 1
        if tag == "a":
            linked = True
    flush()
    return out


def features(blocks: list[tuple[str, str, int, int]]) -> np.ndarray:
    """Per block: words and link density of it, of the one before and the one after, where it stands, article page."""
    n = len(blocks)
    words = np.array([b[2] for b in blocks], dtype=float)
    density = np.array([b[3] / b[2] for b in blocks], dtype=float)
    around = np.zeros((n + 2, 2))
    around[[0, -1], 0] = -1  # no neighbour
    around[1:-1, 0], around[1:-1, 1] = words, density
    where = np.array([(b[1] == OTHER, b[1] == ARTICLE) for b in blocks], dtype=float).reshape(n, 2)
    has_article = np.full((n, 1), float(where[:, 1].any())) if n else np.zeros((0, 1))
    return np.hstack([around[1:-1], around[:-2], around[2:], where, has_article])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2):
    """A decision tree by Gini impurity: (feature, threshold, left, right), or the label of a leaf."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return int(share >= 0.5)
    best = None
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], y[order]
        ones, k = np.cumsum(t)[:-1], np.arange(1, len(t))
        left, right = ones / k, (t.sum() - ones) / (len(t) - k)
        cost = k * left * (1 - left) + (len(t) - k) * right * (1 - right)
        cost[(v[:-1] == v[1:]) | (k < least) | (len(t) - k < least)] = np.inf
        i = int(np.argmin(cost))
        if np.isfinite(cost[i]) and (best is None or cost[i] < best[0] - 1e-12):
            best = (cost[i], j, (v[i] + v[i + 1]) / 2)
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return int(share >= 0.5)
    _, j, cut = best
    low = x[:, j] <= cut
    return (j, float(cut), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def predict(tree, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, tuple):
            out[rows] = bool(node)
            continue
        low = x[rows, node[0]] <= node[1]
        todo += [(node[2], rows[low]), (node[3], rows[~low])]
    return out


def train(labelled: list = LABELLED):
    """The tree of a labelled table of pages; the table is small by its nature and stays on the driver."""
    x = np.vstack([features([("", *b[:3]) for b in page]) for page in labelled])
    y = np.array([b[3] for page in labelled for b in page], dtype=float)
    return grow(x, y)


def main_text(page: str | None, tree) -> str:
    blocks = page_blocks(page or "")
    if not blocks:
        return ""
    good = predict(tree, features(blocks))
    return " ".join(b[0] for b, g in zip(blocks, good) if g)


def extract(pages: DataFrame, tree=None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    tree = train() if tree is None else tree

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py(), tree) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    slim = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
