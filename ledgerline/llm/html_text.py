"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a flat sequence of text blocks, parted by block-level tags; scripts, styles,
comments and the head are left out. A block has a word count and a link density, and so have
the blocks before and behind it; it also knows what kind of region it is in and whether it is a
heading. What class, id and role say of a region is read word by word: names of main text
outweigh those of the layout around it (``content no-sidebar``, ``entry-header``); ``footer-content``
is the content of a footer. A region around main text stays shut, whatever is inside; only where
the page has its ``main`` or ``article`` nowhere else, or no text is left, is a form, header or
hidden element looked into. What hides an element, or names it an advert or comment, counts on
any element. A decision tree grown from the small labelled table below says which blocks are main
text; a page of which it keeps nothing gives its densest run of open blocks. Character references are decoded, white space in a block becomes one space, and the
blocks kept are joined by two line ends.

Defined cases: null or empty html has an empty text, and so has a page without main text. A
tag that is never closed reaches to the end of its container, an unclosed script to the end of
the page. ``<`` that begins no tag is text. Very long pages are read whole. Repeated rows stay
repeated, and columns other than html and those asked for are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.textwords import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(script|style|noscript|template|svg|iframe|object|select|textarea|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
PART = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body button details dialog div fieldset figure footer form head header html "
    "main menu nav ol section table td th ul".split()
)
CELLS = frozenset("td th".split())
# closed by the next block, or the next of their kind, if not by a tag of their own
SINGLE = frozenset("dd dt h1 h2 h3 h4 h5 h6 li p".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset("article main".split())
AROUND = frozenset("aside button dialog fieldset footer form head header menu nav".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_NAMES = frozenset("article content main maincontent post entry story articlebody postbody".split())
AROUND_NAMES = frozenset(
    "ad ads adv advert advertisement adverts alert banner breadcrumb breadcrumbs byline comment "
    "comments consent cookie cookies copyright disclaimer disqus footer form gdpr header login "
    "masthead menu meta modal nav navbar navigation newsletter notice pager pagination popup promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe tags toolbar widget".split()
)
# of these, words of layout, which a name of main text in the same list outweighs
LAYOUT_NAMES = frozenset(
    "banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation sidebar "
    "toolbar widget".split()
)
# of these, what holds texts of its own that are not main text, whatever is inside
SEALED_NAMES = frozenset(
    "ad ads adv advert advertisement adverts comment comments disqus promo promoted promotion "
    "recommended related replies reply respond sponsor sponsored".split()
)
# no-sidebar and comments-open say what else there is, or how it is, and not what is inside
QUALIFIERS = frozenset("has hide no not show with without".split())
STATES = frozenset("active closed disabled enabled off on open visible".split())

# Labelled blocks, fixed values: region (1 main, 0 open, -1 around), heading, words and link
# density of the block, of the one before and of the one behind; then 1 for main text.
LABELLED = np.array(
    [
        (1, 1, 6, 0.0, 0, 0.0, 40, 0.0, 1), (1, 1, 3, 0.0, 9, 0.0, 5, 0.0, 1),
        (1, 1, 2, 0.0, 0, 0.0, 0, 0.0, 1), (1, 0, 1, 0.0, 30, 0.0, 25, 0.0, 1),
        (1, 0, 2, 0.0, 1, 0.0, 1, 0.0, 1), (1, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
        (1, 0, 8, 0.0, 60, 0.0, 0, 0.0, 1), (1, 0, 20, 0.1, 15, 0.0, 80, 0.0, 1),
        (1, 0, 70, 0.0, 3, 0.0, 45, 0.05, 1), (1, 0, 150, 0.02, 90, 0.0, 200, 0.0, 1),
        (1, 0, 400, 0.0, 7, 0.0, 6, 0.9, 1), (1, 0, 35, 0.3, 50, 0.0, 20, 0.0, 1),
        (1, 0, 12, 0.0, 6, 1.0, 70, 0.0, 1), (1, 0, 5, 0.2, 5, 0.0, 5, 0.0, 1),
        (1, 0, 900, 0.0, 0, 0.0, 0, 0.0, 1), (1, 0, 25, 0.0, 6, 1.0, 4, 1.0, 1),
        (1, 0, 3, 1.0, 40, 0.0, 2, 1.0, 0), (1, 0, 2, 1.0, 2, 1.0, 2, 1.0, 0),
        (1, 0, 6, 0.9, 20, 0.0, 30, 0.0, 0), (1, 0, 10, 1.0, 2, 1.0, 0, 0.0, 0),
        (-1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-1, 0, 2, 1.0, 0, 0.0, 1, 1.0, 0),
        (-1, 0, 8, 0.0, 1, 1.0, 12, 0.0, 0), (-1, 0, 15, 0.0, 6, 1.0, 90, 0.0, 0),
        (-1, 0, 60, 0.0, 120, 0.0, 0, 0.0, 0), (-1, 0, 120, 0.0, 80, 0.0, 70, 0.0, 0),
        (-1, 0, 9, 0.0, 100, 0.0, 0, 0.0, 0), (-1, 1, 2, 0.0, 5, 0.0, 40, 0.0, 0),
        (-1, 1, 4, 0.0, 80, 0.0, 2, 1.0, 0), (-1, 0, 30, 0.1, 30, 0.0, 30, 0.0, 0),
        (-1, 0, 3, 0.0, 3, 0.0, 3, 0.0, 0), (-1, 0, 250, 0.0, 4, 0.0, 4, 0.0, 0),
        (-1, 1, 8, 0.0, 0, 0.0, 0, 0.0, 0), (-1, 0, 5, 0.5, 60, 0.0, 6, 0.5, 0),
        (0, 0, 40, 0.0, 50, 0.0, 60, 0.0, 1), (0, 0, 90, 0.05, 3, 1.0, 30, 0.0, 1),
        (0, 0, 25, 0.1, 70, 0.0, 4, 1.0, 1), (0, 0, 18, 0.0, 40, 0.0, 55, 0.0, 1),
        (0, 0, 200, 0.0, 2, 1.0, 2, 1.0, 1), (0, 0, 6, 0.0, 45, 0.0, 50, 0.0, 1),
        (0, 0, 9, 0.0, 30, 0.0, 35, 0.0, 1), (0, 1, 5, 0.0, 4, 1.0, 60, 0.0, 1),
        (0, 1, 7, 0.0, 35, 0.0, 45, 0.0, 1), (0, 0, 60, 0.2, 0, 0.0, 0, 0.0, 1),
        (0, 0, 3, 0.0, 2, 1.0, 2, 1.0, 0), (0, 0, 4, 0.0, 60, 0.0, 2, 1.0, 0),
        (0, 0, 6, 0.0, 3, 0.0, 4, 0.0, 0), (0, 0, 9, 0.0, 2, 0.0, 0, 0.0, 0),
        (0, 0, 1, 1.0, 1, 1.0, 40, 0.0, 0), (0, 0, 12, 0.8, 30, 0.0, 30, 0.0, 0),
        (0, 0, 30, 0.9, 3, 1.0, 3, 1.0, 0), (0, 0, 50, 0.6, 4, 1.0, 20, 1.0, 0),
        (0, 1, 3, 0.0, 2, 1.0, 4, 1.0, 0), (0, 1, 2, 0.0, 6, 0.0, 3, 0.0, 0),
        (0, 0, 5, 0.0, 0, 0.0, 3, 1.0, 0), (0, 0, 2, 0.0, 90, 0.0, 0, 0.0, 0),
    ]
)


class DecisionTree:
    """Axis-parallel splits that lower the Gini impurity most, grown until leaves are pure."""

    def __init__(self, rows: np.ndarray, deepest: int = 8):
        self.nodes: list[tuple[int, float, int, int, int]] = []
        self._grow(rows[:, :-1], rows[:, -1].astype(int), deepest)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        leaf = int(2 * y.sum() >= len(y))
        self.nodes.append((-1, 0.0, at, at, leaf))
        best = (np.inf, 0, 0.0)
        if depth and 0 < y.sum() < len(y):
            for feature in range(x.shape[1]):
                values = np.unique(x[:, feature])
                for cut in (values[:-1] + values[1:]) / 2:
                    low = x[:, feature] <= cut
                    impurity = sum(s.sum() * (len(s) - s.sum()) / len(s) for s in (y[low], y[~low]))
                    best = min(best, (impurity, feature, float(cut)))
        if best[0] < np.inf:
            _, feature, cut = best
            low = x[:, feature] <= cut
            a = self._grow(x[low], y[low], depth - 1)
            b = self._grow(x[~low], y[~low], depth - 1)
            self.nodes[at] = (feature, cut, a, b, leaf)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut, low, high, leaf = (np.array(c) for c in zip(*self.nodes))
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return leaf[node]
            at = node[inner]
            goes_low = x[inner, feature[at]] <= cut[at]
            node[inner] = np.where(goes_low, low[at], high[at])


SEALED = -2


def _attributes(source: str) -> tuple[bool, list[str]]:
    """Whether they hide the element, and the tokens of its class, id and role."""
    hidden, tokens = False, []
    for name, value in ATTRIBUTE.findall(source):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            tokens.extend(value.split())
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden = hidden or value.strip() == "true"
        elif name == "style":
            hidden = hidden or NO_DISPLAY.search(value) is not None
    return hidden, tokens


def _named(tokens: list[str]) -> tuple[bool, bool, set[str]]:
    """Whether a token names main text, whether one does so alone, and the names around it."""
    main, alone, around = False, False, set()
    for token in tokens:
        words = PART.findall(token)
        said = next((k for k, w in enumerate(words) if w in QUALIFIERS), len(words))
        if words and words[-1] in STATES:
            outer = set()
        else:
            outer = AROUND_NAMES.intersection(words[:said])
        mine = MAIN_NAMES.intersection(words[:said])
        # the header of an entry is part of it; main-header and article-sidebar are not
        if mine and outer and outer <= LAYOUT_NAMES and words[-1] not in outer - {"header"}:
            # what is the content of a footer is footer
            if words[-1] != "content" and (mine != {"main"} or words[-1] != "header"):
                outer = set()
        around |= outer
        main = main or bool(mine) and not outer
        alone = alone or bool(mine) and len(words) == 1
    return main, alone, around


def _shuts(tag: str, attributes: str) -> bool:
    """Whether an element that is no container is hidden or names itself an advert or the like."""
    hidden, tokens = _attributes(attributes)
    return hidden or bool(_named(tokens)[2] & (SEALED_NAMES if tag in HEADINGS else AROUND_NAMES - LAYOUT_NAMES))


def _kind(tag: str, attributes: str, inside: int, opened: frozenset[str]) -> int:
    """The region a container opens: 1 main, -1 around, SEALED around whatever is inside, 0 that
    of what it is in. Tags in ``opened`` are no regions of their own."""
    if inside == SEALED or tag == "aside":
        return SEALED
    if inside == -1 and not (opened and tag in MAIN):
        return -1
    hidden, tokens = _attributes(attributes) if attributes else (False, [])
    if hidden and tag not in ("body", "html"):
        return -1
    main, alone, around = _named(tokens)
    if tag in AROUND and tag not in opened and not (tag == "header" and (inside == 1 or main)):
        return SEALED if around & SEALED_NAMES else -1
    if tag in ("body", "html"):
        around = set()
    elif tag == "main":
        around = around & SEALED_NAMES & set(tokens)
    elif tag == "article":
        around = set() if alone else around - LAYOUT_NAMES
    elif main:
        around = around - LAYOUT_NAMES
    if around:
        return SEALED if around & SEALED_NAMES else -1
    if tag in MAIN or main:
        return 1
    return 0


class Page:
    """The flat blocks of one page; tags in ``opened`` are not taken for regions around them."""

    def __init__(self, source: str, opened: frozenset[str] = frozenset()):
        self.texts: list[str] = []
        self.rows: list[tuple[int, int, int, float]] = []  # region, heading, words, density
        self.parts: list[tuple[str, bool]] = []
        self.open: list[tuple[str, int]] = []
        self.opened = opened
        self.heading, self.paragraph = 0, False
        self.found = self.missed = False  # main or article in the open, and within a shut region
        links, at = 0, 0
        muted, depth = "", 0
        for match in TOKEN.finditer(source):
            if match.start() > at and not muted:
                self.parts.append((source[at : match.start()], links > 0))
            at = match.end()
            tag = (match[3] or "").lower()
            if not tag:
                continue
            closes, attributes = bool(match[2]), match[4]
            if muted and tag not in BLOCKS:
                # an inline element that is hidden ends with its own tag
                if tag == muted:
                    depth += -1 if closes else 1
                    muted = muted if depth else ""
                continue
            if tag == "a":
                links = max(0, links - 1) if closes else links + 1
            if tag == "br":
                self.parts.append((" ", False))
            elif tag in BLOCKS:
                self._close_block()
                links, muted = 0, ""
                self.heading = int(tag in HEADINGS and not closes)
                self.paragraph = tag == "p" and not closes
                self._element(tag, closes, attributes)
            elif attributes and not closes and tag not in VOID and _shuts(tag, attributes):
                muted, depth = tag, 1
        if at < len(source) and not muted:
            self.parts.append((source[at:], links > 0))
        self._close_block()

    def _element(self, tag: str, closes: bool, attributes: str) -> None:
        if closes:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    return
                if tag not in CONTAINERS and self.open[k][0] in CONTAINERS:
                    return
            return
        self._end_of_single(tag)
        inside = self._region()
        if tag in CONTAINERS:
            kind = _kind(tag, attributes, inside, self.opened) or inside
            if tag in MAIN:
                self.found = self.found or kind == 1
                self.missed = self.missed or inside == -1
            self.open.append((tag, kind))
        elif attributes and _shuts(tag, attributes):
            self.open.append((tag, SEALED))

    def _end_of_single(self, tag: str) -> None:
        """Elements that end where this one begins, though they have not been closed."""
        if tag in CELLS or tag == "tr":
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "table":
                    break
                if self.open[k][0] in CELLS:
                    del self.open[k:]
                    break
        while self.open and self.open[-1][0] in SINGLE:
            last = self.open[-1][0]
            if last in ("li", "dd", "dt") and tag not in ("li", "dd", "dt"):
                break
            self.open.pop()

    def _region(self) -> int:
        return self.open[-1][1] if self.open else 0

    def _close_block(self) -> None:
        if not self.parts:
            return
        whole = html.unescape("".join([p for p, _ in self.parts])).split()
        if whole:
            region = max(-1, self._region())
            linked = sum(len(html.unescape(p).split()) for p, link in self.parts if link)
            # a paragraph of main text may be one link
            if region == 1 and self.paragraph:
                linked = 0
            self.texts.append(" ".join(whole))
            self.rows.append((region, self.heading, len(whole), min(1.0, linked / len(whole))))
        self.parts = []


LOOKED_INTO = frozenset("form header".split())


def read_page(source: str) -> Page:
    """The blocks of a page, with forms and headers looked into where nothing else has its text."""
    page = Page(source)
    lost = page.missed and not page.found
    if lost or (page.rows and all(region == -1 for region, *_ in page.rows)):
        opened = Page(source, LOOKED_INTO)
        if opened.found or not lost:
            return opened
    return page


def densest_run(rows: list[tuple[int, int, int, float]]) -> tuple[int, int]:
    """The blocks [begin, end) in the open with the most words that are no links; a block costs
    two words."""
    best, run, begin = (0.0, 0, 0), 0.0, 0
    for k, (region, _, words, density) in enumerate(rows):
        worth = words * (1 - 2 * density) - 2 if region >= 0 else -np.inf
        if run <= 0:
            run, begin = 0.0, k
        run += worth
        if run > best[0]:
            best = (run, begin, k + 1)
    return best[1], best[2]


def block_features(rows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Each block's own columns with words and density of its neighbours on the same page."""
    out = np.zeros((len(rows), 8))
    out[:, :4] = rows
    same = owner[1:] == owner[:-1]
    out[1:, 4:6] = np.where(same[:, None], rows[:-1, 2:4], 0)
    out[:-1, 6:8] = np.where(same[:, None], rows[1:, 2:4], 0)
    return out


def main_texts(pages: list[str | None], tree: DecisionTree) -> list[str]:
    read = [read_page(p or "") for p in pages]
    owner = np.repeat(np.arange(len(read)), [len(p.rows) for p in read])
    if not len(owner):
        return [""] * len(read)
    rows = np.array([r for p in read for r in p.rows], float)
    keep = tree.predict(block_features(rows, owner)).astype(bool)
    texts = [t for p in read for t in p.texts]
    kept: list[list[str]] = [[] for _ in read]
    for k in np.flatnonzero(keep).tolist():
        kept[owner[k]].append(texts[k])
    for page, found in zip(read, kept):
        if not found:
            begin, end = densest_run(page.rows)
            found += page.texts[begin:end]
    return ["\n\n".join(t) for t in kept]


def extract_main_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with text and n_chars of the main text of ``html``."""
    columns = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = DecisionTree(LABELLED)
        for batch in slices(batches, "html"):
            texts = main_texts(batch.column("html").to_pylist(), tree)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [*columns, "text", "n_chars"],
            )

    rows = pages.select(*columns, "html")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in columns)
    return rows.mapInArrow(run, f"{kept}, text string, n_chars long")
