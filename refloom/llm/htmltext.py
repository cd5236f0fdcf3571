"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is cut into flat text blocks at its block-level tags. A block is described by its
number of words and its link density (share of words inside links), those of the block
before and after it, whether it is a heading, and the kind of container it stands in
(none known, an article or what is named like one, page furniture such as a menu or a footer). A decision tree
trained on the small table ``LABELLED`` says which blocks are main text. All work is
done within the page's row, in tasks: no shuffle, memory bounded by the longest page.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import add_from_text, fresh

# --- page to blocks -------------------------------------------------------------------------------

#: One piece of markup. Every branch ends at its delimiter or at the end of the page, so
#: a page is read once, however broken its markup is.
_MARKUP = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
)
_ATTR = re.compile(r"([^\s=/\"'<>]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>]++)))?+")

#: Elements whose content is no text of the page, up to their end tag.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp svg math object template canvas audio video".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Block tags without content of their own.
_CUTS = frozenset(["hr"])
_SPACE = frozenset(["br", "wbr", "input", "img"])
#: A start tag of the key ends an open element of these names at the top of the stack.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}

OPEN, HINTED, MAIN, FURNITURE, CLOSED = range(5)
"""Containers: none known; named like an article; an article; page furniture an article may still stand in; furniture
for good."""

_FURNITURE_TAGS = frozenset("nav footer aside menu dialog button select search label".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar".split())
#: Words in class names and ids that mark page furniture.
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer footer form gdpr legal login menu menubar modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination paywall popup promo promotion recommended recommendations related search share sharing sidebar signin signup skip social "
    "socials sponsor sponsored subscribe subscription toolbar topbar trending widget widgets".split()
)
_PAGE_HEAD_WORDS = frozenset("header masthead".split())
_ARTICLE_WORDS = frozenset("article articlebody content entry maincontent post story".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus discussion feedback replies reply respond".split())
_NEGATED = frozenset("has with no not without is".split())


def _marks(attrs: str) -> tuple[set[str], str, bool]:
    """Words of class and id, the role, and whether the element is hidden."""
    words: set[str] = set()
    role, hidden = "", False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), _html.unescape(m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for name in value.split():
                parts = re.findall(r"[^\W_]+", name)
                if parts and parts[0] not in _NEGATED:
                    words.update(parts)
        elif key == "role":
            role = value.strip()
        elif key == "hidden" or (key == "aria-hidden" and value.strip() == "true"):
            hidden = True
        elif key == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value):
            hidden = True
    return words, role, hidden


def _inside(outer: int, name: str, attrs: str) -> int:
    """The container that an element's content stands in."""
    if outer == CLOSED or name in _FURNITURE_TAGS:
        return CLOSED
    words, role, hidden = _marks(attrs) if attrs and not attrs.isspace() else (set(), "", False)
    if name in ("html", "body"):
        return outer
    if hidden or role in _FURNITURE_ROLES or (name != "main" and words & _COMMENT_WORDS):
        return CLOSED
    if name in ("main", "article") or role in ("main", "article"):
        return MAIN
    if name == "header" or words & _PAGE_HEAD_WORDS:
        return outer if outer in (HINTED, MAIN) else CLOSED if name == "header" else FURNITURE
    if name == "form" or words & _FURNITURE_WORDS:
        return FURNITURE
    return HINTED if outer == OPEN and words & _ARTICLE_WORDS else outer


class Block(NamedTuple):
    text: str
    words: int
    density: float  # share of the words that stand inside links
    heading: bool
    container: int


def text_blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page in page order, white space collapsed, references decoded once."""
    blocks: list[Block] = []
    stack: list[tuple[str, int]] = []
    open_names: Counter = Counter()
    parts: list[str] = []
    linked: list[str] = []
    links = pos = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            words = "".join(parts).split()
            if words:
                inside = min(len("".join(linked).split()), len(words))
                name, container = next(((n, c) for n, c in reversed(stack[-4:]) if n[0] == "h" and n[1:].isdigit()), ("", stack[-1][1] if stack else OPEN))
                blocks.append(Block(" ".join(words), len(words), inside / len(words), bool(name), container))
            parts, linked = [], []

    def pop() -> None:
        open_names[stack.pop()[0]] -= 1

    def text(raw: str) -> None:
        if raw:
            said = _html.unescape(raw) if "&" in raw else raw
            parts.append(said)
            if links:
                linked.append(said)

    while True:
        m = _MARKUP.search(page, pos)
        text(page[pos : m.start() if m else len(page)])
        if not m:
            break
        pos = m.end()
        if m["name"] is None:
            continue
        name, ends = m["name"].lower(), bool(m["end"])
        if name in _RAW:
            if not ends and not m["attrs"].endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, pos)
                pos = close.start() if close else len(page)
        elif name == "a":
            links = 0 if ends else 1
            if not ends and linked:
                linked.append(" ")
        elif name in _SPACE:
            parts.append(" ")
            if links:
                linked.append(" ")
        elif name in _CUTS:
            flush()
        elif name in _BLOCKS:
            flush()
            if not ends:
                if stack and stack[-1][0] == "p":
                    pop()
                while stack and stack[-1][0] in _ENDS.get(name, ()):
                    pop()
                stack.append((name, _inside(stack[-1][1] if stack else OPEN, name, m["attrs"])))
                open_names[name] += 1
                links = 0
            elif open_names[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
    flush()
    return blocks


# --- the tree -------------------------------------------------------------------------------------

FEATURES = ("container", "heading", "words", "density", "words_before", "density_before", "words_after", "density_after")

#: The labelled table: a block in no known container (FEATURES without the container), then whether it is main text.
#: ``labelled_rows`` files each row again as a block of the other containers.
LABELLED = """
0   3 1.00   0 0.00   4 1.00  0
0   2 1.00   3 1.00   3 1.00  0
0   6 1.00   2 1.00  12 0.00  0
0   1 1.00   1 1.00  45 0.05  0
0  14 0.90   3 1.00   9 0.80  0
0  25 0.85  30 0.90  20 0.95  0
0  60 0.80  12 0.90  10 0.90  0
0  18 0.60   9 0.70   4 1.00  0
0   9 0.50  60 0.02   7 0.60  0
0  30 0.70  40 0.10  28 0.10  0
0   6 0.90  50 0.00  45 0.00  0
0   4 0.00   5 1.00   3 1.00  0
0   8 0.00   3 1.00   6 0.00  0
0  12 0.00   2 1.00   3 0.50  0
0   5 0.20   0 0.00   3 1.00  0
0   9 0.00   4 1.00   7 0.00  0
0   2 0.00   0 0.00   2 0.00  0
0   3 0.00   2 0.00   4 0.00  0
0   7 0.00   4 0.00   2 1.00  0
0   8 0.00   6 0.00   7 0.00  0
0   6 0.00   4 1.00  12 0.00  0
0   3 0.00   2 0.00  10 0.00  0
0  10 0.10   3 0.00   0 0.00  0
0   6 0.00  70 0.00   0 0.00  0
0   9 0.00  55 0.03   3 1.00  0
0  11 0.00  40 0.00   5 0.90  0
0  45 0.05   3 1.00  60 0.00  1
0  80 0.00  70 0.02  50 0.10  1
0 150 0.10   2 1.00   8 0.00  1
0  22 0.00  40 0.00  35 0.05  1
0  30 0.20  25 0.10  28 0.00  1
0  24 0.05   5 0.00   3 0.00  1
0  26 0.04   4 0.00   2 0.00  1
0  19 0.00   5 0.00  60 0.00  1
0  28 0.05  45 0.00   3 1.00  1
0  25 0.00   2 0.00   9 0.00  1
0  33 0.10   4 1.00   3 1.00  1
0  60 0.00  80 0.00   0 0.00  1
0  35 0.00   0 0.00   0 0.00  1
0  40 0.25   6 0.00   3 1.00  1
0  27 0.00   3 0.00   4 0.90  1
0   9 0.00  50 0.00  48 0.00  1
0   5 0.00  33 0.00  70 0.05  1
0   2 0.00  26 0.04  24 0.00  1
0  12 0.30  24 0.00  90 0.00  1
0   2 0.00  30 0.00  25 0.00  1
0  15 0.10  28 0.00  40 0.00  1
0   8 0.00  12 0.00  40 0.00  1
1   5 0.00   3 1.00  60 0.00  1
1   9 0.00   0 0.00  45 0.05  1
1   4 0.00  55 0.00  70 0.00  1
1   3 0.00   4 0.00  26 0.04  1
1   7 0.10   8 0.00  30 0.00  1
1   3 0.00  24 0.00  20 0.05  1
1   5 0.00   0 0.00  16 0.00  1
1   2 0.00   3 1.00  19 0.00  1
1   4 0.00  18 0.00  15 0.00  1
1   2 0.00  40 0.00   3 1.00  0
1   3 0.00   6 1.00   4 1.00  0
1   4 1.00   3 1.00   6 0.90  0
1   3 0.00   0 0.00   2 1.00  0
"""


class Split(NamedTuple):
    """Blocks whose feature is at most the threshold go to ``low``; a leaf is a bool."""

    feature: int
    threshold: float
    low: Split | bool
    high: Split | bool


def _impurity(labels: Sequence[int]) -> float:
    p = sum(labels) / len(labels)
    return len(labels) * p * (1 - p)


def fit_tree(rows: Sequence[Sequence[float]], labels: Sequence[int], depth: int = 8) -> Split | bool:
    """A binary tree by Gini impurity; ties go to the feature listed first, then to the smaller threshold."""
    if depth == 0 or len(set(labels)) < 2:
        return 2 * sum(labels) >= len(labels) > 0
    best = None
    for k in range(len(rows[0])):
        values = sorted({r[k] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            at = (low + high) / 2
            below = [y for r, y in zip(rows, labels, strict=True) if r[k] <= at]
            above = [y for r, y in zip(rows, labels, strict=True) if r[k] > at]
            cost = round(_impurity(below) + _impurity(above), 9)
            if best is None or cost < best[0]:
                best = (cost, k, at)
    if best is None:
        return 2 * sum(labels) >= len(labels)
    _, k, at = best
    sides = [[(r, y) for r, y in zip(rows, labels, strict=True) if (r[k] > at) == above] for above in (False, True)]
    return Split(k, at, *(fit_tree([r for r, _ in s], [y for _, y in s], depth - 1) for s in sides))


def says(tree: Split | bool, row: Sequence[float]) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.threshold else tree.high
    return tree


def labelled_rows(table: str = LABELLED) -> tuple[list[list[float]], list[int]]:
    """Rows and labels of a table like ``LABELLED``: what it says holds where no container is known; in one
    named like an article blocks that are not mostly links are main text too, in an article all are, in page
    furniture none is."""
    rows = [[float(x) for x in line.split()] for line in table.split("\n") if line.strip()]
    of = {OPEN: lambda r: r[-1], HINTED: lambda r: r[-1] or r[2] < 0.5, MAIN: lambda r: 1, FURNITURE: lambda r: 0}
    filed = [([c, *r[:-1]], int(label(r))) for c, label in of.items() for r in rows]
    return [r for r, _ in filed], [y for _, y in filed]


@lru_cache(maxsize=4)
def trained_tree(table: str = LABELLED) -> Split | bool:
    return fit_tree(*labelled_rows(table))


def features(blocks: Sequence[Block]) -> list[tuple[float, ...]]:
    none = Block("", 0, 0.0, False, OPEN)
    around = [none, *blocks, none]
    return [
        (min(b.container, FURNITURE), b.heading, b.words, b.density, a.words, a.density, c.words, c.density)
        for a, b, c in zip(around, around[1:], around[2:], strict=False)
    ]


def main_text(page: str, tree: Split | bool) -> str:
    blocks = text_blocks(page)
    return "\n".join(b.text for b, row in zip(blocks, features(blocks), strict=True) if says(tree, row))


def extract_main_text(pages: DataFrame, html_col: str = "html", into: str = "text", labelled: str = LABELLED) -> DataFrame:
    """``pages`` plus ``into``: the main text of the page, its blocks joined by a line break.

    Every page keeps its row, repeated rows too. A null or empty page, and one without
    main text, gives an empty text. A column that has the name of ``into`` already, in any
    case, is replaced (also the page itself). Other columns pass through untouched, and an
    empty table gives an empty one. Pages are read whole, in time linear in their length.
    """
    tree = trained_tree(labelled)
    got = fresh(pages, "extracted")

    def make():
        return lambda texts: {got: [main_text(t, tree) for t in texts]}

    out = add_from_text(pages, html_col, f"`{got}` string", make)
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() != into.lower()]
    return out.select(*kept, F.col(f"`{got}`").alias(into))
