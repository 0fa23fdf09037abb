"""Main text of web pages: flat text blocks, kept or dropped by a decision tree.

A page becomes a flat list of text blocks. Each has its word count and link density,
those of the block before and after, and what kind of element it stands in. A
decision tree, trained here on a small labelled table, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from monthstar.llm.tables import SLICE_ROWS, kind_of, mapped

# Element names of HTML.
#: Elements whose content is never text of the page: those that hold no markup, and the others.
RAW = ("script", "style", "textarea", "title")
UNSEEN = frozenset("noscript template svg head iframe select button".split())
#: Of the others, those that may hold one of their own kind.
NESTED = frozenset(("svg", "template"))
#: Elements that a head may hold; any other one ends it.
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript template".split())
#: Elements that end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that hold other blocks and tell what these are.
CONTAINERS = frozenset("article aside div dialog footer form header main menu nav section ul ol".split())
#: Elements, and words in a class, id or role, that stand for menus, adverts, notices, comments and the like.
ASIDE_ELEMENTS = frozenset("aside dialog footer form menu nav".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie "
    "cookies copyright disclaimer footer header login masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo related reply replies share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)
#: Elements and words of which an article or main element inside is no part: they may also name a whole page's layout.
LAYOUT_ELEMENTS = frozenset("dialog form header".split())
LAYOUT_WORDS = frozenset(
    "banner breadcrumb breadcrumbs complementary contentinfo copyright footer header login masthead menu modal nav "
    "navbar navigation notice popup reply sidebar signup toolbar widget".split()
)
#: Words that make a name a state of something else, as in "has-sidebar" and "comments-open".
STATES = frozenset("closed disabled enabled has hide is no off on open show with without".split())
_RAW = "|".join(RAW)
#: What a tag holds up to its end; a bracket inside quotes is part of a value.
_INSIDE = r"""(?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+"""
_PIECE = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?:{_RAW})(?:/|\s(?:[^<>]*[\s"'])?/)>|<({_RAW})(?![A-Za-z0-9:-]){_INSIDE}>.*?(?:</\1\s*>|\Z)"""
    rf"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)({_INSIDE})>|<[!?][^<>]*+>",
    re.S | re.I,
)
#: Attributes of a tag that closes itself; a slash at the end of a value without quotes belongs to the value.
_CLOSED = re.compile(r"""(?:\A|[\s"'])[^\s"'=]*/\Z""")
#: Letters of scripts without spaces: one to a word (Chinese, Japanese), and several to a word (Thai, Lao, Burmese, Khmer).
_LETTER_WORD = re.compile("[\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_LETTER_PART = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff]")
LETTERS_A_WORD = 4
_LABEL = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL_WORD = re.compile(r"[a-z]+")

#: Columns of the labelled table.
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "main", "aside", "item",
)
#: Labelled blocks: the features as above, and 1 for main text. ``links`` are shares of words in links;
#: ``main``, ``aside`` and ``item`` say whether the block is inside an article, an aside element, a list item.
TABLE = (
    # menus and link lists
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 1, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 1, 0), (1, 1.0, 1, 1.0, 9, 0.0, 0, 1, 1, 0),
    (1, 1.0, 1, 1.0, 2, 1.0, 0, 0, 1, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0, 0, 1, 0), (6, 1.0, 5, 1.0, 7, 1.0, 0, 0, 0, 0),
    (9, 0.8, 40, 0.0, 6, 1.0, 0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 1, 1, 1, 0), (4, 1.0, 90, 0.0, 4, 1.0, 1, 1, 1, 0),
    # adverts, notices, forms, page headers and footers
    (8, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (40, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (12, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0, 0),
    (3, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 0), (25, 0.1, 0, 0.0, 3, 1.0, 0, 1, 0, 0), (30, 0.0, 70, 0.0, 30, 0.0, 1, 1, 0, 0),
    (55, 0.0, 40, 0.0, 50, 0.0, 0, 1, 0, 0), (2, 0.0, 1, 1.0, 1, 0.0, 0, 1, 0, 0), (5, 0.2, 0, 0.0, 1, 1.0, 0, 1, 0, 0),
    (4, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 6, 0.0, 0, 0, 0, 0),
    (4, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 0),
    # article text, long and short, with and without links
    (9, 0.0, 8, 0.0, 60, 0.0, 1, 0, 0, 1), (60, 0.0, 9, 0.0, 40, 0.0, 1, 0, 0, 1), (1, 0.0, 60, 0.0, 80, 0.0, 1, 0, 0, 1),
    (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 0, 1), (120, 0.05, 40, 0.0, 12, 0.0, 1, 0, 0, 1), (7, 0.0, 90, 0.0, 9, 0.0, 1, 0, 1, 1),
    (15, 0.4, 30, 0.0, 30, 0.0, 1, 0, 1, 1), (3, 0.0, 40, 0.1, 5, 0.0, 1, 0, 1, 1), (1, 1.0, 50, 0.0, 60, 0.0, 1, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (6, 1.0, 30, 0.0, 8, 0.0, 1, 0, 1, 1), (50, 0.0, 40, 0.0, 2, 1.0, 1, 0, 0, 1),
    (2, 0.0, 60, 0.0, 1, 1.0, 1, 0, 0, 1), (8, 0.0, 1, 1.0, 30, 0.0, 1, 0, 0, 1), (5, 1.0, 4, 1.0, 6, 1.0, 1, 0, 1, 1),
    (3, 1.0, 3, 1.0, 3, 1.0, 1, 0, 1, 1), (12, 0.0, 3, 1.0, 3, 1.0, 1, 0, 0, 1), (1, 0.0, 2, 1.0, 2, 1.0, 1, 0, 0, 1),
    # on pages that mark no article: short blocks inside running text, and texts inside link lists
    (4, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (3, 0.0, 80, 0.0, 70, 0.0, 0, 0, 0, 1), (2, 0.0, 35, 0.0, 40, 0.0, 0, 0, 0, 1),
    (8, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (9, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (14, 0.1, 3, 1.0, 4, 1.0, 0, 0, 0, 0),
    # longer text of pages that mark no article
    (200, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (60, 0.0, 0, 0.0, 80, 0.0, 0, 0, 0, 1),
    (45, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1), (70, 0.0, 30, 0.0, 4, 0.0, 0, 0, 0, 1), (500, 0.02, 3, 0.0, 2, 1.0, 0, 0, 0, 1),
    (40, 0.0, 8, 0.0, 60, 0.0, 0, 0, 0, 1), (80, 0.1, 40, 0.0, 9, 0.0, 0, 0, 0, 1), (25, 0.0, 90, 0.0, 30, 0.0, 0, 0, 0, 1),
    (18, 0.0, 50, 0.0, 45, 0.0, 0, 0, 0, 1), (30, 0.2, 2, 1.0, 70, 0.0, 0, 0, 0, 1), (20, 0.0, 30, 0.0, 25, 0.0, 0, 0, 1, 1),
    (9, 0.0, 45, 0.0, 60, 0.0, 0, 0, 0, 1), (7, 0.0, 70, 0.0, 35, 0.0, 0, 0, 0, 1),
)
#: By rule: inside an article any size beside any neighbour is text, inside an aside element none is.
SIZES, NEIGHBOURS = (1, 3, 6, 12, 40, 150), ((0, 0.0), (2, 0.0), (60, 0.0), (2, 1.0))
RULED = tuple(
    (words, 0.0, *before, *after, main, aside, 0, main * (1 - aside))
    for words in SIZES
    for before in NEIGHBOURS
    for after in NEIGHBOURS
    for main, aside in ((1, 0), (0, 1), (1, 1))
)
#: Depth of the tree at most.
DEPTH = 7


def _grown(rows: np.ndarray, labels: np.ndarray, depth: int, nodes: list) -> int:
    """Adds the node for ``rows`` and those below it; the best split by Gini impurity."""
    place = len(nodes)
    share = labels.mean()
    nodes.append([-1, 0.0, -1, -1, share])
    if depth == 0 or share in (0.0, 1.0):
        return place
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, feature] <= cut
            impurity = sum(len(y) * y.mean() * (1 - y.mean()) for y in (labels[left], labels[~left]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, cut)
    if best is None:
        return place
    _, feature, cut = best
    left = rows[:, feature] <= cut
    nodes[place][:2] = feature, cut
    nodes[place][2] = _grown(rows[left], labels[left], depth - 1, nodes)
    nodes[place][3] = _grown(rows[~left], labels[~left], depth - 1, nodes)
    return place


@cache
def tree() -> tuple[np.ndarray, ...]:
    """The trained tree as arrays: feature (-1: leaf), cut, left, right, share of main text."""
    table = np.array([*TABLE, *RULED], dtype=float)
    nodes: list = []
    _grown(table[:, :-1], table[:, -1], DEPTH, nodes)
    columns = list(zip(*nodes))
    return tuple(np.array(c) for c in columns)


def classify(rows: np.ndarray) -> np.ndarray:
    """Which blocks are main text; all rows go down the tree together."""
    feature, cut, left, right, share = tree()
    at = np.zeros(len(rows), dtype=int)
    for _ in range(DEPTH):
        inner = feature[at] >= 0
        goes = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= cut[at]
        at = np.where(inner, np.where(goes, left[at], right[at]), at)
    return share[at] >= 0.5


def _aside(name: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """Whether a container is aside of the main text, and whether an article inside it is so too.

    Inside an article, and of an article itself, a name counts only as a whole, or where each of its words does; a
    word that stands for other people's text counts in any name inside an article.
    """
    if name in ASIDE_ELEMENTS or name == "header" and not in_main:
        return True, name not in LAYOUT_ELEMENTS
    aside = deep = False
    for groups in _LABEL.findall(attributes) if "=" in attributes and name != "main" else ():
        for token in "".join(groups).lower().split():
            words = set(_LABEL_WORD.findall(token))
            found = words & ASIDE_WORDS
            if not found or words & STATES:
                continue
            if (in_main or name == "article") and words != found and (name == "article" or found <= LAYOUT_WORDS):
                continue
            aside, deep = True, deep or not found <= LAYOUT_WORDS
    return aside, deep


def count_words(text: str) -> int:
    """Words between white space; where a script has no spaces, its letters are counted."""
    if text.isascii():
        return len(text.split())
    rest, ones = _LETTER_WORD.subn(" ", text)
    rest, parts = _LETTER_PART.subn(" ", rest)
    if not ones and not parts:
        return len(text.split())
    return ones + -(-parts // LETTERS_A_WORD) + sum(any(map(str.isalnum, word)) for word in rest.split())


def unseen_ends(pieces: list[re.Match]) -> dict[int, int]:
    """The piece that ends each unseen element, by the piece that begins it; none where no end tag belongs to it.

    An end tag does not belong to an element whose container ended before it, nor
    to one inside which another of its kind began that cannot stand there, nor to
    a head after an element of the body.
    """
    ends: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def drop(k: int) -> None:
        for name, _ in open_[k:]:
            count[name] -= 1
        del open_[k:]

    def last(name: str) -> int:
        return next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name)

    for at, m in enumerate(pieces):
        if m[3] is None:
            continue
        name = m[3].lower()
        if not m[2] and open_ and open_[-1][0] == "head" and name not in HEAD:
            drop(len(open_) - 1)
        if name not in UNSEEN and name not in CONTAINERS:
            continue
        if m[2]:
            if count.get(name):
                k = last(name)
                if name in UNSEEN:
                    ends[open_[k][1]] = at
                drop(k)
        elif name in CONTAINERS or not _CLOSED.search(m[4]):
            if name in UNSEEN and name not in NESTED and count.get(name):
                drop(last(name))
            open_.append((name, at))
            count[name] = count.get(name, 0) + 1
    return ends


def blocks(page: str) -> tuple[list[str], list[list[float]]]:
    """Texts of the page's blocks in order, and ``words, links, main, aside, item`` of each.

    Unseen elements run to their end tag; without one a head ends at once, for its
    parts are unseen by themselves, and the others at the next element that ends a block.
    """
    out: list[str] = []
    facts: list[list[float]] = []
    open_: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    linked = words = 0
    in_link = item = False
    done = 0

    def text(piece: str) -> None:
        nonlocal linked, words
        if piece:
            if "&" in piece:
                piece = html.unescape(piece)
            parts.append(piece)
            n = count_words(piece)
            words += n
            linked += n * in_link

    def flush() -> None:
        nonlocal linked, words
        line = " ".join("".join(parts).split())
        if line:
            main, aside = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
            out.append(line)
            facts.append([words, linked / words if words else 0.0, main, aside, item])
        parts.clear()
        linked = words = 0

    pieces = list(_PIECE.finditer(page))
    ends = unseen_ends(pieces)
    until, to_block = -1, False
    for at, m in enumerate(pieces):
        if at > until and not to_block:
            text(page[done : m.start()])
        done = m.end()
        if m[3] is None or at <= until:
            continue
        name = m[3].lower()
        closing = bool(m[2])
        if name in UNSEEN:
            if at in ends:
                until = ends[at]
            elif not closing and name != "head" and not _CLOSED.search(m[4]):
                to_block = True
        elif name == "a":
            in_link = not closing
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK:
            to_block = False
            flush()
            in_link = False
            if name == "li":
                item = not closing
            elif name in ("ul", "ol") and closing:
                item = False
            if name in CONTAINERS:
                if not closing:
                    main, aside, deep = open_[-1][1:] if open_ else (False, False, False)
                    if name in ("article", "main"):
                        # What is aside of a page's layout only does not reach into these.
                        deep = deep and name == "article"
                        aside, main = deep, main or name == "main" or not deep
                    of_own = _aside(name, m[4], main)
                    open_.append((name, main or name == "article", aside or of_own[0], deep or of_own[1]))
                else:
                    for k in range(len(open_) - 1, -1, -1):
                        if open_[k][0] == name:
                            del open_[k:]
                            break
    if not to_block:
        text(page[done:])
    flush()
    return out, facts


def main_texts(pages: list[str | None]) -> list[str]:
    """The main text of each page, blocks joined by a line feed; empty where there is none."""
    found = [blocks(page) if page else ([], []) for page in pages]
    rows = []
    for _, facts in found:
        for k, (words, links, main, aside, item) in enumerate(facts):
            before = facts[k - 1][:2] if k else (0, 0.0)
            after = facts[k + 1][:2] if k + 1 < len(facts) else (0, 0.0)
            rows.append((words, links, *before, *after, main, aside, item))
    keep = classify(np.array(rows, dtype=float)).tolist() if rows else []
    out, at = [], 0
    for lines, _ in found:
        out.append("\n".join(line for line, kept in zip(lines, keep[at : at + len(lines)]) if kept))
        at += len(lines)
    return out


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(id, url, text, n_chars)`` of every page.

    A null or empty page has an empty text. Repeated rows and null ids and
    addresses keep one result row each; other columns are not read. Markup that
    ends early or is closed in the wrong order is read as far as it goes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = main_texts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(found, pa.string()),
                        pa.array([len(t) for t in found], pa.int64()),
                    ],
                    names=[id_col, url_col, "text", "n_chars"],
                )

    return pages.select(id_col, url_col, html_col).transform(
        mapped,
        run,
        f"`{id_col}` {kind_of(pages, id_col)}, `{url_col}` {kind_of(pages, url_col)}, text string, n_chars long",
    )
