"""HTML extraction: flat text blocks, classified by a decision tree.

A page is read once, without a tree: text up to the next block-level tag is a
block.  A block's features are its words and link density and those of its
neighbours, and what it stands in (elements, and names in class and id).  The
tree is trained on the labelled pages of html_samples when it is first needed.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_samples import PAGES
from .shared import only

# Element names of the HTML standard by how they are treated.
RAW = frozenset("script style noscript template textarea title select svg iframe annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr input br".split())
#: Formulas and media are read as inline text; annotations repeat a formula in another notation.
INLINE |= frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd mlabeledtr mspace maction menclose mfenced semantics annotation annotation-xml".split())
INLINE |= frozenset("canvas object audio video source track param embed".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li td th dt dd caption".split())
MAIN = frozenset("article main".split())
BESIDE = frozenset("nav footer aside form menu dialog button fieldset option".split())
#: Elements that end an open element of the same group (a paragraph also ends with any block).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Parts of class, id and role names of main text and of what stands beside it.
MAIN_NAMES = frozenset("article content post entry story main body text".split())
BESIDE_NAMES = frozenset(
    "ad ads advert advertisement adsense sponsor sponsored promo banner cookie cookies consent notice notification alert comment comments disqus reply replies respond sidebar nav navbar navigation menu footer header masthead breadcrumb breadcrumbs share sharing social related recommended newsletter subscribe subscription signup widget popup modal overlay dialog login search pagination pager copyright toolbar".split()
)
#: Parts that say where or in what shape something stands, not what it is; what stands before them counts.
SHAPE_NAMES = frozenset(
    "list lists box area wrap wrapper bar block section container item items left right top bottom inner outer primary secondary global site page form button buttons link links icon icons panel group row col column heading title label thread tree unit slot strip tray zone region module component holder message posts articles stories news body content text main story".split()
)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>"']*)[^>]*+>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_PART = re.compile(r"[a-z]+")


def _names(attributes: str) -> list[list[str]]:
    """The parts of each class, id and role name; a name such as `has-sidebar` tells of something else on the page."""
    names = (n for m in _NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split())
    return [_PART.findall(n) for n in names if not n.startswith(("has-", "with-", "no-", "without-", "is-"))]


def _named_beside(parts: list[str]) -> bool:
    """Whether a name's head, its last part but for those of shape, is one of what stands beside main text.

    So `social-share` and `comment-list` are; `social-policy`, `alert-history` and `sidebar-none` are about something else,
    and a `post-reply` is a post.
    """
    head = next((k for k in range(len(parts) - 1, -1, -1) if parts[k] not in SHAPE_NAMES), -1)
    if head < 0 or parts[head] not in BESIDE_NAMES:
        return False
    return not (parts[head] == "reply" and head and parts[head - 1] in MAIN_NAMES)


@dataclass
class Block:
    text: str
    at: int  # where its text begins in the page
    words: int
    linked: int  # characters inside of links
    tag: str
    main: bool
    beside: bool
    named_main: bool
    named_beside: bool


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page; titles, scripts, styles and comments are left out, so a head with or without an end has no text."""
    out: list[Block] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # tag, main, beside, named main, named beside
    link, linked, begin, at = False, 0, -1, 0

    def take(text: str, place: int) -> None:
        nonlocal begin, linked
        if text:
            if begin < 0 and not text.isspace():
                begin = place + len(text) - len(text.lstrip())
            held.append(text)
            if link:
                linked += len(text.strip())

    def close() -> None:
        nonlocal held, linked, begin, link
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            tag = stack[-1][0] if stack else "body"
            flags = [any(s[k] for s in stack) for k in range(1, 5)]
            out.append(Block(text, begin, len(text.split()), linked, tag, *flags))
        held, linked, begin, link = [], 0, -1, False

    while True:
        found = _TAG.search(page, at)
        take(page[at : found.start() if found else len(page)], at)
        if not found:
            break
        at = found.end()
        ends, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], "")
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not ends:
            if tag in ("select", "svg", "iframe", "textarea"):  # these take room in a line
                held.append(" ")
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else (len(page) if tag in ("script", "style") else at)
            continue
        if tag in INLINE:
            if tag == "a":
                link = not ends
            elif tag == "br":
                held.append(" ")
            continue
        close()
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        if stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS and tag in HEADINGS or stack[-1][0] in CLOSES.get(tag, ())):
            stack.pop()
        if tag == "tr" and stack and stack[-1][0] == "tr":
            stack.pop()
        names = _names(attributes) if attributes and tag not in ("html", "body") else []
        header = tag == "header" and not any(s[0] in MAIN for s in stack)
        stack.append((tag, tag in MAIN, tag in BESIDE or header, any(MAIN_NAMES.intersection(n) for n in names), any(map(_named_beside, names))))
    close()
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "main", "beside", "named_main", "named_beside", "heading", "item", "paragraph", "page_scoped", "in_scope")


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES per block of a page."""
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    words = np.array([b.words for b in found], float)
    density = np.array([min(1.0, b.linked / len(b.text)) for b in found])
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    out[:, 6:10] = [(b.main, b.beside, b.named_main, b.named_beside) for b in found]
    out[:, 10:13] = [(b.tag in HEADINGS, b.tag in ITEMS, b.tag in ("p", "blockquote", "pre")) for b in found]
    own = ~(out[:, 7].astype(bool) | out[:, 9].astype(bool))
    # what the page marks as main: by an element, else by a name, else all of it
    for column in (6, 8):
        marked = out[:, column].astype(bool)
        if (marked & own).any():
            out[:, 13], out[:, 14] = 1, marked
            return out
    out[:, 14] = 1
    return out


@dataclass
class Tree:
    """A binary decision tree as node arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at] > 0.5


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 7, least: int = 1) -> Tree:
    """Splits by the gain in Gini impurity, until nodes are pure or `depth` is reached."""
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, left: int) -> int:
        me, share = len(nodes), float(y[rows].mean())
        nodes.append([0, np.inf, me, me, share])
        best, found = 1e-9, None
        if left and 0 < share < 1:
            for j in range(x.shape[1]):
                order = rows[np.argsort(x[rows, j], kind="stable")]
                v, ones = x[order, j], np.cumsum(y[order])[:-1]
                n = np.arange(1, len(rows))
                cut = (v[1:] > v[:-1]) & (n >= least) & (len(rows) - n >= least)
                total, m = y[rows].sum(), len(rows)
                impurity = ones * (1 - ones / n) + (total - ones) * (1 - (total - ones) / (m - n))
                gain = np.where(cut, total * (1 - total / m) - impurity, -1)
                if len(gain) and gain.max() > best + 1e-9:
                    k = int(gain.argmax())
                    best, found = gain[k], (j, (v[k] + v[k + 1]) / 2)
        if found:
            j, threshold = found
            below = x[rows, j] <= threshold
            nodes[me][:4] = [j, threshold, grow(rows[below], left - 1), grow(rows[~below], left - 1)]
        return me

    grow(np.arange(len(y)), depth)
    f, t, a, b, v = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(f.astype(int), t.astype(float), a.astype(int), b.astype(int), v.astype(float), depth)


def sample_table(pages: list[list[tuple[int, str]]] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """The labelled blocks as features and labels; each page also begins and ends at each of its fragments, if main text is left."""
    x, y = [], []
    for fragments in [p[a:b] for p in pages for a in range(len(p)) for b in range(a + 1, len(p) + 1) if any(label for label, _ in p[a:b])]:
        found = blocks("".join(f for _, f in fragments))
        edges = np.cumsum([len(f) for _, f in fragments])
        x.append(features(found))
        y += [fragments[int(np.searchsorted(edges, b.at, "right"))][0] for b in found]
    return np.concatenate(x), np.array(y, float)


@cache
def default_tree() -> Tree:
    return train_tree(*sample_table())


def _extract(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            pages = [blocks(h) if h else [] for h in some.column("html").to_pylist()]
            table = [features(p) for p in pages]
            keep = tree.predict(np.concatenate(table)) if any(map(len, pages)) else np.zeros(0, bool)
            texts, k = [], 0
            for page in pages:
                texts.append("\n".join(b.text for b, good in zip(page, keep[k : k + len(page)], strict=True) if good))
                k += len(page)
            yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in pages], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks"])


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, text, n_chars and n_blocks (of either kind).

    Main blocks are joined by line feeds.  Null and empty html give an empty text; markup that is cut off is read as far
    as it goes.  Rows that repeat a page_id are read each for itself; other columns are not read; an empty table gives
    no rows.
    """
    tree = tree or default_tree()
    source = only(pages, page_id=F.col("page_id").cast("long"), url=F.col("url").cast("string"), html=F.col("html").cast("string"))
    return source.mapInArrow(lambda b: _extract(b, tree), "page_id long, url string, text string, n_chars long, n_blocks long")
