"""Main text of web pages by composite text density.

Each page becomes a tree of elements. For every element: C characters and T tags inside it, LC characters and
LT tags inside links. Its composite text density is

    C / T * log(C / LC * T / LT, base ln(C / (C - LC) * LC + LCb / Cb * C + e))

with empty denominators taken as 1, and b for the body. The element whose children's densities have the
largest sum is the centre, on every page; the smallest density on the path from it to the body is the threshold.
The text is the subtree of the centre together with siblings of that path. A sibling is taken if its density

* inside the article (or main) of the centre, reaches the threshold times the share of its characters in links,
  so that short blocks stay and link lists go;
* beyond that article, reaches the density of the article, or it is an h1 of a main around it;
* on a page without one, reaches the threshold, with blocks within and the tag of the path's element, or it is a heading.

Within what is taken, blocks of three links or more are held to the first rule, too.

Elements that are never article text carry no characters and are left out: the tags of `DROPPED`, hidden ones, and
those whose role names a menu, header, footer, sidebar, notice, advert, form or comments. Class and id are features
of the density. An element all of whose class's words name such a part or its shape (`ad-box`) has no characters, so
its density is 0, below any threshold; one with further words (`social-history`) has the density of its text, and
goes if that is below the threshold. A class does not count for an element that holds an article, nor, on a page
without one, for an element of blocks that hold most of the page's text.

Text is decoded; white space inside a block is one blank; blocks are joined by line ends in page order, and
nothing else is dropped or cut. Defined results: null and empty pages, and pages without text, give an empty
text; of equal sums the denser element is the centre, then the first in the page; long pages are read whole, one at a
time; an empty table gives an empty one; rows that repeat are answered as often as they come; null ids and URLs stay; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option datalist dialog menu object audio video canvas map label".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset(("article", "main"))
# Which open elements a start tag ends, up to the nearest of the boundary.
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table", "tbody", "thead", "tfoot"))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset()),
}
CLOSES_P = BLOCKS - frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"))
P_BOUNDARY = frozenset(("table", "td", "th", "button", "body", "article", "section", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidebars "
    "menu menus nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "commentlist disqus respond reply replies footer foot masthead pagination pager toolbar widget widgets skip".split()
)
HEADER_WORDS = frozenset(("header", "topbar"))
SHAPE_WORDS = frozenset(
    "area article bar block body bottom box button buttons center col column container content cta entry fixed form grid group holder "
    "id inner item items js large left link links list lists main message module outer page panel post posts right row section short site "
    "slot small text title top unit wrap wrapper".split()
)
MENU_LINKS = 3

_TAG = re.compile(r"<(?:!--(?:.*?-->|.*\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*+>)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class _Node:
    __slots__ = ("tag", "parent", "children", "noise", "weak", "marked", "chars", "tags", "link_chars", "link_tags", "order")

    def __init__(self, tag: str, parent: _Node | None, order: int) -> None:
        self.tag, self.parent, self.order = tag, parent, order
        self.children: list[_Node] = []
        self.noise = self.weak = self.marked = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0

    def within(self, tags: frozenset[str]) -> _Node | None:
        node: _Node | None = self
        found = None
        while node is not None:
            if node.tag in tags:
                found = node
            node = node.parent
        return found


def _judge(node: _Node, attributes: str) -> None:
    """noise: never article text; marked: so by class or id; weak: by part of one."""
    if node.tag in DROPPED:
        node.noise = True
    in_article = node.parent is not None and node.parent.within(ARTICLES) is not None
    if node.tag == "header" and not in_article:
        node.noise = True
    if not attributes or node.noise:
        return
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            node.noise = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            node.noise = True
        elif name == "role" and value.lower() in ROLES:
            node.noise = node.tag not in ARTICLES
        elif name in ("class", "id") and node.tag not in ("html", "body", "article", "main", *HEADINGS):
            noise = NOISE_WORDS if in_article else NOISE_WORDS | HEADER_WORDS
            for words in ({w.lower() for w in _WORD.findall(x)} for x in value.split()):
                if words & noise:
                    node.weak = True
                    node.marked = node.marked or words <= noise | SHAPE_WORDS


def _tree(html: str) -> tuple[_Node, list[_Node], list[tuple[_Node, str]]]:
    """Root, all nodes in page order, and the pieces of text with the element they stand in."""
    root = _Node("#root", None, 0)
    nodes, pieces, open_ = [root], [], [root]
    at, n = 0, len(html)

    def text(upto: int) -> None:
        if upto > at:
            pieces.append((open_[-1], unescape(html[at:upto])))

    while found := _TAG.search(html, at):
        text(found.start())
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                if tag not in BLOCKS and open_[k].tag in BLOCKS and open_[k].tag != "p":
                    break
            pieces.append((open_[-1], "\n" if tag in BLOCKS else ""))
            continue
        closed, boundary = ENDS.get(tag, (frozenset(), frozenset()))
        if tag in CLOSES_P:
            closed, boundary = closed | {"p"}, boundary | P_BOUNDARY
        if tag in HEADINGS:
            closed = closed | HEADINGS
        if closed:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in closed:
                    del open_[k:]
                    if tag not in ("tr",):
                        break
                elif open_[k].tag in boundary:
                    break
        node = _Node(tag, open_[-1], len(nodes))
        nodes.append(node)
        node.parent.children.append(node)
        _judge(node, found[3])
        pieces.append((node, "\n" if tag in BLOCKS else " " if tag == "br" else ""))
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?![^\\s/>])", re.I).search(html, at)
            at = end.start() if end else n
        open_.append(node)
    text(n)
    return root, nodes, pieces


def _count(nodes: list[_Node], pieces: list[tuple[_Node, str]]) -> None:
    """Characters and tags of every element, those of its parts included and those of noise left out."""
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
    for node, piece in pieces:
        size = len(piece.strip())
        node.chars += size
    for node in reversed(nodes):
        if node.noise or node.marked:
            node.chars = node.tags = node.link_chars = node.link_tags = 0
            continue
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags


def density(node: _Node, body: _Node) -> float:
    c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
    if not c:
        return 0.0
    base = log(c / max(c - lc, 1) * lc + body.link_chars / max(body.chars, 1) * c + e)
    if base <= 1.000001:
        base = 1.000001
    spread = c / max(lc, 1) * t / max(lt, 1)
    return c / t * log(max(spread, 1e-9)) / log(base) if spread > 0 else 0.0


def _unmark(root: _Node, nodes: list[_Node]) -> None:
    """Classes that do not count: of what holds an article, or else most of the text."""
    total = root.chars
    held = set()
    for node in reversed(nodes):
        if (node.tag in ARTICLES or node.order in held) and node.parent is not None:
            held.add(node.parent.order)
    elsewhere = any(n.tag in ARTICLES and n.chars for n in nodes)
    for n in nodes:
        if n.weak and (n.order in held or not elsewhere and 2 * n.chars > total and any(c.tag in BLOCKS for c in n.children)):
            n.weak = n.marked = False


def _bar(node: _Node, threshold: float) -> float:
    """What a block inside an article must reach."""
    return threshold * node.link_chars / max(node.chars, 1)


def _chosen(body: _Node, nodes: list[_Node]) -> tuple[list[_Node], list[float], float]:
    """Roots of the subtrees that are the text, the density of every element, and the threshold."""
    out: list[bool] = []  # noise, or within it
    for node in nodes:
        out.append(node.noise or node.marked or node.parent is not None and out[node.parent.order])
    worth = [0.0 if out[node.order] else density(node, body) for node in nodes]
    sums = [sum(worth[c.order] for c in node.children) for node in nodes]
    inside = [n for n in nodes if n.chars and not out[n.order] and (n is body or n.parent is not None)]
    if not inside:
        return [], worth, 0.0
    centre = max(inside, key=lambda n: (sums[n.order], worth[n.order], -n.order))
    path = [centre]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(worth[n.order] for n in path)
    framed = [n for n in path if n.tag in ARTICLES]
    chosen, left = [centre], None  # the article the path has left
    for node, up in zip(path, path[1:]):
        if left is None and node.tag in ARTICLES:
            left = node
        for other in up.children:
            dense = worth[other.order]
            if other is node or out[other.order] or not other.chars:
                continue
            if left is not None:
                taken = dense >= worth[left.order] or other.tag == "h1" and framed[-1] is not left and up.within(ARTICLES) is not None
            elif framed:
                taken = dense >= _bar(other, threshold)
            else:
                taken = other.tag in HEADINGS or other.tag == node.tag and sums[other.order] > 0 and dense >= threshold
            if taken:
                chosen.append(other)
    return chosen, worth, threshold


def main_text(html: str | None) -> str:
    """Blocks of the page's article, joined by line ends."""
    if not html:
        return ""
    root, nodes, pieces = _tree(html)
    body = next((n for n in nodes if n.tag == "body"), root)
    marked = [n for n in nodes if n.marked]
    for node in marked:
        node.marked = False
    _count(nodes, pieces)
    for node in marked:
        node.marked = True
    _unmark(root, nodes)
    if marked:
        _count(nodes, pieces)
    chosen, worth, threshold = _chosen(body, nodes)
    if not chosen:
        return ""
    roots = {n.order for n in chosen}
    kept: dict[int, bool] = {}
    for node in nodes:  # parents come before their children
        above = node.parent is not None and kept[node.parent.order]
        ok = not node.noise
        if ok and (node.weak or node.marked):
            ok = worth[node.order] >= threshold
        elif ok and above and node.link_tags >= MENU_LINKS and node.tag in BLOCKS:
            ok = worth[node.order] >= _bar(node, threshold)
        kept[node.order] = ok and (above or node.order in roots)
    blocks, line = [], []
    for node, piece in pieces:
        if piece == "\n":
            blocks.append("".join(line))
            line = []
        elif kept[node.order]:
            line.append(piece)
    blocks.append("".join(line))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def with_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch["html"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], texts], names=["page_id", "url", "text"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
