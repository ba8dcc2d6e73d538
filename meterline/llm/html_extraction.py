"""Main text of web pages by tree scoring.

A page is parsed into a tree. Parts that are never main text are cut: scripts, styles, forms, menus,
headers, footers, sidebars, and elements whose class, id or role says so (adverts, notices, comments
and the like), unless a name only tells a state (``comments-open``, ``ad-free``) or goes with other names on an element that holds
most of the text. An ``article`` named as a comment is one. Each paragraph then earns points for its length and commas and passes them to its
ancestors, fewer with each level; the points of a container are discounted by the share of its text
that is links. The container with most points is the main one; inside an ``article`` or ``main`` element it
is that element. Siblings with enough points, or plain text with few links, are kept with it.

Text leaves the tree by blocks in page order: character references are decoded, white space inside a block
becomes one space, blocks are trimmed, empty ones left out, the rest joined by one line break. A line break
element is white space.

Null, empty and tagless pages give their text as it stands (empty for null). Repeated rows and ids are
extracted each on their own; null ids and urls are kept. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from .common import map_texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset((
    "script style noscript template head title nav header footer aside form button input select option textarea label iframe "
    "object embed applet canvas svg math audio video map menu dialog datalist progress meter").split())
BLOCK = frozenset((
    "html body address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption dir menu").split())
#: Elements whose start closes an open paragraph, and those a paragraph cannot be looked for beyond.
ENDS_P = BLOCK - frozenset("html body caption td th tr tbody thead tfoot".split())
SCOPE = frozenset("html body table td th caption button object template".split())
#: Elements of a head; any other one, or text, ends it.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Which open elements a new one closes, if no element of the second kind stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tr", "td", "th"), ("table",)), "option": (("option",), ("select",)),
}
#: Parts of class and id names, and roles, of what is not main text.
UNWANTED = frozenset((
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar aside cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login "
    "pagination pager widget toolbar skip print").split())
#: Those that also name frames around a page (``page-with-sidebar``).
FRAMES = frozenset("nav navbar header masthead footer sidebar aside overlay widget toolbar menu print".split())
#: Those that make an article element a comment.
COMMENTS = frozenset("comment comments reply replies disqus".split())
#: A name with one of these words tells a state of the element (``comments-open``, ``no-sidebar``), not what it is.
STATES = frozenset("open opened closed free enabled disabled allowed active on off no not non without has hide hidden show".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
KEPT = frozenset("html body article main".split())
PARAGRAPH = frozenset("p pre td blockquote li dd".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "attrs", "up", "kids", "points")

    def __init__(self, tag: str, attrs: dict, up: "Node | None"):
        self.tag, self.attrs, self.up, self.kids, self.points = tag, attrs, up, [], 0.0


class _Builder(HTMLParser):
    """Tree of a page; elements left open are closed as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {}, None)
        self.open = [self.root]
        self.depth = Counter()  # open elements by tag; spares the search for one that is not open

    def _close(self, tags, stop) -> None:
        if not any(self.depth[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                self.depth.subtract(n.tag for n in self.open[i:])
                del self.open[i:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "body" or self.open[-1].tag == "head" and tag not in HEAD:
            self._close(("head",), ())
        if tag in ENDS_P:
            self._close(("p",), SCOPE)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close((tag,), ("td", "th") if tag not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot", "body", "html") else ())

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._close(("head",), ())
        self.open[-1].kids.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _nodes(root: Node) -> list[Node]:
    """Elements in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(k for k in reversed(node.kids) if type(k) is Node)
    return out


def _cut(node: Node) -> bool:
    return node.tag in CUT or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" \
        or "display:none" in node.attrs.get("style", "").replace(" ", "").lower()


def _names(node: Node) -> list[set[str]]:
    """The words of each name in class and id that does not tell a state."""
    names = (node.attrs.get("class", "") + " " + node.attrs.get("id", "")).split()
    words = ({x.lower() for x in _NAME.findall(name)} for name in names)
    return [w for w in words if not (w & UNWANTED and w & STATES)]


def _named(node: Node) -> set[str]:
    """Words of class, id and role that name something unwanted."""
    if not node.attrs or node.tag in KEPT and node.tag != "article":
        return set()
    parts = {x for words in _names(node) for x in words & UNWANTED}
    if node.tag == "article":
        return parts if parts & COMMENTS else set()
    return parts | {node.attrs.get("role", "").lower()} & ROLES


def _also(node: Node) -> bool:
    """Whether it has a name without an unwanted word besides."""
    return any(words and not words & UNWANTED for words in _names(node))


def _filter(root: Node, keep) -> None:
    todo = [root]
    while todo:
        node = todo.pop()
        node.kids = [k for k in node.kids if type(k) is str or keep(k)]
        todo.extend(k for k in node.kids if type(k) is Node)


def prune(root: Node) -> None:
    """Cut what is never main text.

    An element that holds the article stays whatever its name. So does one with over half of the text that is left (in an
    article: of the text of that) if its name may be that of a frame around the whole page, or if it has other names
    besides and is not beside an article.
    """
    _filter(root, lambda k: not _cut(k))
    named, also = {k: _named(k) for k in _nodes(root)}, {}
    mains = {k for k in named if k.tag in ("article", "main") and not named[k]}
    scope = {root: root}
    for k in _nodes(root)[1:]:  # parents come first
        scope[k] = k.up if k.up in mains else scope[k.up]
        also[k] = bool(named[k]) and (not mains or scope[k] is not root) and _also(k)
    holds = set()
    for node in mains:
        up = node.up
        while up is not None and up not in holds:
            holds.add(up)
            up = up.up
    _filter(root, lambda k: k in holds or named[k] <= FRAMES or also[k])
    size = _measure(root)
    _filter(root, lambda k: k in holds or not named[k] or 2 * size[k][0] > size[scope[k]][0])


def _measure(root: Node) -> dict[Node, tuple[int, int]]:
    """Of each element: characters of text below, and of those in links."""
    size: dict[Node, tuple[int, int]] = {}
    for node in reversed(_nodes(root)):
        text = link = 0
        for k in node.kids:
            if type(k) is str:
                text += len(k.strip())
            else:
                text, link = text + size[k][0], link + size[k][1]
        size[node] = (text, text if node.tag == "a" else link)
    return size


def _own_text(node: Node) -> str:
    """Text of a paragraph: its own and that of inline elements, not of blocks inside."""
    out, todo = [], list(reversed(node.kids))
    while todo:
        k = todo.pop()
        if type(k) is str:
            out.append(k)
        elif k.tag not in BLOCK:
            todo.extend(reversed(k.kids))
    return "".join(out)


def score(root: Node, size: dict[Node, tuple[int, int]]) -> list[Node]:
    """Give points to containers; those with points, best first (ties: first in the page)."""
    nodes = _nodes(root)
    for node in nodes:
        if node.tag not in PARAGRAPH and not (node.tag in ("div", "section", "article", "main", "body") and any(type(k) is str and k.strip() for k in node.kids)):
            continue
        text = _own_text(node).strip()
        if not text:
            continue
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        up, share = (node.up if node.tag in PARAGRAPH else node), 1.0
        while up is not None and share >= 0.1:
            up.points += points * share
            up, share = up.up, share / 2
    for node in nodes:
        text, link = size[node]
        node.points *= 1 - link / text if text else 0
    return sorted((n for n in nodes if n.points > 0), key=lambda n: -n.points)


def main_nodes(root: Node) -> list[Node]:
    """The main container and the siblings kept with it, in page order."""
    size = _measure(root)
    best = next(iter(score(root, size)), None)
    if best is None:
        return [root]
    up = best
    while up is not None:
        if up.tag in ("article", "main") or up.attrs.get("role", "").lower() in ("main", "article"):
            best = up
            if up.tag == "article":
                break
        up = up.up
    if best.up is None or best.tag in ("body", "html", "main"):
        return [best]
    kept = []
    for k in best.up.kids:
        if k is best:
            kept.append(k)
        elif type(k) is Node and size[k][0]:
            text, link = size[k]
            near = k.points >= max(5.0, 0.2 * best.points)
            plain = best.tag != "article" and k.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "ul", "ol", "table", "figure") and link < 0.25 * text
            if near or plain:
                kept.append(k)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = list(reversed(nodes))
    while todo:
        k = todo.pop()
        if k is None:
            flush()
        elif type(k) is str:
            line.append(k)
        elif k.tag == "br":
            line.append(" ")
        elif k.tag in BLOCK:
            flush()
            todo.append(None)
            todo.extend(reversed(k.kids))
        else:
            todo.extend(reversed(k.kids))
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    prune(root)
    return "\n".join(blocks(main_nodes(root)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def work(pages_html: list[str | None]) -> list:
        texts = [main_text(h) for h in pages_html]
        return [texts, [len(t) for t in texts]]

    return map_texts(pages, "html", ["page_id", "url"], [("text", "string"), ("n_chars", "long")], work)
