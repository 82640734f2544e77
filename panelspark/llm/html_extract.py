"""Main text of web pages by scoring the element tree.

Every run of text in a block gives points for its length and commas to the element that holds the block and, less and
less, to the ancestors; an element's points are discounted by the share of its text that stands in links. The element
with the most points is the container; it is widened to an enclosing article or main element, else to the page. In that, what
stands beside the container is kept unless a quarter of it is links, and lists in the container unless they are links.

Only scripts, styles, forms, menus, page headers, footers, asides and what is hidden are dropped by their tag or role. A word of a
class or id drops nothing by itself: it lowers the points below an element, so that another one becomes the container, and
an element so lowered that doesn't hold the container is weighed against it. Words that parts of an article bear as well
lower little, and not at all on headings and paragraphs; in the container or its article such an element goes only if half of it is links, or it
is a line without a block.

A page is parsed in the task that reads it, from left to right in time linear in its length; nothing is shuffled or gathered, and memory is a page's tree.

Defined results: null, empty or markup-only html gives an empty text; white space in a block (no-break spaces too) becomes
one space, ``<br>`` is white space; what follows a tag, quote or comment that is never closed is part of it; blocks are joined by ``\\n`` in page order; end tags without a start are passed over; very long
pages are read whole; of elements with equal points the outer one, then the first, is the container; repeated rows and null
ids give a row each; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import checked

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template nav aside footer form button select textarea iframe object svg canvas math head title dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
TEXT_BLOCKS = frozenset("p li td th pre blockquote h1 h2 h3 h4 h5 h6 dt dd figcaption caption".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer copyright comment comments disqus respond replies discussion share sharing social "
    "related recommended newsletter subscribe subscription signup login search pagination pager toolbar".split()
)
#: Words that name parts of an article as well.
AMBIGUOUS = frozenset("header discussion search notice notices alert share sharing related comment banner promotion notification social menu toolbar widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What the points below an element are multiplied by, for a doubt of 0, 1 (an ambiguous word), 2.
LOWER = (1.0, 0.25, 0.02)
#: Elements whose readers' comments are boxes or items of a list.
BOXES = frozenset("div li ul ol dl section article".split())
#: Start tags that end an open element of the first set, looked for up to one of the second.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = frozenset("article aside body div section main td th li table ul ol dl blockquote header footer nav form html button".split())
WORD = re.compile("[a-z0-9]+")
#: Elements whose content is no markup up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
TAG = re.compile(r"[A-Za-z][^\s/>]*")
NAME = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)?")
VALUE = re.compile(r"\s*=\s*([^\s>\"'][^\s>]*|(?=[\"'])|(?=>))")


class Node:
    __slots__ = ("tag", "kind", "parent", "children", "drop", "doubt", "score", "points", "chars", "linked", "links", "block", "weight")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, doubt: int = 0, kind: str = ""):
        self.kind = f"{tag} {kind}"
        self.tag, self.parent, self.drop, self.doubt = tag, parent, drop, doubt
        self.children: list[Node | str] = []
        self.score = self.points = self.chars = self.linked = self.links = 0
        self.block, self.weight = tag in TEXT_BLOCKS, 1.0


def _attributes(html: str, i: int) -> tuple[list[tuple[str, str | None]], int]:
    """Attributes of a tag from ``i`` on, and the place after its ``>``; -1 if the page ends before."""
    found = []
    while True:
        m = NAME.match(html, i)
        i = m.end()
        if i == len(html):
            return found, -1
        if m[1] is None:
            return found, i + 1  # what stops a name is the end of the tag
        value = None
        if v := VALUE.match(html, i):
            i = v.end()
            value = v[1]
            if i < len(html) and html[i] in "\"'" and not value:
                end = html.find(html[i], i + 1)
                if end < 0:
                    return found, -1
                value, i = html[i + 1 : end], end + 1
        found.append((m[1].lower(), unescape(value) if value else value))


class Tree:
    """Elements and texts of a page, with the end tags that HTML lets authors leave out. Each tag takes constant time or closes elements.

    The page is read once from left to right. A tag or comment that the page ends in takes the rest of the page with it.
    """

    def __init__(self):
        self.root = Node("root", None)
        self.open = [self.root]
        #: Places in ``open`` of each tag, of elements that are not inline, of scopes.
        self.places: dict[str, list[int]] = {}
        self.blocks, self.scopes = [0], [0]

    def feed(self, html: str) -> None:
        i, n = 0, len(html)
        while i < n:
            j = html.find("<", i)
            if j < 0:
                j = n
            elif not (html[j + 1 : j + 2].isascii() and html[j + 1 : j + 2].isalpha() or html[j + 1 : j + 2] in ("/", "!", "?")):
                j += 1  # no markup
            if j > i:
                self.handle_data(unescape(html[i:j]))
                i = j
                continue
            if html.startswith("<!--", i):
                short = next((len(x) for x in ("<!-->", "<!--->") if html.startswith(x, i)), 0)
                end = html.find("-->", i + 4)
                i = i + short if short else n if end < 0 else end + 3
            elif html[i + 1] in "!?" or not TAG.match(html, i + 1 + (html[i + 1] == "/")):
                end = html.find(">", i)
                i = n if end < 0 else end + 1
            else:
                closing = html[i + 1] == "/"
                name = TAG.match(html, i + 1 + closing)
                tag = name[0].lower()
                attrs, i = _attributes(html, name.end())
                if i < 0:
                    return
                if closing:
                    self.handle_endtag(tag)
                    continue
                self.handle_starttag(tag, attrs)
                if html[i - 2] == "/" and tag not in VOID:
                    self.handle_endtag(tag)
                elif tag in RAW:
                    end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, i)
                    if end is None:
                        return
                    if end.start() > i:
                        self.handle_data(html[i : end.start()] if tag in ("script", "style") else unescape(html[i : end.start()]))
                    i = end.start()

    def _close_from(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()
        for places in (self.blocks, self.scopes):
            while places[-1] >= place:
                places.pop()

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE and self._last(("p",)) > self.scopes[-1]:
            self._close_from(self._last(("p",)))
        if tag in CLOSES:
            tags, until = CLOSES[tag]
            if self._last(tags) > self._last(until):
                self._close_from(self._last(tags))
        inside = bool(self.places.get("article") or self.places.get("main"))
        node = Node(tag, self.open[-1], *_judged(tag, attrs, inside), " ".join(sorted((dict(attrs).get("class") or "").split())))
        self.open[-1].children.append(node)
        if tag not in VOID:
            place = len(self.open)
            self.open.append(node)
            self.places.setdefault(tag, []).append(place)
            if tag not in INLINE:
                self.blocks.append(place)
            if tag in SCOPES:
                self.scopes.append(place)

    def handle_endtag(self, tag):
        place = self._last((tag,))
        # an inline end tag doesn't end blocks
        if place and not (tag in INLINE and self.blocks[-1] > place):
            self._close_from(place)

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _judged(tag: str, attrs, inside: bool) -> tuple[bool, int]:
    """Whether an element goes for its tag or role, and how much its class and id make it doubtful. inside: an article or main element."""
    if tag in DROPPED or tag == "header" and not inside:
        return True, 0
    if tag in ("html", "body", "main"):
        return False, 0
    doubt = 0
    for name, value in attrs:
        if name in ("class", "id") and value and tag not in HEADINGS:
            found = BOILERPLATE.intersection(WORD.findall(value.lower()))
            if found and (not found <= AMBIGUOUS or "comment" in found and tag in BOXES):
                doubt = 2
            elif found and tag not in TEXT_BLOCKS:
                doubt = max(doubt, 1)
        elif name == "role" and value and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True, 0
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True, 0
    return False, doubt


def _in_order(root: Node) -> list[Node]:
    """Elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return out


def _spare_articles(nodes: list[Node]) -> None:
    """What holds an article or main element isn't dropped for its role, nor a form that does."""
    holds = set()
    for node in reversed(nodes):
        if node.tag in ("article", "main") or id(node) in holds:
            if node.parent is not None:
                holds.add(id(node.parent))
            if id(node) in holds and (node.tag not in DROPPED or node.tag == "form"):
                node.drop = False


def _score(root: Node, nodes: list[Node]) -> None:
    """Points, characters and links of all elements."""
    for node in nodes:
        if node.parent is not None:
            node.weight = node.parent.weight * LOWER[node.doubt]
    for block, text, linked in _runs(root):
        block.chars += len(text)
        block.linked += min(linked, len(text))
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        if len(text) < 25:
            points = 0.1
        block.points += points
        at, level = (block.parent or block) if block.tag in TEXT_BLOCKS else block, 0
        while at is not None and level < 5:
            at.score += points * block.weight / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = at.parent, level + 1
    for node in reversed(nodes):
        if node.parent is not None and not node.drop:
            up = node.parent
            up.chars, up.linked, up.points, up.links = up.chars + node.chars, up.linked + node.linked, up.points + node.points, up.links + node.links + (node.tag == "a")
            up.block = up.block or node.block


def _value(n: Node) -> float:
    return n.score * (1 - n.linked / n.chars)


def _container(nodes: list[Node]) -> Node | None:
    scored = [n for n in nodes if n.score and n.chars and not n.drop]
    return max(scored, key=_value) if scored else None


def _weigh(best: Node, up: Node) -> None:
    """Drop in ``up`` what is too doubtful, or links, and doesn't hold the container."""
    holds, node = set(), best
    while node is not None:
        holds.add(id(node))
        node = node.parent
    within = up.tag in ("article", "main")
    stack = [(up, within)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node is best
        if node.drop:
            continue
        if id(node) not in holds and node.chars:
            own = node.points * LOWER[node.doubt] * (1 - node.linked / node.chars)
            if node.doubt == 2:
                node.drop = own < 0.2 * _value(best)
            elif node.doubt == 1 and inside:
                node.drop = 2 * node.linked >= node.chars or not node.block and own < 0.1
            elif node.doubt == 1:
                node.drop = own < max(1, 0.1 * _value(best))
            elif node.tag not in INLINE and node.tag not in TEXT_BLOCKS and node.links > 1 and 4 * node.linked >= 3 * node.chars:
                node.drop = True
        stack.extend((c, inside) for c in node.children if isinstance(c, Node))


def _drop_links_beside(best: Node, top: Node, keep: set[int]) -> None:
    """Drop what stands beside an element, or beside one that holds it, up to ``top``, when a quarter of its characters or more are in links.

    In an article or main element, paragraphs and other blocks of text stay, whatever their links, and beside the container what is of its own kind
    (tag and classes) unless it is links for the most part.
    """
    node = best
    within = top.tag in ("article", "main")
    while node is not top and node.parent is not None:
        line: list[int] = []  # texts and inline elements between blocks are one run
        children = node.parent.children
        for i, s in enumerate([*children, None]):
            if isinstance(s, str) or s is not None and s.tag in INLINE and s is not node:
                line.append(i)
                continue
            if line:
                around = Node("root", None)
                around.children = [children[j] for j in line]
                runs = list(_runs(around))
                if 4 * sum(n for _, _, n in runs) >= max(1, sum(len(t) for _, t, _ in runs)):
                    for j in line:
                        children[j] = ""
                line = []
            if s is not None and s is not node and s.chars and id(s) not in keep and 4 * s.linked >= s.chars:
                s.drop = not (within and s.tag in TEXT_BLOCKS or s.kind == node.kind and 4 * s.linked < 3 * s.chars)
        node = node.parent


def _runs(root: Node) -> Iterator[tuple[Node, str, int]]:
    """Texts of blocks in page order: the block, the text with white space made one space, and its characters in links."""
    block, parts, linked = root, [], 0

    def done():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        got = (block, text, linked)
        parts, linked = [], 0
        return got

    stack: list[tuple[Node, int, bool, Node]] = [(root, 0, False, root)]
    while stack:
        node, i, in_link, outer = stack.pop()
        if i == len(node.children):
            if node.tag not in INLINE:
                if parts and (got := done())[1]:
                    yield got
                block = outer
            continue
        stack.append((node, i + 1, in_link, outer))
        child = node.children[i]
        if isinstance(child, str):
            parts.append(child)
            if in_link:
                linked += len(child)
        elif not child.drop:
            if child.tag == "br":
                parts.append(" ")
            elif child.tag in INLINE:
                stack.append((child, 0, in_link or child.tag == "a", outer))
            else:
                if parts and (got := done())[1]:
                    yield got
                stack.append((child, 0, in_link, block))
                block = child
    if parts and (got := done())[1]:
        yield got


def main_text(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    nodes = _in_order(tree.root)
    _spare_articles(nodes)
    _score(tree.root, nodes)
    best = _container(nodes)
    if best is None:
        return ""
    up = best
    while up is not tree.root and up.tag not in ("article", "main"):
        up = up.parent
    least = max(5, 0.2 * _value(best))
    beside = best.parent.children if best.parent is not None else []
    strong = {id(s) for s in beside if isinstance(s, Node) and s.score and s.chars and not s.drop and _value(s) >= least}
    _weigh(best, up)
    _drop_links_beside(best, up, strong)
    return "\n".join(text for _, text, _ in _runs(up))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """For each page: id, url, text, n_chars."""
    source = checked(pages, id_col, url_col, html_col)
    schema = source.drop(html_col).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)
