"""Main text of web pages by composite text density.

A small tolerant parser builds the tree of a page. Every node gets its composite density: characters per tag below it,
lowered where much of the text is link text, with the page's ratio of link to other text as the scale. The density sum of a node
adds the densities of its children; the least density on the path from the node with the largest density sum up to the body is the threshold.
The article or main element around that node, or else the body, is kept without parts that are below the threshold and mostly links. Navigation, headers, footers,
sidebars, forms, scripts, notices, adverts and comment sections are never text.

Text comes in blocks in page order, white space inside a block being one space; a block element or a line break in the markup
ends a block, inline elements don't. The parser's time follows the length of a page, however its tags nest.

Cases: null or empty html, and pages without text, give the empty string; unclosed, misnested and unknown tags, and broken
references, are kept as browsers would; nothing is truncated; null ids and urls stay null; equal and repeated rows give equal texts;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
DROPPED = frozenset("nav footer aside form script style noscript head title menu button select textarea input iframe template dialog svg math object canvas".split())
INLINE_FORMAT = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())
# An open element of these is ended by the start of one of those.
CLOSED_BY = {
    "p": BLOCK - {"br", "body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"},
}
# Whole class or id tokens that hint at parts that are not the article; what a part holds can overrule them.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice notices popup promo promoted replies share sharing sidebar side-bar social sponsor sponsored subscribe".split()
)
WEAK_HINTS = frozenset("header recommended related reply respond toolbar widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'=/]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"']+)))?")


class Node:
    __slots__ = ("attributes", "chars", "children", "density", "dropped", "link_chars", "link_tags", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.dropped = False


class Open:
    """The open elements of a parse. Each step costs as much as the elements it closes, however deep they nest."""

    def __init__(self, root: Node):
        self.nodes, self.names = [root], Counter([root.tag])
        self.endable = [-1]  # for each, the nearest element up through inline ones whose end tag may be left out

    @property
    def here(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.endable.append(at if node.tag in CLOSED_BY else self.endable[-1] if node.tag in INLINE_FORMAT else -1)
        self.nodes.append(node)
        self.names[node.tag] += 1

    def close(self, at: int) -> None:
        """Close the element at a place, and all inside it."""
        for node in self.nodes[at:]:
            self.names[node.tag] -= 1
        del self.nodes[at:], self.endable[at:]

    def end(self, tag: str) -> bool:
        """An end tag: closes the innermost element of its name; body and html stay open for all but their own."""
        if not self.names[tag]:
            return False
        at = len(self.nodes) - 1
        while self.nodes[at].tag != tag:
            if self.nodes[at].tag in ("body", "html") and tag not in ("body", "html"):
                return False
            at -= 1
        self.close(at)
        return True

    def make_room(self, tag: str) -> None:
        """A start tag: closes the elements that it ends, through open inline ones. Few kinds can stand in one such chain."""
        at = self.endable[-1]
        while at >= 0:
            if tag in CLOSED_BY[self.nodes[at].tag]:
                self.close(at)
                at = self.endable[-1]
            else:
                at = self.endable[at - 1]


def parse(html: str) -> Node:
    """The tree of a page; text children are strings, with references decoded."""
    root = Node("#root", "", None)
    at, open_ = 0, Open(root)
    while at < len(html):
        lt = html.find("<", at)
        if lt < 0:
            open_.here.children.append(unescape(html[at:]))
            break
        found = TOKEN.match(html, lt)
        if lt > at:
            open_.here.children.append(unescape(html[at:lt]))
        if found is None:  # a lone "<" is text
            open_.here.children.append("<")
            at = lt + 1
            continue
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if not open_.end(tag) and tag == "br":
                open_.here.children.append(Node("br", "", open_.here))
            continue
        open_.make_room(tag)
        node = Node(tag, found[3] or "", open_.here)
        open_.here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            if tag in ("textarea", "title"):
                node.children.append(unescape(html[at : end.start() if end else len(html)]))
            at = end.end() if end else len(html)
        elif tag not in VOID and not (found[3] or "").rstrip().endswith("/") or tag in BLOCK - VOID:
            open_.push(node)
    return root


def attributes_of(node: Node) -> dict[str, str]:
    """Attributes by name in lower case; the first of a name holds."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(node.attributes):
        found.setdefault(name.lower(), unescape("".join(values)).lower())
    return found


def _is_noise(node: Node, inside_article: bool) -> bool:
    if node.tag in DROPPED or node.tag == "header" and not inside_article:
        return True
    if not node.attributes or node.tag in ("html", "body", "article", "main"):
        return False
    own = attributes_of(node)
    return own.get("role") in ROLES or "hidden" in own and own["hidden"] != "until-found" or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style", "")) is not None


def _is_hinted(node: Node, mostly_links: bool) -> bool:
    """Whether a class or id hints at a part that isn't the article; weak hints count where most of the part is links."""
    if not node.attributes or node.tag in ("html", "body", "article", "main"):
        return False
    own = attributes_of(node)
    tokens = f"{own.get('class', '')} {own.get('id', '')}".split()
    return any(t in HINTS for t in tokens) or mostly_links and any(t in WEAK_HINTS for t in tokens)


def _drop_hinted(nodes: list[Node]) -> None:
    """Drops parts that their class or id hints at, unless they hold a first-level heading, or most of the page's text outside links; where there
    is an article or main element, only parts around or inside it can hold most of it."""
    plain: dict[int, int] = {}
    total: dict[int, int] = {}
    heads: set[int] = set()
    marked: set[int] = set()
    for node in reversed(nodes):
        n = everything = 0
        for child in node.children:
            if isinstance(child, str):
                own = len("".join(child.split()))
                n += own
                everything += own
            elif not child.dropped:
                everything += total[id(child)]
                n += plain[id(child)] if child.tag != "a" else 0
                if child.tag == "h1" or id(child) in heads:
                    heads.add(id(node))
                if id(child) in marked:
                    marked.add(id(node))
        plain[id(node)], total[id(node)] = n, everything
        if n and not node.dropped and node.tag in ("article", "main"):
            marked.add(id(node))
    whole, is_marked, inside = plain[id(nodes[0])], bool(marked), set()
    for node in nodes:
        if id(node) in marked and node.tag in ("article", "main") or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
        above = node.parent is not None and node.parent.dropped
        keeps = node.tag == "h1" or id(node) in heads or 2 * plain[id(node)] > whole and (not is_marked or id(node) in marked or id(node) in inside)
        node.dropped = node.dropped or above or not keeps and _is_hinted(node, 2 * plain[id(node)] < total[id(node)])


def walk(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def measure(root: Node) -> Node:
    """Sets densities and density sums of all nodes; returns the body, or the root where there is none."""
    nodes = walk(root)
    article: dict[int, bool] = {}
    for node in nodes:
        above = node.parent is not None and article[id(node.parent)]
        article[id(node)] = above or node.tag in ("article", "main")
        node.dropped = node.parent is not None and (node.parent.dropped or _is_noise(node, above))
    _drop_hinted(nodes)
    for node in reversed(nodes):
        if node.dropped:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.dropped:
                own = child.tag not in INLINE_FORMAT and child.tag != "br" or child.tag == "a"
                node.chars += child.chars
                node.tags += child.tags + own
                node.link_tags += child.link_tags + (child.tag == "a")
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
    body = next((n for n in nodes if n.tag == "body"), root)
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        if not node.dropped and node.chars:
            plain = max(1, node.chars - node.link_chars)
            scale = math.log(node.chars / plain * node.link_chars + ratio * node.chars + math.e)
            links = (node.chars / max(1, node.link_chars)) * (max(1, node.tags) / max(1, node.link_tags))
            node.density = node.chars / max(1, node.tags) * max(0.0, math.log(max(1.0, links)) / math.log(max(math.e, scale)))
    for node in nodes:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node))
    return body


def main_node(body: Node) -> Node:
    """The node of the largest density sum."""
    live = [n for n in walk(body) if not n.dropped and n.chars]
    return max(live, key=lambda n: n.sum) if live else body


def scope(node: Node, body: Node) -> Node:
    """The smallest article or main element around a node; the body where there is none, so that its siblings count too."""
    while node is not body and node.parent is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node


def path_threshold(node: Node, body: Node) -> float:
    """The least density on the path from a node up to the body."""
    least = node.density
    while node is not body and node.parent is not None:
        node = node.parent
        if node.density:
            least = min(least, node.density)
    return least


def blocks_of(node: Node, threshold: float) -> list[str]:
    """Blocks of a subtree in page order, without parts that are mostly links and thinner than the threshold."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    todo: list = [node]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif not item.dropped and not (item is not node and item.tag in BLOCK and item.density < threshold and 2 * item.link_chars > item.chars):
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(item.children))
    flush()
    return blocks


def main_text(html: str | None) -> str:
    if not html:
        return ""
    body = measure(parse(html.replace("\0", "")))
    node = main_node(body)
    return "\n".join(blocks_of(scope(node, body), path_threshold(node, body)))


def extract_pages(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars) for every row of `pages(page_id, url, html)`; an empty table gives none."""

    def run(parts):
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                texts = [main_text(h) for h in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), some.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
