"""Main text of a web page by composite text density.

The page becomes a tree. A node's density is its characters per tag, adjusted by what share
of characters and tags belongs to links. The densities of the children are summed, and the
subtree with the largest sum is the article; other subtrees at least as dense as the thinnest
node between that one and the body belong to it, too. Short blocks have low densities, so what
stands beside the chosen ones is undecided: if all of them lie in one article or main element,
its other children are taken unless they are mostly links. An article without a heading of its
own takes the headings right before it. Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles are taken out before and count nowhere; an element that is one
of these only by a word of its class, id or role stays if it holds the article.

Defined results: a null or empty page, or one without text, gives an empty text. Broken
markup, unclosed elements and cut character references are read as a browser would, roughly:
an open paragraph or list item ends where the next block begins.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from ratefuse.llm.common import strings

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_HINT = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HEADING = re.compile("h[1-6]")
_PIECE = re.compile(r"[a-z]+|[A-Z][a-z]*")
# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
DROPPED = frozenset(
    "script style textarea title noscript iframe xmp head nav footer aside form header button"
    " select option template svg canvas object dialog menu figure".split()
) - {"figure"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
#: Words of class, id and role that mark what is not the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " sidebar comment comments reply replies respond disqus cookie cookies consent notice notices"
    " alert newsletter subscribe signup login popup modal overlay breadcrumb breadcrumbs menu nav"
    " navbar navigation pagination pager toolbar footer header masthead related recommended share"
    " sharing social widget contentinfo complementary search".split()
)
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BARRIER = frozenset("article main section div body table ul ol dl html td th blockquote".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "sum",
                 "density", "dropped", "hinted")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, hinted: bool = False) -> None:
        self.tag, self.parent, self.dropped, self.hinted = tag, parent, dropped, hinted
        self.parts: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.sum = self.density = 0.0


def _hinted(attributes: str) -> bool:
    for value in _HINT.findall(attributes):
        words = {w.lower() for w in _PIECE.findall(value)}
        if words & HINTS:
            return True
    return False


def parse(page: str) -> Node:
    root = Node("html", None, False)
    here = root
    at, end = 0, len(page)
    articles = 0  # open article elements
    while at < end:
        mark = _MARK.search(page, at)
        text = page[at : mark.start() if mark else end]
        if text:
            here.parts.append(entities.unescape(text) if "&" in text else text)
        if mark is None:
            break
        at = mark.end()
        tag = mark[2].lower() if mark[2] else ""
        if not tag or tag in ("html",):
            continue
        if mark[1]:
            node = here
            while node is not root and node.tag != tag:
                if tag == "p" and node.tag in BARRIER:
                    node = root
                    break
                node = node.parent
            if node is not root:
                while here is not node.parent:
                    articles -= here.tag in ("article", "main")
                    here = here.parent
            continue
        if tag == "body":
            while here is not root:
                here = here.parent
            articles = 0
        elif tag not in INLINE and tag != "br":
            ends = CLOSED_BY.get(tag, ()) if tag in CLOSED_BY else {"p"}
            node = here
            while node is not root and node.tag not in BARRIER - set(ends):
                if node.tag in ends or node.tag == "p":
                    here = node.parent
                    break
                node = node.parent
        unwanted = tag in DROPPED and not (tag == "header" and articles > 0)
        hinted = tag not in ("body", "html") and bool(mark[3]) and _hinted(mark[3])
        child = Node(tag, here, here.dropped or unwanted, hinted)
        here.parts.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not mark[3].endswith("/"):
            here = child
            articles += tag in ("article", "main")
    return root


def _walk(root: Node) -> list[Node]:
    """All kept nodes, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [p for p in node.parts if not isinstance(p, str) and not p.dropped]
    return out


def _own_chars(node: Node) -> int:
    return sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))


def _drop_hinted(root: Node) -> None:
    """Drop what a hint word marks, unless it holds the page's article.

    A hinted element is kept if it holds a main, an article of at least half the characters of
    the largest one, or most of the characters of the page, links not counted. In the last case
    no article or main may lie outside it.
    """
    nodes = _walk(root)
    hinted = [n for n in nodes if n.hinted and n.tag not in ("article", "main")]
    if not hinted:
        return
    plain: dict[Node, int] = {}
    for node in reversed(nodes):
        below = (plain[p] for p in node.parts if not isinstance(p, str) and not p.dropped)
        plain[node] = 0 if node.tag == "a" else _own_chars(node) + sum(below)
    hearts = [n for n in nodes if n.tag in ("article", "main") and plain[n]]
    largest = max((plain[n] for n in hearts if n.tag == "article"), default=0)
    kept = set()
    for node in hearts:
        if node.tag == "main" or 2 * plain[node] >= largest:
            while node is not None and node not in kept:
                kept.add(node)
                node = node.parent
    marked = {n for n in hinted if n not in kept}
    under: dict[Node, tuple[bool, int]] = {}  # below a marked element; articles from the root on
    for node in nodes:
        low, above = under[node.parent] if node.parent is not None else (False, 0)
        free = node.tag in ("article", "main") and bool(plain[node]) and not (low or node.hinted)
        under[node] = (low or node in marked, above + free)
    free = sum(
        n.tag in ("article", "main") and not under[n][0] and not n.hinted for n in hearts
    )
    for node in marked:
        node.dropped = not (2 * plain[node] > plain[root] and free == under[node][1])


def _measure(root: Node) -> list[Node]:
    nodes = _walk(root)
    for node in reversed(nodes):
        node.chars += _own_chars(node)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + (node.tag not in ("br", "wbr"))
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body_chars, body_links = max(root.chars, 1), root.link_chars
    for node in reversed(nodes):
        c, t = node.chars, max(node.tags, 1)
        if c:
            plain = max(c - node.link_chars, 1)
            links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
            base = c / plain * node.link_chars + body_links / body_chars * c + math.e
            node.density = c / t * math.log(max(c * t / (links * link_tags), 1.0) + 1) / math.log(base)
        if node.parent is not None:
            node.parent.sum += node.density
    return nodes


def _article(root: Node) -> list[Node | str]:
    """The parts of the page that are the article, in page order."""
    _drop_hinted(root)
    nodes = _measure(root)
    best = max(nodes, key=lambda n: (n.sum, n.chars))
    path = _up(best)
    least = min((n.density for n in path if n.chars), default=0.0)
    if best.sum == 0.0 and best.parent is not None:
        best = best.parent
        path = path[1:]
    chosen, on_path = set(), set(path)
    below = {best}
    for node in nodes:  # parents first
        if node.parent in below:
            below.add(node)
        elif node.chars and node.density >= least and node not in on_path:
            chosen.add(node)
    around = next((n for n in path if n.tag in ("article", "main")), None)
    if around is not None and around is not best and all(around in _up(n) for n in chosen):
        held = {path[path.index(around) - 1]}.union(*(_up(n) for n in chosen))
        return [
            p for p in around.parts
            if isinstance(p, str) or p in held or 2 * p.link_chars <= p.chars
        ]
    return _joined(path, chosen) if chosen else _titled(best)


def _titled(best: Node) -> list[Node | str]:
    """The node, behind the headings right before it if it has none of its own."""
    if best.parent is None or any(_HEADING.fullmatch(n.tag) for n in _walk(best)):
        return [best]
    parts = [p for p in best.parent.parts if isinstance(p, str) or not p.dropped]
    first = last = next(k for k, p in enumerate(parts) if p is best)
    while first and (
        not parts[first - 1].strip() if isinstance(parts[first - 1], str)
        else _HEADING.fullmatch(parts[first - 1].tag)
    ):
        first -= 1
    return parts[first : last + 1]


def _joined(path: list[Node], chosen: set[Node]) -> list[Node | str]:
    """What the common parent of all chosen nodes and of the path's first holds of them.

    That is its children from the first to the last with a chosen node, and headings right
    before them; children in between whose characters are mostly links are left out.
    """
    holds = {path[0]}
    for node in chosen:
        while node is not None and node not in holds:
            holds.add(node)
            node = node.parent
    top = len(path) - 1
    while top and sum(not isinstance(p, str) and p in holds | {path[top - 1]} for p in path[top].parts) < 2:
        top -= 1
    if not top:
        return [path[0]]
    parts = [p for p in path[top].parts if isinstance(p, str) or not p.dropped]
    wanted = holds | {path[top - 1]}
    places = [k for k, p in enumerate(parts) if not isinstance(p, str) and p in wanted]
    first, last = places[0], places[-1]
    while first and (
        not parts[first - 1].strip() if isinstance(parts[first - 1], str)
        else _HEADING.fullmatch(parts[first - 1].tag)
    ):
        first -= 1
    return [
        p for p in parts[first : last + 1]
        if isinstance(p, str) or p in wanted or 2 * p.link_chars <= p.chars
    ]


def _up(node: Node) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def main_text(page: str) -> str:
    """The article of a page, blocks in page order, one space between them."""
    out: list[str] = []
    stack: list = _article(parse(page))[::-1]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.dropped:
            block = item.tag not in INLINE
            stack += [" "] * block + item.parts[::-1] + [" "] * block
    return " ".join("".join(out).split())


@arrow_udf(StringType())
def main_text_of(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p) for p in strings(pages)], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text, n_chars."""
    found = pages.select("page_id", "url", main_text_of(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
