"""Main text of web pages by composite text density.

A page becomes a tree of nodes. Every node gets its composite text density: characters per
tag, adjusted by the share of characters inside links (many links, or much text in them,
lower it). The density sum of a node adds up its children's densities. The node with the
largest sum is the first content. The lowest density on its path up to the body is the
threshold, but no more than the density of its own children, weighted by their text (the
density grows with a node's size, so that a smaller part of the same text is always below a
larger one). In every maximal subtree that reaches the threshold the node of largest sum is
content too, and so on in what is left of it; all content is joined in page order.

Subtrees whose role says that they are not part of the article (navigation, footers, notices,
adverts, forms, comments and so on) are cut before, and leave the counts. A class or id tells
a role if all its parts do, or name a role and a place (``site-footer``; not ``with-sidebar``).
What a class, an id, a role or a form would cut stays if the page's only articles are in it,
or, on a page without article and main, most of its text outside links.

Defined results: null or empty pages, and pages without text, give an empty string. Markup
that is cut off or badly nested is read as browsers do: a block closes an open paragraph,
unclosed elements end with their parent, and a stray end tag is ignored. Character
references are decoded. White space inside a block becomes one space; blocks (and cells,
list items and line breaks) are joined by one space. Nothing is cut from long pages. Repeated rows give
repeated results; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg canvas object".split())
CODE = frozenset(("script", "style"))  # without an end tag these reach to the end of the page
SKIP = RAW | frozenset("head nav footer aside form button select option input label dialog menu iframe audio video".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "option": ("option",),
}
ROLES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner
nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget related recommended
footer masthead cookie cookies consent notice disclaimer alert popup modal overlay newsletter subscribe signup login
comment comments respond reply replies disqus share sharing social toolbar tooltip copyright search form""".split())
ARIA = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
PLACES = frozenset("""site page main top bottom left right primary secondary global header inner outer box bar block section
container wrapper wrap area list item items link links button buttons icon icons text content""".split())
INLINE_FORMAT = frozenset("a abbr b bdi bdo big cite code em font i kbd mark q s samp small span strong sub sup tt u var".split())
PARTS = INLINE_FORMAT | frozenset("p li ul ol blockquote".split())  # a part of a text, never all of it
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<", re.S)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "kids", "link", "skip", "doubt")

    def __init__(self, tag, parent, link, skip, doubt=False):
        self.tag, self.parent, self.link, self.skip, self.doubt, self.kids = tag, parent, link, skip, doubt, []


def _names_role(name: str) -> bool:
    parts = [x for x in SPLIT.split(name) if x]
    return not ROLES.isdisjoint(parts) and all(x in ROLES or x in PLACES for x in parts)


def _boilerplate(tag: str, attrs: str, inside_article: bool) -> bool | None:
    """Whether a node is cut; None: unless it turns out to hold the page's text."""
    if tag == "form":
        return None
    if tag in SKIP:
        return True
    if tag == "header" and not inside_article:
        return True
    if tag in ("html", "body", "article", "main") or not attrs:
        return False
    out: bool | None = False
    for name, a, b, c in ATTR.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "role":
            if value in ARIA:
                out = None
        elif name == "aria-hidden":
            if value == "true":
                return True
        elif name != "hidden" and any(map(_names_role, value.split())):
            out = None
    return out


def _settle(root: Node) -> None:
    """Cut the doubtful nodes that don't hold the page's text."""
    order: list[tuple[Node, bool]] = []
    todo = [(root, False)]
    free = False  # an article or main outside all doubtful nodes
    while todo:
        n, inside = todo.pop()
        inside = inside or n.doubt
        order.append((n, inside))
        free = free or (n.tag in ("article", "main") and not inside)
        todo.extend((k, inside) for k in n.kids if isinstance(k, Node) and not k.skip)
    plain: dict[int, int] = {}
    articles: dict[int, int] = {}
    for n, _ in reversed(order):  # children before parents
        seen = [k for k in n.kids if isinstance(k, Node) and not k.skip]
        own = 0 if n.link else sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        plain[id(n)] = own + sum(plain[id(k)] for k in seen)
        articles[id(n)] = (n.tag in ("article", "main")) + sum(articles[id(k)] for k in seen)
    for n, _ in order:
        if n.doubt:
            n.skip = free or (not articles[id(n)] if articles[id(root)] else 2 * plain[id(n)] <= plain[id(root)])


def parse(page: str) -> Node:
    """The page's tree: nodes and, among ``kids``, strings of text."""
    root = Node("#root", None, False, False)
    at, end = 0, len(page)
    node, articles = root, 0
    endless: set[str] = set()  # tags whose end tag no longer follows
    stack = [root]
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        piece = m.group()
        tag = m.group(2) or m.group(5)
        if tag is None:
            if piece[0] != "<" or piece == "<":
                node.kids.append(piece)
            continue
        tag = tag.lower()
        closing = m.group(1) or m.group(4)
        if closing:
            if tag == "br":
                node.kids.append(Node("br", node, False, False))
                continue
            if any(n.tag == tag for n in stack[1:]):
                if tag in INLINE_FORMAT and any(n.tag in BLOCK for n in _above(stack, tag)):
                    continue  # an inline end tag does not close the blocks opened inside
                while True:
                    n = stack.pop()
                    if n.tag in ("article", "main"):
                        articles -= 1
                    if n.tag == tag:
                        break
                node = stack[-1]
            continue
        attrs = m.group(3) if m.group(2) else m.group(6)
        if tag in BLOCK and tag != "br":
            while stack[-1].tag == "p" or (stack[-1].tag in INLINE_FORMAT and any(n.tag == "p" for n in stack)):
                stack.pop()
        if tag in CLOSES:
            while stack[-1].tag in CLOSES[tag] or (stack[-1].tag in INLINE_FORMAT and len(stack) > 1 and stack[-2].tag in CLOSES[tag]):
                stack.pop()
        node = stack[-1]
        cut = _boilerplate(tag, attrs, articles > 0)
        child = Node(tag, node, node.link or tag == "a", node.skip or cut is True, cut is None)
        node.kids.append(child)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if close:
                at = close.end()
            else:
                endless.add(tag)  # only the start tag is skipped
                at = end if tag in CODE else at
            continue
        if tag in ("article", "main"):
            articles += 1
        stack.append(child)
        node = child
    _settle(root)
    return root


def _above(stack, tag):
    for n in reversed(stack):
        if n.tag == tag:
            return
        yield n


def densities(root: Node) -> list[tuple[Node, float, float]]:
    """(node, density, density sum) of every node that is not boilerplate, parents last."""
    counts: dict[int, list[float]] = {}
    order: list[Node] = []
    todo = [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(k for k in n.kids if isinstance(k, Node) and not k.skip)
    for n in reversed(order):  # children before parents
        chars = tags = link_chars = link_tags = 0
        for k in n.kids:
            if isinstance(k, Node):
                if not k.skip:
                    c = counts[id(k)]
                    chars, tags, link_chars, link_tags = chars + c[0], tags + c[1] + 1, link_chars + c[2], link_tags + c[3] + (k.tag == "a")
            else:
                size = len(k.strip())
                chars += size
                link_chars += size if n.link else 0
        counts[id(n)] = [chars, tags, link_chars, link_tags]
    total, _, total_links, _ = counts[id(root)]
    body_ratio = total_links / total if total else 0.0
    out, density = [], {}
    for n in reversed(order):
        chars, tags, link_chars, link_tags = counts[id(n)]
        if not chars:
            density[id(n)] = 0.0
        else:
            t, lc, lt, plain = max(tags, 1), max(link_chars, 1), max(link_tags, 1), max(chars - link_chars, 1)
            base = math.log(chars / plain * link_chars + body_ratio * chars + math.e)
            density[id(n)] = chars / t * max(0.0, math.log(chars / lc * t / lt + 1e-12) / math.log(max(base, 1.0) + 1.0))
        out.append((n, density[id(n)], sum(density[id(k)] for k in n.kids if isinstance(k, Node) and not k.skip)))
    return out


def _article(n: Node) -> Node:
    """An article is taken whole."""
    at: Node | None = n
    while at is not None:
        if at.tag in ("article", "main"):
            return at
        at = at.parent
    return n


def choose(root: Node) -> list[Node]:
    """The content subtrees in page order, none inside another."""
    found = densities(root)
    density = {id(n): d for n, d, _ in found}
    sums = {id(n): s for n, _, s in found}
    top = max(found, key=lambda x: x[2])[0]
    if top.tag in ("html", "#root"):
        fit = [x for x in found if x[1] >= density[id(top)] and x[0].tag not in ("html", "#root")] or found
        top = max(fit, key=lambda x: x[2])[0]
    threshold, n = density[id(top)], top
    while n is not None and n.tag not in ("body", "html", "#root"):
        threshold = min(threshold, density[id(n)])
        n = n.parent
    largest: dict[int, Node] = {}  # the node of largest sum in each subtree
    chars: dict[int, int] = {}
    for n, _, _ in found:  # children before parents
        best = n
        chars[id(n)] = sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        for k in n.kids:
            if isinstance(k, Node) and not k.skip:
                chars[id(n)] += chars[id(k)]
                if sums[id(largest[id(k)])] > sums[id(best)]:
                    best = largest[id(k)]
        largest[id(n)] = best
    held = [k for k in top.kids if isinstance(k, Node) and not k.skip and chars[id(k)]]
    if held:
        threshold = min(threshold, sum(density[id(k)] * chars[id(k)] for k in held) / sum(chars[id(k)] for k in held))
    if top.tag in PARTS and top.parent is not None:
        top = top.parent
    taken = {id(_article(top))}
    todo = [root]
    while todo:
        n = todo.pop()
        if id(n) in taken:
            continue
        if n.tag not in ("body", "html", "#root") and chars[id(n)] and density[id(n)] >= threshold * (1 - 1e-9):
            best = largest[id(n)]
            while best is not n and best.tag in PARTS:
                best = best.parent
            taken.add(id(_article(best)))
            if best is n:
                continue
        todo.extend(k for k in n.kids if isinstance(k, Node) and not k.skip)
    out: list[Node] = []
    todo = [root]
    while todo:
        n = todo.pop()
        if id(n) in taken:
            out.append(n)
        else:
            todo.extend(k for k in reversed(n.kids) if isinstance(k, Node) and not k.skip)
    return out


def blocks(node: Node) -> list[str]:
    """The texts of a subtree's blocks in page order, boilerplate left out."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = [node]
    while todo:
        k = todo.pop()
        if k is None:
            flush()
        elif isinstance(k, str):
            run.append(k)
        elif not k.skip:
            if k.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(k.kids))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    return " ".join(text for node in choose(parse(page)) for text in blocks(node))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; one narrow pass over the input."""

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    taken = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string"))
    return taken.mapInArrow(run, f"`{id_col}` {taken.schema[0].dataType.simpleString()}, `{url_col}` string, text string, n_chars long")
