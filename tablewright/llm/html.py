"""Main text of web pages by composite text density.

A page becomes a tree of elements (tags are closed the way browsers close them). Every element gets a density:
its characters per tag, lowered the more of them are link text. The density sum of an element is the sum over its
children. The lowest density on the path from the element of the largest sum up to the body is the threshold; below
the body, subtrees that reach it are content, whole but for link lists beside that element; headings and paragraphs beside content stay.
An article or main element that the page declares around that element goes before the threshold. Furniture
(menus, footers, adverts, forms ...) is known by element, role or name and is out before anything is counted.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.llm.base import texts

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CLOSES = {  # a start tag of the key ends open elements of the names up to the nearest stop
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_STOPS = frozenset("article aside blockquote body button caption center dd details dialog div dt fieldset figcaption figure footer form header html li main nav object section table td th ul ol dl".split())
P_CLOSERS = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = HEADINGS | frozenset("p pre blockquote ul ol dl table figure hgroup header".split())

# What is furniture by element, by role and by a word of its class or id.
FURNITURE = frozenset(
    "head title script style noscript noembed noframes template iframe object embed svg math canvas audio video map form button select"
    " textarea input label datalist fieldset nav menu aside footer dialog search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status log".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsors sponsored promo promos promotion"
    " banner cookie cookies consent gdpr notice notices alert popup popups modal overlay newsletter subscribe subscription signup login signin paywall"
    " sidebar sidebars sidenav nav navbar navigation navmenu menu menus breadcrumb breadcrumbs topbar toolbar masthead header footer colophon copyright"
    " comment comments commentlist disqus respond reply replies discussion social share sharing sharebar related recommended recommendations"
    " trending popular widget widgets pagination pager skip form search tags tagcloud disclaimer".split()
)
ARTICLE_WORDS = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo related recommended".split())
KEPT_PREFIXES = frozenset("has with no without is".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    __slots__ = ("children", "density", "density_sum", "furniture", "name", "parent", "sums")

    def __init__(self, name: str, parent: Node | None, furniture: bool = False):
        self.name, self.parent, self.furniture = name, parent, furniture
        self.children: list[Node | str] = []
        self.sums = (0, 0, 0, 0)  # characters, tags, characters in links, link tags
        self.density = self.density_sum = 0.0


def _is_furniture(name: str, attributes: str) -> bool:
    if name in FURNITURE:
        return True
    if not attributes or not attributes.strip(" /"):
        return False
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
        found.setdefault(m[1].lower(), entities.unescape(value) if value else "")
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or found.get("aria-modal", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True
    if ROLES & set(found.get("role", "").lower().split()):
        return True
    if name in ("html", "body", "main"):
        return False
    for token in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w.lower() for w in _NAME.findall(token)]
        if name == "article":
            words = words[:1] if words and words[0] in ARTICLE_WORDS else []
        if words and words[0] not in KEPT_PREFIXES and not WORDS.isdisjoint(words):
            return True
    return False


def parse(page: str) -> Node:
    """The element tree of a page; every input gives one. Text outside the body's elements belongs to the root."""
    root = node = Node("#root", None)
    open_names: dict[str, int] = {}
    at, n = 0, len(page)

    def text(piece: str) -> None:
        if piece:
            node.children.append(entities.unescape(piece) if "&" in piece else piece)

    def pop_to(target: Node) -> None:
        """Closes elements up to and with ``target``."""
        nonlocal node
        while True:
            x = node
            open_names[x.name] -= 1
            node = x.parent
            if x is target:
                return

    def nearest(names, stops) -> Node | None:
        x = node
        while x is not root and x.name not in stops:
            if x.name in names:
                return x
            x = x.parent
        return None

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                node.children.append(m[0][9:-3])
            continue
        name = m[2].lower()
        if m[1]:
            if open_names.get(name):
                x = node
                while x.name != name:
                    x = x.parent
                if name in BLOCKS or not _block_between(node, x):
                    pop_to(x)
            elif name in HEADINGS and (x := nearest(HEADINGS, P_STOPS)):
                pop_to(x)
            elif name == "br":
                node.children.append(" ")
            continue
        if name in P_CLOSERS and open_names.get("p") and (x := nearest({"p"}, P_STOPS)):
            pop_to(x)
        if name in HEADINGS and node.name in HEADINGS:
            pop_to(node)
        rule = CLOSES.get(name)
        while rule and (x := nearest(rule[0], rule[1])):
            pop_to(x)
        if name == "a" and open_names.get("a") and (x := nearest({"a"}, {"td", "th", "caption", "table"})):
            pop_to(x)
        if name == "br":
            node.children.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                node.children.append(Node("hr", node))
            continue
        new = Node(name, node, _is_furniture(name, m[3]))
        node.children.append(new)
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else n
            if end:
                at = page.find(">", end.end()) + 1 or n
            continue
        if m[3].rstrip().endswith("/") and name not in BLOCKS and name not in ("a", "b", "i", "em", "strong", "span"):
            continue  # svg shapes and the like
        node = new
        open_names[name] = open_names.get(name, 0) + 1
    return root


def _block_between(x: Node, top: Node) -> bool:
    """An end tag of an inline element does not close blocks inside it."""
    while x is not top:
        if x.name in BLOCKS and x.name != "p":
            return True
        x = x.parent
    return False


def _after(root: Node) -> list[Node]:
    """All elements, children before parents, without recursion: pages can be deep."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(c for c in x.children if type(c) is not str)
    order.reverse()
    return order


def prune(root: Node) -> None:
    """Takes furniture out. A furniture name on something that holds an article or main element does not count, nor does
    a header, or a heading group, that belongs to an article."""
    holds: dict[int, bool] = {}
    for x in _after(root):
        holds[id(x)] = (x.name in ("article", "main") and not x.furniture) or any(holds[id(c)] for c in x.children if type(c) is not str)
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        x, inside = stack.pop()
        inside = inside or x.name in ("article", "main")
        kept = []
        for c in x.children:
            if type(c) is not str:
                if c.name == "header" and not inside and not holds[id(c)]:
                    continue
                if c.furniture and (c.name in FURNITURE or not holds[id(c)]) and not (c.name == "form" and holds[id(c)]):
                    continue
                stack.append((c, inside))
            kept.append(c)
        x.children = kept


def weigh(root: Node) -> None:
    """Characters and tags of every subtree, densities, and sums of the children's densities."""
    order = _after(root)
    for x in order:
        chars = tags = link_chars = link_tags = 0
        for c in x.children:
            if type(c) is str:
                chars += len(" ".join(c.split()))
            else:
                a, b, d, e = c.sums
                chars, tags, link_chars, link_tags = chars + a, tags + b + 1, link_chars + d, link_tags + e
        if x.name == "a":
            link_chars, link_tags = chars, link_tags + 1
        x.sums = (chars, tags, link_chars, link_tags)
    whole_chars, _, whole_links, _ = root.sums
    for x in order:
        chars, tags, link_chars, link_tags = x.sums
        if not chars:
            continue
        t, lt, lc, plain = max(1, tags), max(1, link_tags), max(1, link_chars), max(1, chars - link_chars)
        base = math.log(chars / plain * link_chars + whole_links / whole_chars * chars + math.e)
        x.density = chars / t * max(0.0, math.log(chars / lc * t / lt + 1e-9)) / base
        if x.name == "a" or link_chars == chars:
            x.density = 0.0
    for x in order:
        x.density_sum = sum(c.density for c in x.children if type(c) is not str)
        if any(type(c) is str and not c.isspace() for c in x.children):
            x.density_sum += x.density  # text of its own is like a child of its own


def best(root: Node) -> Node:
    """The element of the largest density sum in a subtree; the outermost, first one of equals."""
    top, stack = root, [root]
    while stack:
        x = stack.pop()
        if x.density_sum > top.density_sum:
            top = x
        stack.extend(c for c in reversed(x.children) if type(c) is not str)
    return top


def select(body: Node) -> list[Node]:
    """Content subtrees in page order. What is not content is taken out of the elements that hold some."""
    if not body.sums[0]:
        return []
    top = best(body)
    declared = _declared(top, body)
    if declared:
        return declared
    if top.density_sum <= 0 or top is body:  # nothing but links or bare text: no subtree stands out; or the body itself does
        return [body]
    x, threshold, wrappers = top, top.density if top.density > 0 else math.inf, set()
    while x is not body:
        x = x.parent
        threshold = min(threshold, x.density)
        wrappers.add(id(x))
    whole, stack = [top], [body]
    while stack:
        x = stack.pop()
        for c in x.children:
            if type(c) is str or c is top:
                continue
            if id(c) not in wrappers and c.density >= threshold - 1e-9 and c.density > 0:
                whole.append(c)
            else:
                stack.append(c)
    # wrappers below the body reach the threshold as well: all of them stays but link lists
    _thin(body, whole, lambda x, c: not _links_only(c) if id(x) in wrappers and x is not body else _beside(c))
    return [body]


def _links_only(c: Node) -> bool:
    chars, _, link_chars, link_tags = c.sums
    return link_tags > 1 and link_chars == chars


def _beside(c: Node) -> bool:
    """Headings, paragraphs and other text that stay beside content: less than half of it in links."""
    chars, _, link_chars, _ = c.sums
    return (c.name in BESIDE or c.name not in BLOCKS) and 2 * link_chars < chars


def _thin(body: Node, whole: list[Node], stays) -> None:
    """Takes out of the elements that hold content, from ``body`` down, the children that neither are nor hold content nor stay beside it."""
    content = {id(x) for x in whole}
    holders = set()
    for x in whole:
        while x is not body and id(x.parent) not in holders:
            x = x.parent
            holders.add(id(x))
    stack = [body]
    while stack:
        x = stack.pop()
        x.children = [c for c in x.children if type(c) is str or id(c) in content or id(c) in holders or stays(x, c)]
        stack.extend(c for c in x.children if type(c) is not str and id(c) in holders and id(c) not in content)


def _declared(x: Node, body: Node) -> list[Node]:
    """What the page declares to be the article around an element: its main element, of which articles and the text beside them stay if
    it holds any, else the page's outermost articles. Empty without either."""
    found, main = None, None
    y: Node | None = x
    while y is not None and y is not body.parent:
        if y.name == "article":
            found = y
        elif y.name == "main":
            main = y
        y = y.parent
    if found is None and main is not None:
        return [main]
    if found is None:  # an element around articles, if they are most of its text
        inner = _articles(x)
        if 2 * sum(c.sums[0] - c.sums[2] for c in inner) <= x.sums[0] - x.sums[2]:
            return []
        found = max(inner, key=lambda c: c.sums[0] - c.sums[2])
    z = found.parent
    while z is not main and z is not body.parent and z is not None:
        z = z.parent
    if main is None or z is not main:  # no main element, or one within the article; teasers that are links are other pages
        return [c for c in _articles(body) if c is found or 2 * c.sums[2] < c.sums[0]]
    whole = _articles(main)
    _thin(main, whole, lambda x, c: _beside(c))
    return [main]


def _articles(top: Node) -> list[Node]:
    """The outermost articles below an element, in page order."""
    out, stack = [], [c for c in reversed(top.children) if type(c) is not str]
    while stack:
        c = stack.pop()
        if c.name == "article":
            out.append(c)
        else:
            stack.extend(d for d in reversed(c.children) if type(d) is not str)
    return out


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks: white space made one space, trimmed, empty ones left out."""
    out: list[str] = []
    pieces: list[str] = []

    def close() -> None:
        line = " ".join("".join(pieces).split())
        pieces.clear()
        if line:
            out.append(line)

    for root in nodes:
        close()
        stack: list[Node | str | None] = [root]
        while stack:
            x = stack.pop()
            if x is None:
                close()
            elif type(x) is str:
                pieces.append(x)
            else:
                if x.name in BLOCKS:
                    close()
                    stack.append(None)
                stack.extend(reversed(x.children))
    close()
    return out


def main_text(page: str | None) -> str:
    """The article of a page, one block per line; empty for null, for pages without text, and for furniture alone."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    body = next((x for x in reversed(_after(root)) if x.name == "body"), root)
    weigh(root)
    return "\n".join(blocks(select(body)))


def _extracted(column: pa.Array) -> pa.Array:
    return pa.array([main_text(t) for t in texts(column)], pa.string())


def extract(page: Column) -> Column:
    """The main text of a column of whole pages. It depends on its own row only, so repeated rows and other columns do not matter."""
    return F.arrow_udf(_extracted, "string").asNondeterministic()(page)
