"""Main text of web pages by composite text density.

Each page's markup becomes a tree; scripts, styles, forms, navigation, headers, footers, sidebars, adverts and reader
comments (by tag, role or a word of a class or id) count nothing, unless such a node is the page's wrapper: it holds the
main element, a first-level heading or several of the page's parts, or all text there is.  A word of a class or id is a weak
sign: where the text outside of such nodes is no article, or a small part beside one of them, the fullest of them counts, if
it is not made of links, and reader comments only if nothing else does.  Every node has the composite
density: characters per tag, adjusted by its share of link characters and tags against those of the body.  A node's
density sum is the sum of its children's densities; text that stands directly in a node is a child of its own.  The
threshold is the smallest density on the path from the body to the node with the largest sum.  From the body down, every
node that reaches it marks the node with the largest sum in its own subtree, so an article in several containers is found
whole; a heading in front of marked text belongs to it.  All text blocks of the marked subtrees are returned.

Defined results: null, empty or text-free html gives the empty text; unclosed, crossed and cut-off tags are closed
where a browser would; character references are decoded; white space inside a block becomes one space; blocks are
joined in page order by two line feeds.  Pages of any length and depth are read whole in linear time; repeated rows are
read each; extra columns pass through, but for ``text`` and ``n_chars``, which are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import ship

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "title", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
#: Elements without text of the page, wrapper or not.
NEVER = frozenset("script style noscript template head title iframe object svg canvas button select textarea input".split())
SKIP = NEVER | frozenset("form nav header footer aside menu dialog".split())
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Words of a class or id that name a part of the page which is no main text, and first words that only say that the page has or lacks such a part.
PARTS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus footer header masthead menu nav navbar navigation newsletter notice popup promo promotion related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split())
STATES = frozenset("has no with without is not hide show hides shows left right full one two layout page".split())
#: Words of reader comments, which may be longer than what they comment on.
REPLIES = frozenset("comment comments commentlist disqus respond".split())
#: Characters outside of links and headings that make an article, beside a node named by a word; the part of that node's
#: characters that they must be, unless it holds replies; its largest share of link characters; and how many such
#: nodes inside each other are looked through.
LEAST_TEXT, LEAST_PART, MOST_LINKS, NESTED = 200, 0.2, 0.3, 16
#: Parts of a page that only its wrapper holds two of.
LANDMARKS = frozenset("nav header footer aside main".split())
P_SCOPE = frozenset("table td th button object".split())
SINGLE = frozenset("p h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")


#: Bits of the tags that a start tag may close, for what is open within the nearest element that bounds them.
BIT = {tag: 1 << k for k, tag in enumerate(["p", *SIBLING])}
CLEARED: dict[str, int] = {}
for _tag, _bounds in {"p": P_SCOPE, **SCOPE}.items():
    for _bound in _bounds:
        CLEARED[_bound] = CLEARED.get(_bound, 0) | BIT[_tag]
CLOSED = {tag: sum(BIT[x] for x in closed) for tag, closed in SIBLING.items()}


class Node:
    __slots__ = ("tag", "parent", "children", "named", "word", "skip", "link", "block", "open", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag: str, parent: Node | None, named: bool):
        self.tag, self.parent, self.named, self.skip = tag, parent, named, False
        self.word = ""  # what the node is named by, if only by a word
        self.link = tag == "a" or bool(parent and parent.link)
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.open = ((parent.open if parent else 0) & ~CLEARED.get(tag, 0)) | BIT.get(tag, 0)
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.best = self


def _part(names: str) -> str:
    """The word by which a class or id names a part: one between hyphens, unless the first one says that the page has or lacks
    it; empty if none does."""
    for name in names.lower().split():
        words = name.replace("_", "-").split("-")
        if not PARTS.isdisjoint(words) and words[0] not in STATES:
            return next(w for w in words if w in PARTS)
    return ""


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None, False)
        self.depth: Counter[str] = Counter()  # open elements by tag

    def climb(self, to: Node) -> None:
        while self.at is not to:
            self.depth[self.at.tag] -= 1
            self.at = self.at.parent

    def close_nearest(self, bits: int) -> None:
        """Closes the nearest open element of those tags; every element above it is closed with it."""
        node = self.at
        while not BIT.get(node.tag, 0) & bits:
            node = node.parent
        self.climb(node.parent)

    def handle_starttag(self, tag, attrs):
        if self.depth["head"] and (tag == "body" or tag in BLOCK and tag not in ("html", "title")):
            while self.depth["head"]:  # a body element ends an open head
                self.climb(self.at.parent)
        if tag in CLOSES_P and self.at.open & BIT["p"]:
            self.close_nearest(BIT["p"])
        if tag in CLOSED and self.at.open & CLOSED[tag]:
            self.close_nearest(CLOSED[tag])
        values = dict(attrs)
        named = (values.get("role") or "").lower() in ROLES or "hidden" in values
        word = ""
        if not named and tag not in ("html", "body", "article", "main"):
            named = tag in SKIP
            word = "" if named else _part(f"{values.get('class') or ''} {values.get('id') or ''}")
        if tag == "header" and self.depth["article"]:
            named = False  # a header inside an article introduces it
        node = Node(tag, self.at, named or bool(word))
        node.word = word
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.depth[tag] += 1

    def handle_endtag(self, tag):
        if not self.depth[tag]:
            return
        node = self.at
        while node.tag != tag:
            if tag not in BLOCK and node.tag in BLOCK:  # an inline end tag closes no block
                return
            node = node.parent
        self.climb(node.parent)

    def handle_data(self, data):
        self.at.children.append(data)


def _order(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node)]
    return order


def _skip(order: list[Node], lift: bool) -> None:
    """Marks what counts nothing; a named node that wraps the page counts."""
    parts: dict[Node, int] = {}
    for node in reversed(order):
        n = parts.get(node, 0)
        if node.named and node.tag not in NEVER and (n >= 2 or lift):
            node.named = False
        n += 2 if node.tag in ("main", "h1") else node.tag in LANDMARKS
        if node.parent and n:
            parts[node.parent] = parts.get(node.parent, 0) + n
    for _ in range(NESTED):
        if not _counts_after_all(order):
            break
    for node in order:
        node.skip = node.named or bool(node.parent and node.parent.skip)


def _counts_after_all(order: list[Node]) -> bool:
    """Lets the fullest of the nodes that are named by a word count, if hardly any text stands outside of such nodes."""
    outside, inside, links = 0, {}, {}  # characters of the text outside, of each outermost such node, and of its links
    under: dict[Node, Node | None] = {}  # the outermost such node of each node that has text of the page
    for node in order:  # parents first
        if node.parent and node.parent not in under or node.named and not node.word:
            continue
        top = under[node.parent] if node.parent else None
        under[node] = top = top or (node if node.named else None)
        n = sum(len(_SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
        if top:
            inside[top] = inside.get(top, 0) + n
            links[top] = links.get(top, 0) + n * node.link
        elif not node.link and node.block.tag not in HEADINGS:
            outside += n
    full = [t for t, n in inside.items() if links[t] < MOST_LINKS * n and outside < max(LEAST_TEXT, 0 if t.word in REPLIES else LEAST_PART * n)]
    full = [t for t in full if t.word not in REPLIES] or full
    most = max((inside[t] for t in full), default=0)
    chosen = [t for t in full if inside[t] >= max(most / 2, LEAST_TEXT / 2, outside)]
    for t in chosen:
        t.named = False
    return bool(chosen)


def _measure(order: list[Node]) -> None:
    """Counts of every node; children come before parents."""
    for node in order:
        if node.skip:
            continue
        for c in node.children:
            if isinstance(c, str):
                n = len(_SPACE.sub(" ", c).strip())
                node.chars += n
                node.link_chars += n if node.link else 0
            elif not c.skip:
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.tag == "a")


def _density(c: int, t: int, lc: int, lt: int, body_ratio: float) -> float:
    """Characters per tag; links take away from it in the proportion of link to other text."""
    t = max(t, 1)
    if not c:
        return 0.0
    base = math.log(max(c * lc / max(c - lc, 1) + body_ratio * c, 0.0) + math.e)
    return c / t * math.log(max(c * t / (max(lc, 1) * max(lt, 1)), 1.0) + 1.0) / math.log(base + math.e - 1.0)


def _blocks(node: Node, marked: set[Node]) -> list[str]:
    """The text blocks of the marked subtrees, in page order."""
    out, now = [], []

    def end() -> None:
        text = _SPACE.sub(" ", "".join(now)).strip()
        now.clear()
        if text:
            out.append(text)

    todo: list = [(node, False)]
    while todo:
        x, taken = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            now.append(x if taken else " ")
        elif x.skip:
            continue
        elif x.tag == "br":
            now.append(" ")
        else:
            taken = taken or x in marked
            block = x.tag in BLOCK or x.parent is None
            if block:
                end()
                todo.append((None, taken))
            todo += [(c, taken) for c in reversed(x.children)]
    end()
    return out


def _marked(order: list[Node], body: Node) -> set[Node]:
    """The nodes whose subtrees are the main text."""
    for node in order:  # children before parents; ties: the innermost
        node.best = max([c.best for c in node.children if isinstance(c, Node) and not c.skip] + [node], key=lambda n: n.total)
    top = body.best
    path, node = [top], top
    while node is not body:
        node = node.parent
        path.append(node)
    threshold = min(n.density for n in path)
    block = lambda n: n if n is body else n.block
    top = block(top)
    if top.tag in SINGLE and top is not body:
        top = block(top.parent)  # a single paragraph is no page: its siblings belong to it
    marked, todo = {top}, [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node is not top:
            if node is not body:
                marked.add(block(node.best))
            todo += [c for c in node.children if isinstance(c, Node) and not c.skip]
    # a heading stands in front of what it belongs to
    holds = {None}
    for node in marked:
        while node and node not in holds:
            holds.add(node)
            node = node.parent
    for node in order:
        if node in holds and node not in marked and not node.skip:
            behind = False
            for c in reversed(node.children):
                if isinstance(c, Node) and not c.skip and c.chars:
                    behind = c in marked or behind and c.tag in HEADINGS
                    if behind:
                        marked.add(c)
    return marked


def _text(order: list[Node]) -> str:
    _measure(order)
    root = order[-1]
    body = next((n for n in reversed(order) if n.tag == "body"), root)
    if not body.chars:
        body = root
    if not body.chars:
        return ""
    ratio = body.link_chars / body.chars
    for node in order:
        if node.skip:
            continue
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
        inner = [c for c in node.children if isinstance(c, Node) and not c.skip]
        own = node.chars - sum(c.chars for c in inner)
        node.total = sum(c.density for c in inner) + _density(own, 1, own if node.link else 0, int(node.link), ratio)
    return "\n\n".join(_blocks(body, _marked(order, body)))


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    order = _order(tree.root)
    _skip(order, False)
    children_first = order[::-1]
    if not any(not n.skip and any(isinstance(c, str) and not c.isspace() for c in n.children) for n in order):
        _skip(order, True)  # all text stands in nodes named as parts of a page
    return _text(children_first)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` to the columns other than the markup."""
    ship(pages.sparkSession)

    @F.pandas_udf("text string, n_chars long")
    def read(column: pd.Series) -> pd.DataFrame:
        texts = [main_text(x) for x in column]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    rest = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")]
    return pages.select(*rest, read(F.col(html)).alias("_main")).select(*rest, "_main.text", "_main.n_chars")


def op05_html(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
