"""Main text of web pages by composite text density.

Each element of the DOM has a density: characters for each tag, adjusted for how many of both are in links. Of all
elements, the one whose children's densities sum highest is content; the least density on the path from it up to body is
the threshold, and in every other element that reaches it the subtree of the highest sum is content as well. Elements that
are boilerplate by tag or role, or by class or id where they aren't most of the page, have no part in that and are left out
of the text; so are blocks of links beside the content. An article or main element decides between equal sums only.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
#: A name and its value; a value is consumed with its name, so nothing is found inside it.
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s"'>][^\s>]*+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends where one of the second begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
#: Elements beyond which such an end is not looked for.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}}
#: Never part of an article's text.
NEVER = frozenset("head script style noscript template title textarea select button input form nav footer aside menu iframe object svg canvas dialog xmp noembed noframes datalist".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar sidebars navbar nav navigation menu menus breadcrumb breadcrumbs header masthead footer comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations widget widgets toolbar login search copyright disclaimer pagination pager".split()
)
#: Of these, the names that head no section of an article; others can be what a section is about.
SURE = frozenset("adsense navbar breadcrumb breadcrumbs masthead comments commentlist disqus sidebar sidebars pagination pager".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Of the names, those that a paragraph by itself can have that is none of the article's.
PARAGRAPH = frozenset("ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored breadcrumb breadcrumbs comment comments cookie cookies consent gdpr newsletter pagination pager".split())
#: Readers' comments, however long.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: A class that begins so says what an element has or lacks.
ABOUT = ("no-", "not-", "has-", "with-", "without-", "is-", "hide-", "show-")
KEEP = frozenset("article main h1".split())
PARTS = ("article", "main")
UNSEEN = frozenset("head script style noscript template".split())
HOLDERS = frozenset("ul ol menu dl table select".split())
#: Elements that can be all of an article, those that stay if they stand beside content, and those that can be menus.
CONTAINERS = frozenset("article main section div center td body html".split())
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure b i em strong span a".split())
GROUPS = frozenset("div section ul ol table dl center".split())
#: Named by class or id only; named for sure.
WEAK, STRONG = 1, 2


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "holds", "part", "article", "chars", "tags", "link_chars", "link_tags", "density", "total", "alive", "peak", "marked")

    def __init__(self, tag: str, parent: Node | None, noise: int = 0):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.children: list[Node | str] = []
        self.holds = tag in KEEP
        self.part = tag in PARTS or parent is not None and parent.part  # inside an article or main element, or one itself
        self.article = tag == "article" or parent is not None and parent.article
        self.alive = self.marked = False


def named(value: str) -> set[str]:
    """The words of a class or id; a word that says what an element has or lacks says nothing of what it is."""
    return {w for token in value.split() if not token.startswith(ABOUT) for w in re.split("[_-]+", token)}


def noise_of(tag: str, attributes: str, parent: Node | None = None) -> int:
    """Whether tag, role or hidden attribute (STRONG), class or id (WEAK but for comments) name boilerplate; else 0.

    The ids of headings, and of sections inside an article or main element, are often made of the heading's words: a
    heading's id says nothing, a section's only if all its words are names and one is of SURE. Of a paragraph, only the
    names count that no article's own paragraphs have.
    """
    if tag in NEVER:
        return STRONG
    if not attributes or tag in ("body", "html", "article", "main"):
        return 0
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), "".join(values).lower())  # the first of a name counts
    if "hidden" in found or found.get("role") in ROLES:
        return STRONG
    names = PARAGRAPH if tag in ("p", "blockquote", "pre") else NAMES
    classes, words = named(found.get("class", "")), named(found.get("id", ""))
    if names.isdisjoint(classes):
        if names.isdisjoint(words) or tag in HEADINGS:
            return 0
        if (tag == "section" or "section" in found.get("class", "").split()) and parent is not None and parent.part and not (words <= NAMES and not SURE.isdisjoint(words)):
            return 0
    return WEAK if COMMENTS.isdisjoint(classes | words) else STRONG


class Open:
    """The open elements, innermost last, with what a tag needs to know of them in constant time."""

    def __init__(self, root: Node):
        self.nodes, self.blocks, self.scopes, self.count = [root], [root], [root], {}

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1
        if node.tag in BLOCK:
            self.blocks.append(node)
        if node.tag in ENDS or node.tag in HOLDERS:
            self.scopes.append(node)

    def close(self, node: Node) -> None:
        """Closes node, which is open, and all that is open in it."""
        while True:
            last = self.nodes.pop()
            self.count[last.tag] -= 1
            for stack in (self.blocks, self.scopes):
                if stack[-1] is last:
                    stack.pop()
            if last is node:
                return

    def end(self, tag: str) -> None:
        if self.count.get(tag):
            at = len(self.nodes) - 1
            while self.nodes[at].tag != tag:
                at -= 1
            self.close(self.nodes[at])


def parse(page: str) -> Node:
    """The page's DOM; ends that are missing or wrong are taken as browsers take the usual ones. Linear in the page."""
    root = Node("html", None)
    open_, body = Open(root), None
    place, n = 0, len(page)
    while place < n:
        found = TOKEN.search(page, place)
        start = found.start() if found else n
        if start > place:
            open_.nodes[-1].children.append(html.unescape(page[place:start]))
        if not found:
            break
        place = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag or tag == "html":
            continue
        attributes = found[3] or found[6] or ""
        if found[1] or found[4]:
            if tag == "br":
                open_.nodes[-1].children.append(" ")
            elif tag != "body":
                open_.end(tag)
            continue
        if tag == "body":
            open_.end("head")
            if body is None:
                body = Node("body", open_.nodes[-1])
                body.parent.children.append(body)
                open_.push(body)
            continue
        if tag in BLOCK:  # a block ends an open paragraph, with what is open in it
            near = open_.blocks[-1]
            if near.tag == "p" or near.tag in HEADINGS and tag in HEADINGS:
                open_.close(near)
        near = open_.scopes[-1]
        if tag in ENDS.get(near.tag, ()):
            open_.close(near)
        at = open_.nodes[-1]
        if tag == "br":
            at.children.append(" ")
        node = Node(tag, at, noise_of(tag, attributes, at))
        at.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, place)
            if tag in ("textarea", "title"):
                node.children.append(html.unescape(page[place : end.start()]))
            place = end.end()
        elif tag not in VOID and not attributes.endswith("/"):
            open_.push(node)
    return root


def elements(node: Node) -> list[Node]:
    return [x for x in node.children if isinstance(x, Node) and x.tag not in UNSEEN]


def measure(root: Node) -> list[Node]:
    """Counts of every element, without head, scripts and styles; the elements in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += reversed(elements(node))
    for node in reversed(order):
        own = elements(node)
        node.chars = sum(len(x.strip()) for x in node.children if isinstance(x, str)) + sum(x.chars for x in own)
        node.tags = sum(x.tags + 1 for x in own)
        link = node.tag in ("a", "button", "select")
        node.link_chars = node.chars if link else sum(x.link_chars for x in own)
        node.link_tags = node.tags + 1 if link else sum(x.link_tags for x in own)
        node.holds = node.holds or any(x.holds for x in own)
    return order


def composite(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters for each tag, adjusted for how many of both are in links; share: the body's part of characters in links.

    The base of the logarithm is e at least: on a page with few links it would be next to 1, and short texts the densest.
    """
    if not chars:
        return 0.0
    tags = max(1, tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    return chars / tags * math.log(chars / max(1, link_chars) * (tags / max(1, link_tags))) / max(1.0, math.log(base))


def weigh(order: list[Node], body: Node) -> None:
    """Density of every element, the sum of its children's, and the element of the highest sum in its subtree (peak).

    Elements that name boilerplate aren't alive, nor is what they hold. One whose class or id does so is, if it holds an
    article, a main element or a first heading, or if the page has none and it holds most of the text that isn't in links.
    """
    share = body.link_chars / max(1, body.chars)
    most = (body.chars - body.link_chars) / 2
    for node in order:
        node.density = composite(node.chars, node.tags, node.link_chars, node.link_tags, share)
        real = not node.noise or node.tag not in NEVER and node.holds or node.noise == WEAK and not body.holds and node.chars - node.link_chars > most
        node.alive = real and (node.parent is None or node.parent.alive)
    for node in reversed(order):
        own = elements(node)
        node.total = sum(x.density for x in own)
        node.peak = max([node, *(x.peak for x in own if x.alive)], key=lambda x: (-1.0 if of_links(x) else x.total, x.tag in PARTS))


def of_links(node: Node) -> bool:
    """Whether a block has most of its text in links: no sum of its own then makes it content."""
    return node.tag in GROUPS and 2 * node.link_chars > node.chars


def chosen(order: list[Node], body: Node) -> Node:
    """Marks the elements that are content and returns the one with the highest density sum.

    The least density on the path from that one up to body is the threshold: of each element that reaches it, the part of
    the highest sum is content. Beside an article or main element, what is outside any such must be as dense as it. A
    block that isn't on the path and has most of its text in links is none, nor is anything in it.
    """
    best = body.peak
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold, onward = min(x.density for x in path), set(path)
    whole = next((x for x in path if x.tag in PARTS), None)
    stack = [body]
    while stack:
        node = stack.pop()
        if node.marked or not node.alive or node not in onward and of_links(node):
            continue
        if node.density >= (threshold if whole is None or node.part or node.holds else max(threshold, whole.density)):
            peak = node.peak
            while peak.tag not in CONTAINERS and peak.parent is not None and peak.parent is not body:
                peak = peak.parent  # a paragraph by itself is not all of an article
            peak.marked = True
        if not node.marked:
            stack += elements(node)
    return best


def is_menu(node: Node) -> bool:
    """Whether a block is little but links."""
    return node.tag in GROUPS and node.link_tags >= 3 and 3 * node.link_chars >= 2 * node.chars


def blocks(body: Node) -> list[str]:
    """The texts of the content's blocks in page order, white space as one space, without boilerplate.

    Beside a marked element, headings, paragraphs, lists and tables of little link text are content, too, however short.
    """
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    def fits(x: Node, beside: bool) -> bool:
        return x.tag in FLOW and beside and 2 * x.link_chars <= x.chars

    stack: list[tuple[Node | str | None, bool]] = [(body, body.marked)]
    while stack:
        x, content = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            if content:
                held.append(x)
        elif x is body or x.tag not in UNSEEN and x.alive and not (x.tag == "header" and not x.article) and not (content and body.marked and not x.article and is_menu(x)):
            content = content or x.marked
            beside = not content and any(isinstance(y, Node) and y.marked for y in x.children)
            if x.tag in BLOCK:
                end()
                stack.append((None, False))
            stack += [(y, content or isinstance(y, Node) and fits(y, beside)) for y in reversed(x.children)]
    end()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, joined by an empty line; empty for null, empty or textless pages."""
    if not page:
        return ""
    root = parse(page)
    order = measure(root)
    body = next((x for x in order if x.tag == "body"), root)
    if not body.chars:
        return ""
    weigh(order, body)
    chosen(order, body)
    return "\n\n".join(blocks(body))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars for each row of pages; other columns are not looked at, whatever their names.

    Null, empty and textless pages have an empty text. Null ids and urls stay. Equal rows give equal rows, no rows none.
    One pass, no shuffle; a task holds a batch of pages, and time is linear in a page's length, however deep its elements.
    """

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in column], dtype=object)

    out = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text(F.col(html)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
