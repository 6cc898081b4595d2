"""Main text of web pages by composite text density.

The DOM is built leniently: a new block ends an open paragraph, an end tag ends what is open inside
it, what is open at the end of the page is ended there. Each node of the body has its characters C,
tags T, link characters LC and link tags LT, and with those of the body, CB and LCB,

    density = C / T * log(C / LC * T / LT, base = ln(C / (C - LC) * LC + LCB / CB * C + e))

where zero counts as 1: text a tag, lowered for links. Elements that only format text are no tags of
their own. A node's sum is that of its children's densities. The subtree with the greatest sum is
content; the least density on the path from it up to the body is the threshold. Of every other node
that reaches it, the subtree with the greatest sum is content too. Parts that are no text of the
article by their element, role or name (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) are cut before.

Text of a block is brought to single spaces and trimmed, blocks are joined in page order by an empty
line. A null page or one without text gives the empty text. Pages are independent rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.text import whole_text

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split())
CUT = frozenset(
    "nav header footer aside form script style noscript template head title button select textarea "
    "input iframe svg canvas object audio video menu dialog fieldset".split())
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form "
    "toolbar".split())
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement adbox adsense banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay popup promo promoted promotion recommended "
    "related reply replies respond search share sharing shoutbox sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split())
FORMATTING = frozenset(
    "abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
PARAGRAPH_ENDERS = BLOCKS - {"option"}
_PART = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ARTICLE_PARTS = frozenset("article body content entry main page post story text".split())


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "kept")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.children: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.kept = False


def _unwanted(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the element is no part of an article, by its kind, role, state or name."""
    if tag in CUT:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.lower() in CUT_ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = _PART.findall(_CAMEL.sub("-", word).lower())
                if CUT_NAMES.intersection(parts) and not _ARTICLE_PARTS.intersection(parts):
                    return True
    return False


class Tree(HTMLParser):
    """The DOM of a page; text nodes are strings among the children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None, False)
        self.body: Node | None = None

    def _close(self, tags: frozenset[str] | set[str], scope: frozenset[str]) -> None:
        """End the innermost open element of ``tags`` that no element of ``scope`` holds back."""
        node = self.at
        while node.parent is not None and node.tag not in scope:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag == "body":
            if self.body is None:
                self.at = self.body = self._add(self.root, tag, attrs)
            return
        if tag in PARAGRAPH_ENDERS:
            self._close({"p"}, BLOCKS - {"p"})
        if tag == "li":
            self._close({"li"}, frozenset(("ul", "ol", "menu")))
        elif tag in ("dt", "dd"):
            self._close({"dt", "dd"}, frozenset(("dl",)))
        elif tag in ("td", "th"):
            self._close({"td", "th"}, frozenset(("tr", "table")))
        elif tag == "tr":
            self._close({"tr"}, frozenset(("table",)))
        elif tag == "option":
            self._close({"option"}, frozenset(("select",)))
        if tag not in ("head", "body") and self.at.tag == "head" and tag in BLOCKS:
            self.at = self.root
        node = self._add(self.at, tag, attrs)
        if tag not in VOID:
            self.at = node

    def _add(self, parent: Node, tag: str, attrs) -> Node:
        node = Node(tag, parent, _unwanted(tag, attrs))
        parent.children.append(node)
        return node

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in ("body", "article", "main", "td", "th") and tag not in BLOCKS:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if data:
            self.at.children.append(data)


def _ordered(root: Node) -> list[Node]:
    """All nodes that are not cut, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.cut)
    return out


def _measure(body: Node) -> list[Node]:
    nodes = _ordered(body)
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(" ".join(child.split()))
            elif not child.cut:
                node.chars += child.chars
                node.tags += child.tags + (child.tag not in FORMATTING)
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, lc = node.chars, node.link_chars
        if not c:
            continue
        tags, links = max(1, node.tags), max(1, node.link_tags)
        ratio = c / max(1, lc) * tags / links
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        # logarithm in a base that is 1 where there are no links at all: then the plain ratio
        weight = math.log(max(1.0, ratio)) / math.log(base) if base > 1 else math.log(ratio + 1)
        node.density = c / tags * max(0.0, weight)
    for node in nodes:
        node.total = sum(c.density for c in node.children
                         if isinstance(c, Node) and not c.cut and c.tag not in FORMATTING)
    return nodes


def _blocks(body: Node) -> Iterator[str]:
    """Texts of the blocks of the content in page order."""
    held: list[str] = []
    todo: list = [body]
    while todo:
        item = todo.pop()
        if item is None:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                yield text
        elif isinstance(item, str):
            held.append(item)
        elif not item.cut:
            inner = [c for c in reversed(item.children) if item.kept or isinstance(c, Node)]
            if item.tag == "br":
                held.append(" ")
            elif item.tag in BLOCKS:
                todo += [None, *inner, None]
            else:
                todo += inner


def extract(html: str | None) -> str:
    """The main text of a page."""
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    body = tree.body or tree.root
    nodes = _measure(body)
    if not body.chars:
        return ""
    most: dict[Node, Node] = {}  # the node with the greatest sum below each, the first of equals
    for node in reversed(nodes):
        best = node
        for child in node.children:
            if isinstance(child, Node) and not child.cut and most[child].total > best.total:
                best = most[child]
        most[node] = best
    threshold, node = math.inf, most[body]
    while True:
        threshold = min(threshold, node.density)
        if node is body:
            break
        node = node.parent
    for node in nodes:
        if node.chars and node.density >= threshold and node.tag not in FORMATTING:
            most[node].kept = True
    for node in nodes:  # parents first: what content holds is content
        if node.parent is not None and node.parent.kept and node is not body:
            node.kept = True
    return "\n\n".join(_blocks(body))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(extract)

    return (pages.select("page_id", "url", main_text(whole_text("html")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
