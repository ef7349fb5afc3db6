"""A small DOM for text extraction: block-level nodes, their text blocks and features."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser
from math import log1p

#: Elements that do not break a line of text; they are part of the block around them.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("script style template noscript head title iframe object svg math select option textarea button audio video canvas datalist".split())
#: A start tag of the key ends an open element of the values, up to the barrier elements.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th", "thead", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
BARRIERS = frozenset("table ul ol dl article section div body html".split())
BLOCKS_THAT_END_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())

KINDS = [
    "article main",
    "p",
    "h1 h2 h3 h4 h5 h6",
    "li ul ol dl dt dd menu",
    "nav",
    "header",
    "footer",
    "aside",
    "form fieldset input",
    "section div",
    "table thead tbody tr td th",
    "blockquote pre figure figcaption",
]
KIND_OF = {tag: i for i, tags in enumerate(KINDS) for tag in tags.split()}
#: Words of class, id and role attributes, by what they tell of.
TOKENS = [
    "article content post entry story main body text prose blog page news copy",
    "nav menu navigation breadcrumb breadcrumbs tabs toc pagination pager skip",
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner dfp commercial",
    "comment comments reply replies discussion disqus respond thread feedback",
    "footer foot copyright colophon legal",
    "header head masthead top topbar logo brand",
    "sidebar side aside rail widget widgets secondary",
    "cookie cookies consent notice notices alert gdpr popup modal overlay warning message dialog",
    "form search login signup subscribe newsletter register input contact",
    "share social related recommended more tags author meta byline popular trending follow",
]
TOKEN_OF = {word: i for i, words in enumerate(TOKENS) for word in words.split()}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: list[int]
    children: list[int] = field(default_factory=list)
    texts: list[list[str]] = field(default_factory=list)  # blocks of this node itself
    link_chars: int = 0
    own_chars: int = 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", -1, 0, [0] * len(TOKENS))]
        self.stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block node each belongs to
        self.order: list[tuple[int, int]] = []  # (node, block) in page order
        self.silent: list[str] = []
        self.links = 0
        self.fresh = True

    def _pop(self, to: int) -> None:
        for tag, _ in self.stack[to:]:
            self.links -= tag == "a"
            self.fresh |= tag not in INLINE
        del self.stack[to:]

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag == "body":
                self.silent.clear()
            else:
                if tag not in VOID and tag == self.silent[-1]:
                    self.silent.append(tag)
                return
        if tag in SILENT:
            self.silent.append(tag)
            return
        if tag == "br":
            self.handle_data("\n")
            return
        if tag == "html":
            return
        if tag in BLOCKS_THAT_END_P:
            self._end({"p"}, BARRIERS)
        if tag in CLOSES:
            self._end(CLOSES[tag], BARRIERS - {tag} if tag in BARRIERS else BARRIERS)
        at = self.stack[-1][1]
        if tag not in INLINE:
            self.fresh = True
            tokens = [0] * len(TOKENS)
            for name, value in attrs:
                if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                    for word in _WORD.findall(value):
                        kind = TOKEN_OF.get(word.lower())
                        if kind is not None:
                            tokens[kind] += 1
            self.nodes.append(Node(tag, at, self.nodes[at].depth + 1, tokens))
            at = len(self.nodes) - 1
            self.nodes[self.nodes[at].parent].children.append(at)
        if tag not in VOID:
            self.stack.append((tag, at))
            self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SILENT and self.silent:
            self.silent.pop()
        elif tag not in VOID and len(self.stack) > 1 and self.stack[-1][0] == tag:
            self._pop(len(self.stack) - 1)

    def _end(self, tags, barriers) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                self._pop(i)
                return
            if self.stack[i][0] in barriers:
                return

    def handle_endtag(self, tag):
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
            elif tag == "head":
                self.silent.clear()
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return

    def handle_data(self, data):
        if self.silent:
            return
        at = self.stack[-1][1]
        node = self.nodes[at]
        if self.fresh or not node.texts:
            if not data.strip():
                return
            node.texts.append([])
            self.order.append((at, len(node.texts) - 1))
            self.fresh = False
        node.texts[-1].append(data)
        size = len(data.strip())
        node.own_chars += size
        node.link_chars += size if self.links else 0


@dataclass(slots=True)
class Page:
    nodes: list[Node]
    order: list[tuple[int, int]]

    def block(self, node: int, block: int) -> str:
        return " ".join("".join(self.nodes[node].texts[block]).split())


def parse(html: str | None) -> Page:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return Page(builder.nodes, builder.order)


N_FEATURES = 16 + 2 * len(TOKENS) + len(KINDS) + 8


def features(page: Page) -> list[list[float]]:
    """A row for each node: what it is, what lies below it, what surrounds it and what stands above it."""
    nodes = page.nodes
    n = len(nodes)
    chars, links, tags, words, stops, depth_below = ([0] * n for _ in range(6))
    start, paragraphs = [0] * n, [0] * n
    total = 0
    seen = [False] * n
    for node, block in page.order:
        at = node
        while at >= 0 and not seen[at]:
            seen[at], start[at] = True, total
            at = nodes[at].parent
        total += sum(len(t) for t in nodes[node].texts[block])
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        own = "".join("".join(t) for t in node.texts)
        chars[i] += node.own_chars
        links[i] += node.link_chars
        words[i] += own.count(" ")
        stops[i] += own.count(".") + own.count(",")
        tags[i] += 1
        paragraphs[i] += node.tag == "p"
        p = node.parent
        if p >= 0:
            chars[p] += chars[i]
            links[p] += links[i]
            words[p] += words[i]
            stops[p] += stops[i]
            tags[p] += tags[i]
            paragraphs[p] += paragraphs[i]
            depth_below[p] = max(depth_below[p], depth_below[i] + 1)
    above: list[list[int]] = [[0] * (len(TOKENS) + 8) for _ in range(n)]
    marks = {"article": 0, "main": 0, "nav": 1, "header": 2, "footer": 3, "aside": 4, "form": 5, "table": 6, "li": 7, "ul": 7}
    place = [0] * n
    tags_below: dict[int, Counter[str]] = {}
    out = []
    for i, node in enumerate(nodes):
        p = node.parent
        if p >= 0:
            up = above[i] = list(above[p])
            for k, count in enumerate(nodes[p].tokens):
                up[k] = max(up[k], min(count, 1))
            mark = marks.get(nodes[p].tag)
            if mark is not None:
                up[len(TOKENS) + mark] = 1
            siblings = nodes[p].children
            if p not in tags_below:
                tags_below[p] = Counter(nodes[s].tag for s in siblings)
            same = tags_below[p][node.tag]
        else:
            up, siblings, same = above[i], [0], 1
        for k, c in enumerate(node.children):
            place[c] = k
        kinds = [0.0] * len(KINDS)
        kind = KIND_OF.get(node.tag)
        if kind is not None:
            kinds[kind] = 1.0
        around = (chars[p] - chars[i]) / max(1, len(siblings) - 1) if p >= 0 else 0
        out.append(
            [
                log1p(chars[i]),
                log1p(node.own_chars),
                chars[i] / max(1, total),
                links[i] / max(1, chars[i]),
                chars[i] / tags[i],
                words[i] / max(1, chars[i]),
                stops[i] / max(1, words[i] + 1),
                log1p(tags[i]),
                log1p(paragraphs[i]),
                float(node.depth),
                float(depth_below[i]),
                start[i] / max(1, total),
                float(place[i]),
                same / len(siblings),
                log1p(around),
                links[p] / max(1, chars[p]) if p >= 0 else 0.0,
                *map(float, node.tokens),
                *map(float, up),
                *kinds,
            ]
        )
    return out


def decoded(page: Page, logits: list[float]) -> list[bool]:
    """Which nodes to keep: the ancestor-closed set of largest total score, so no kept node lies in a dropped one.

    A node's score is its logit, weighted by the text that hangs on the decision: its own, and a
    little for what lies below.
    """
    nodes = page.nodes
    value = [logit * (1.0 + log1p(node.own_chars)) for logit, node in zip(logits, nodes)]
    for i in range(len(nodes) - 1, 0, -1):
        if value[i] > 0:
            value[nodes[i].parent] += value[i]
    keep = [False] * len(nodes)
    for i, node in enumerate(nodes):
        keep[i] = value[i] > 0 and (node.parent < 0 or keep[node.parent])
    return keep


def main_text(page: Page, keep: list[bool]) -> str:
    blocks = (page.block(node, block) for node, block in page.order if keep[node])
    return "\n".join(b for b in blocks if b)
