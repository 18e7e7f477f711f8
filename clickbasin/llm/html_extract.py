"""Main text of web pages: boosted trees over the nodes of the page, then one consistent choice.

A page becomes a tree of elements. Each element gets the probability that its text belongs to the
article, from gradient-boosted trees over its tag, the words in its attributes, its depth, the
density of text, links and punctuation below it, and how it compares with its siblings. A pass
over the tree then picks, for every element, one of keep, drop, or leave to the children, such
that nothing below a dropped element is kept and the total cost is least.

The trees are fitted on a bounded sample of pages, where elements with plain meaning (article,
nav, footer, class names such as comments) give the labels, and on pages put together at random
from the sample's words in many layouts, whose labels are known. Attributes and telling tags are
left out at random there, so that the shape of the text has to be learned as well.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fit sees at most so many pages of the table, of so many characters together, and so many put together.
SAMPLE_PAGES, SAMPLE_CHARS, MADE_PAGES = 300, 20_000_000, 500
# Made pages take their words from the beginnings of the sample's texts, and so many different ones in all.
WORDS_OF_A_TEXT, MADE_WORDS = 40, 5000
# What it costs to drop something inside of a kept element: the less telling parts stay.
INSIDE = 4.0

# How elements behave in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template svg select annotation annotation-xml".split()
)
# Of these, the ones that may stand inside one another.
NESTED = ("svg", "template")
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary"
    " table tbody tfoot thead tr caption ul".split()
)
CLOSES_P = BLOCK - frozenset("html body head li dt dd tr tbody thead tfoot caption".split())
# Elements of formulas, whose text belongs to the line around them.
FORMULA = frozenset(
    "math menclose merror mfenced mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup"
    " mtable mtd mtext mtr munder munderover semantics".split()
)
# Elements that do not end an open head.
IN_HEAD = RAW - frozenset("textarea xmp iframe noembed svg select annotation annotation-xml".split()) | frozenset("base basefont bgsound link meta".split())
# An element that opens ends an open one of these, up to the given borders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements whose text is never part of an article. A form may hold one; its controls do not.
NEVER = frozenset("head title script style button input select textarea nav footer aside dialog menu".split())
# Words in class, id, role or itemprop that tell what an element is for.
UNWANTED = frozenset(
    "ad ads advert advertisement advertorial banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices"
    " pagination popup promo promoted promotion recommended related replies reply search share sharing sidebar"
    " signup social sponsor sponsored subscribe tags teaser toolbar topbar widget alert paywall rail reader".split()
)
WANTED = frozenset("article articlebody body-text content entry main maintext post story text".split())
TAGS = (
    "div p section article main header footer nav aside ul ol li a h1 h2 h3 h4 span b blockquote pre table tr td"
    " figure figcaption form body"
).split()

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*>|<\?[^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_PART = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>]|$)", re.I | re.A) for tag in RAW}


def _behind_raw(page: str, tag: str, at: int) -> int:
    """Where a raw element whose head ends at ``at`` is over, or the end of the page."""
    end = None
    if tag in NESTED:
        depth = 1
        for edge in _TOKEN.finditer(page, at):
            if (edge[1] or "").lower() == tag:
                depth -= 1
            elif (edge[2] or "").lower() == tag and not edge[3].endswith("/"):
                depth += 1
            if not depth:
                end = edge.start()
                break
    elif found := _RAW_END[tag].search(page, at):
        end = found.start()
    stop = -1 if end is None else page.find(">", end)
    return stop + 1 if stop >= 0 else len(page)


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: list[str]
    parts: list = field(default_factory=list)  # texts (str) and children (int), in order
    hidden: bool = False


def parse(page: str) -> list[Node]:
    """The elements of a page, parents before children; the first is the root. Never fails."""
    nodes = [Node("#root", -1, 0, [])]
    open_ = [0]
    counts: Counter = Counter()
    at = 0

    def close(until: int) -> None:
        while len(open_) > until:
            counts[nodes[open_.pop()].tag] -= 1

    def add_text(text: str) -> None:
        if nodes[open_[-1]].tag == "head" and not text.isspace():
            close(len(open_) - 1)
        nodes[open_[-1]].parts.append(text)

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            if at < len(page):
                add_text(page[at:])
            return nodes
        if found.start() > at:
            add_text(page[at : found.start()])
        at = found.end()
        ending, opening = found.group(1), found.group(2)
        if ending:
            tag = ending.lower()
            if counts[tag] > 0:
                k = len(open_) - 1
                while nodes[open_[k]].tag != tag:
                    k -= 1
                close(k)
            continue
        if not opening:
            continue
        tag, attributes = opening.lower(), found.group(3) or ""
        if nodes[open_[-1]].tag == "head" and tag not in IN_HEAD:
            close(len(open_) - 1)
        if tag in FORMULA:
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                at = _behind_raw(page, tag, at)
            continue
        if tag in CLOSES_P and counts["p"] > 0:
            k = len(open_) - 1
            while nodes[open_[k]].tag not in ("p", "table", "button"):
                k -= 1
            if nodes[open_[k]].tag == "p":
                close(k)
        if tag in ENDS:
            ends, borders = ENDS[tag]
            for k in range(len(open_) - 1 if any(counts[end] > 0 for end in ends) else 0, 0, -1):
                if nodes[open_[k]].tag in borders:
                    break
                if nodes[open_[k]].tag in ends:
                    close(k)
                    break
        parent = open_[-1]
        node = Node(tag, parent, nodes[parent].depth + 1, [])
        if attributes and not attributes.isspace():
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), values[0] or values[1] or values[2]
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    node.words += _PART.findall(value.lower())
                elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
                    node.hidden = True
        number = len(nodes)
        nodes.append(node)
        nodes[parent].parts.append(number)
        if tag not in VOID and not (attributes.endswith("/") and tag not in BLOCK):
            open_.append(number)
            counts[tag] += 1


def beside_article(nodes: list[Node]) -> set[int]:
    """Forms that hold less than half of the page's text and nothing that marks an article, and the labels in any form."""
    forms = {i for i, node in enumerate(nodes) if node.tag == "form"}
    if not forms:
        return forms
    size = [sum(len(part.strip()) for part in node.parts if isinstance(part, str)) for node in nodes]
    marked = [node.tag in ("article", "main", "h1") for node in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        size[nodes[i].parent] += size[i]
        marked[nodes[i].parent] |= marked[i]
    out = {i for i in forms if 2 * size[i] < size[0] and not marked[i]}
    within = set(forms)
    for i, node in enumerate(nodes):
        if node.parent in within:
            within.add(i)
            if node.tag == "label":
                out.add(i)
    return out


# Of the subtree: text, linked text, elements, paragraphs, list items, punctuation, capitals and digits, words.
_SUMS = 8


def features(nodes: list[Node], odds: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each node, and the length of the text below each."""
    n = len(nodes)
    own = np.zeros((n, _SUMS))
    direct = np.zeros(n)
    place = np.zeros(n)
    parent = np.array([node.parent for node in nodes])
    in_link = np.zeros(n, dtype=bool)
    for i, node in enumerate(nodes):
        in_link[i] = node.tag == "a" or node.parent >= 0 and in_link[node.parent]
        for part in node.parts:
            if isinstance(part, str):
                size = len(part.strip())
                if size:
                    direct[i] += size
                    own[i, 0] += size
                    own[i, 1] += size * in_link[i]
                    own[i, 5] += part.count(".") + part.count(",") + part.count("?") + part.count(";")
                    own[i, 6] += part.count("|") + part.count("·") + part.count("»")
                    own[i, 7] += part.count(" ") + 1
        own[i, 2] = 1
        own[i, 3] = node.tag == "p"
        own[i, 4] = node.tag == "li"
    before = np.concatenate([[0], np.cumsum(own[:, 0])[:-1]])
    total = own.copy()
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    length, page = total[:, 0], max(1.0, total[0, 0])
    place = before / page
    up = np.maximum(parent, 0)
    children = np.bincount(up[1:], minlength=n)
    rank = np.zeros(n)
    seen: Counter = Counter()
    same: Counter = Counter((node.parent, node.tag) for node in nodes)
    for i in range(1, n):
        rank[i] = seen[up[i]]
        seen[up[i]] += 1
    link_share = total[:, 1] / np.maximum(1, length)
    siblings = np.maximum(1, children[up])
    sibling_length = length[up] / siblings
    sibling_links = np.bincount(up, link_share, n)[up] / siblings
    told = np.zeros((n, 6))
    beside = beside_article(nodes)
    for i, node in enumerate(nodes):
        known = [odds.get(word, 0.0) for word in node.words]
        told[i, 0] = min(known, default=0.0)
        told[i, 1] = max(known, default=0.0)
        told[i, 2] = any(word in UNWANTED for word in node.words) or node.hidden
        told[i, 3] = any(word in WANTED for word in node.words)
        above = told[up[i]] if i else np.zeros(6)
        told[i, 4] = max(above[4], told[i, 2], node.tag in NEVER or i in beside)
        told[i, 5] = max(above[5], told[i, 3], node.tag in ("article", "main"))
    x = np.column_stack(
        [
            [node.depth for node in nodes], children, rank, rank / siblings, siblings,
            [same[node.parent, node.tag] for node in nodes], place,
            np.log1p(length), np.log1p(direct), link_share, length / total[:, 2], length / page, length / np.maximum(1, length[up]),
            total[:, 5] / np.maximum(1, total[:, 7]), total[:, 6] / np.maximum(1, total[:, 7]), np.log1p(total[:, 3]),
            np.log1p(total[:, 4]), length / np.maximum(1, total[:, 7]), direct / np.maximum(1, length),
            np.log1p(sibling_length), sibling_links, length / np.maximum(1, sibling_length), link_share[up],
            np.log1p(length[up]), total[up, 5] / np.maximum(1, total[up, 7]),
            told, [node.hidden for node in nodes],
            np.array([[node.tag == tag for tag in TAGS] for node in nodes], dtype=float),
        ]
    )
    return x, length


@dataclass
class Trees:
    """Complete binary trees of one depth: for every inner node a feature and a limit, for every leaf a value."""

    depth: int
    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            z += leaf[at - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3) -> Trees:
    """Second-order boosting of the log loss on at most 32 bins a feature."""
    edges = [np.unique(np.quantile(column, np.linspace(0.03, 0.97, 31))) for column in x.T]
    bins = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)])
    share = min(max(float(np.average(y, weights=weight)), 0.01), 0.99)
    trees = Trees(depth, float(np.log(share / (1 - share))), *(np.empty((0, 0)),) * 3)
    z = np.full(len(y), trees.base)
    found: list[tuple] = []
    inner, pull = 2**depth - 1, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = at - first
            best = np.full(count, 1e-6)
            for f, edge in enumerate(edges):
                width = len(edge) + 1
                slot = local * width + bins[:, f]
                sum_g = np.bincount(slot, g, count * width).reshape(count, width)
                sum_h = np.bincount(slot, h, count * width).reshape(count, width)
                left_g, left_h = sum_g.cumsum(axis=1)[:, :-1], sum_h.cumsum(axis=1)[:, :-1]
                all_g, all_h = sum_g.sum(axis=1, keepdims=True), sum_h.sum(axis=1, keepdims=True)
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + pull) + right_g**2 / (right_h + pull) - all_g**2 / (all_h + pull)
                gain[(left_h < 1e-3) | (right_h < 1e-3)] = 0
                if gain.size:
                    k = gain.argmax(axis=1)
                    top = gain[np.arange(count), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + count][better] = f
                    limit[first : first + count][better] = edge[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        local = at - inner
        leaf = -rate * np.bincount(local, g, 2**depth) / (np.bincount(local, h, 2**depth) + pull)
        z += leaf[local]
        found.append((feature, limit, leaf))
    trees.feature, trees.limit, trees.leaf = (np.array(part) for part in zip(*found))
    return trees


@dataclass
class Extractor:
    odds: dict[str, float]
    trees: Trees

    def keep(self, nodes: list[Node], p: np.ndarray, length: np.ndarray) -> list[bool]:
        """For each node whether its own text is kept: the cheapest consistent choice for the tree."""
        n = len(nodes)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        weight = np.log1p(length)
        keep, drop, leave = (weight * v for v in (-np.log(p), -np.log(1 - p), np.full(n, 0.7)))
        keep, drop, leave = keep.tolist(), drop.tolist(), leave.tolist()
        beside = beside_article(nodes)
        never = [node.tag in NEVER or node.hidden or i in beside for i, node in enumerate(nodes)]
        for i in range(n - 1, -1, -1):
            if never[i]:
                keep[i] = leave[i] = float("inf")
            if i:
                up = nodes[i].parent
                drop[up] += drop[i]
                keep[up] += min(keep[i], drop[i] + INSIDE)
                leave[up] += min(keep[i], drop[i], leave[i])
        chosen = [""] * n
        kept = [False] * n
        for i in range(n):
            above = chosen[nodes[i].parent] if i else "leave"
            if above == "drop":
                chosen[i] = "drop"
            elif above == "keep":
                chosen[i] = "keep" if keep[i] <= drop[i] + INSIDE else "drop"
            else:
                least = min(keep[i], drop[i], leave[i])
                chosen[i] = "keep" if keep[i] == least else "drop" if drop[i] == least else "leave"
            kept[i] = chosen[i] == "keep"
        return kept

    def texts(self, pages: list[str]) -> list[str]:
        """The main text of each page; the pages are scored together."""
        parsed = [parse(page) for page in pages]
        rows = [features(nodes, self.odds) for nodes in parsed]
        if not rows:
            return []
        scores = self.trees.probabilities(np.concatenate([x for x, _ in rows]))
        out, at = [], 0
        for nodes, (x, length) in zip(parsed, rows):
            kept = self.keep(nodes, scores[at : at + len(x)], length)
            at += len(x)
            out.append("\n\n".join(blocks(nodes, kept)))
        return out


def blocks(nodes: list[Node], kept: list[bool]) -> list[str]:
    """The kept texts in page order, cut where a block element begins or ends."""
    out: list[str] = []
    current: list[str] = []

    def cut() -> None:
        if current:
            text = " ".join(html.unescape("".join(current)).split())
            if text:
                out.append(text)
            current.clear()

    stack: list[tuple[int, int]] = [(0, 0)]
    while stack:
        i, k = stack.pop()
        node = nodes[i]
        if k == 0 and node.tag in BLOCK:
            cut()
        while k < len(node.parts):
            part = node.parts[k]
            k += 1
            if isinstance(part, str):
                if kept[i]:
                    current.append(part)
            else:
                stack += [(i, k), (part, 0)]
                break
        else:
            if node.tag in BLOCK:
                cut()
            elif node.tag in ("br", "td", "th", "img"):
                current.append(" ")
    cut()
    return out


def plain_labels(nodes: list[Node]) -> list[bool] | None:
    """Whether each node's own text is article text, by the meaning of tags and class names; None if unclear."""
    if not any(node.tag in ("article", "main") for node in nodes):
        return None
    state = [False] * len(nodes)
    barred = [False] * len(nodes)
    beside = beside_article(nodes)
    for i, node in enumerate(nodes):
        up = node.parent
        barred[i] = (
            up >= 0 and barred[up] or node.tag in NEVER or node.hidden or i in beside
            or node.tag not in ("article", "main", "body") and any(word in UNWANTED for word in node.words)
        )
        state[i] = not barred[i] and (node.tag in ("article", "main") or up >= 0 and state[up])
    return state


def _label_rows(nodes: list[Node], state: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Per node the share of the text below it that is wanted, and the length of that text."""
    own = np.array([sum(len(t.strip()) for t in node.parts if isinstance(t, str)) for node in nodes], dtype=float)
    good = own * np.array(state)
    for i in range(len(nodes) - 1, 0, -1):
        own[nodes[i].parent] += own[i]
        good[nodes[i].parent] += good[i]
    return good / np.maximum(1, own), own


class _Maker:
    """Pages put together at random. Article texts carry a mark that the labels are read from."""

    MARK = ""

    def __init__(self, words: list[str], seed: int = 5):
        self.rng = np.random.default_rng(seed)
        self.words = words or "the of and to in is that it for as with was on be by at this from".split()

    def some(self, low: int, high: int) -> str:
        picked = self.rng.integers(0, len(self.words), int(self.rng.integers(low, high + 1)))
        return html.escape(" ".join(self.words[i] for i in picked))

    def sentence(self) -> str:
        return self.some(4, 22).capitalize() + "."

    def article(self, low: int, high: int) -> str:
        return self.MARK + " ".join(self.sentence() for _ in range(int(self.rng.integers(low, high + 1))))

    def pick(self, *choices: str) -> str:
        return choices[int(self.rng.integers(0, len(choices)))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def box(self, tags: tuple[str, ...], words: tuple[str, ...], inner: str) -> str:
        tag = self.pick(*tags) if self.chance(0.6) else "div"
        name = ""
        if self.chance(0.65):
            name = f' {self.pick("class", "class", "id")}="{self.pick(*words)}{self.pick("", "", "-box", " wide", "_1")}"'
        return f"<{tag}{name}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.some(1, 3)}</a>' for i in range(int(self.rng.integers(low, high + 1)))]
        style = self.pick("list", "bar", "plain")
        if style == "list":
            return "<ul>" + "".join(f"<li>{item}</li>" for item in items) + "</ul>"
        return (" | " if style == "bar" else " ").join(items)

    def furniture(self, place: str) -> str:
        kinds = {
            "top": ("menu", "head", "notice", "ad", "crumbs", "search"),
            "side": ("menu", "related", "ad", "sign", "about"),
            "inside": ("ad", "related", "share"),
            "end": ("related", "comments", "foot", "sign", "share", "notice", "ad", "foot", "comments"),
        }
        kind = self.pick(*kinds[place])
        p = f"<p>{self.sentence()}</p>"
        if kind == "menu":
            return self.box(("nav", "nav", "ul", "menu"), ("nav", "menu", "navigation", "topbar"), self.links(3, 12))
        if kind == "head":
            inner = f"<{self.pick('h1', 'h2', 'div', 'p')}>{self.some(1, 4)}</p>" + self.pick("", f"<p>{self.some(2, 8)}</p>")
            return self.box(("header",), ("header", "masthead", "banner"), inner)
        if kind == "notice":
            return self.box(("div", "section", "p"), ("cookie", "notice", "consent", "alert", "banner", "gdpr"), self.sentence() + self.pick("", " <button>OK</button>", ' <a href="/p">more</a>'))
        if kind == "ad":
            return self.box(("div", "aside", "section"), ("ad", "ads", "advert", "sponsored", "promo"), self.pick(self.sentence(), p, f'<a href="/x">{self.some(2, 9)}</a>'))
        if kind == "crumbs":
            return self.box(("div", "nav", "ol"), ("breadcrumb", "breadcrumbs", "pagination"), self.links(2, 4))
        if kind == "search":
            return self.box(("form", "div"), ("search", "login", "form"), f"<label>{self.some(1, 2)}</label><input>")
        if kind == "related":
            return self.box(("aside", "section", "div"), ("related", "recommended", "teaser", "sidebar", "rail"), f"<h3>{self.some(1, 3)}</h3>" + self.links(2, 6) + self.pick("", p))
        if kind == "about":
            return self.box(("aside", "div"), ("sidebar", "widget", "about"), f"<h4>{self.some(1, 3)}</h4>" + p)
        if kind == "sign":
            return self.box(("form", "div", "section"), ("newsletter", "subscribe", "signup", "paywall"), p + self.pick("", "<input><button>Go</button>"))
        if kind == "share":
            return self.box(("div", "ul"), ("share", "social", "tags", "sharing"), self.links(2, 5))
        if kind == "comments":
            own = "".join(
                self.box(("div", "li", "article"), ("comment", "reply", "reader-comment"), f"<b>{self.some(1, 2)}</b>" + self.pick(p, self.sentence(), p + p))
                for _ in range(int(self.rng.integers(1, 6)))
            )
            return self.box(("section", "div", "ol"), ("comments", "replies", "disqus"), self.pick("", f"<h3>{self.some(1, 3)}</h3>") + own)
        return self.box(("footer",), ("footer", "foot"), f"&copy; {self.some(1, 3)} &middot; {self.sentence()}" + self.pick("", self.links(2, 6)))

    def page(self) -> str:
        body = []
        for _ in range(int(self.rng.integers(1, 14))):
            kind = self.pick("p", "p", "p", "p", "p", "list", "quote", "sub", "bold")
            if kind == "list":
                body.append("<ul>" + "".join(f"<li>{self.MARK}{self.some(2, 14)}</li>" for _ in range(int(self.rng.integers(2, 6)))) + "</ul>")
            elif kind == "quote":
                body.append(f"<blockquote>{self.article(1, 3)}</blockquote>")
            elif kind == "sub":
                body.append(f"<h2>{self.MARK}{self.some(1, 6)}</h2><p>{self.article(1, 4)}</p>")
            elif kind == "bold":
                body.append(f"<p><b>{self.article(1, 2)}</b><br><p>{self.article(1, 3)}</p>")
            else:
                link = f' <a href="/y">{self.MARK}{self.some(1, 3)}</a> ' if self.chance(0.2) else ""
                body.append(f"<p>{self.article(1, 6)}{link}</p>")
            if self.chance(0.08):
                body.append(self.furniture("inside"))
        if self.chance(0.8):
            body.insert(0, f"<h1>{self.MARK}{self.some(2, 10)}</h1>")
        article = self.box(("article", "main", "section"), ("article", "content", "post", "entry", "story", "main"), "".join(body))
        top = "".join(self.furniture("top") for _ in range(int(self.rng.integers(0, 4))))
        side = "".join(self.furniture("side") for _ in range(int(self.rng.integers(0, 3))))
        end = "".join(self.furniture("end") for _ in range(int(self.rng.integers(0, 4))))
        middle = self.pick(article + side, side + article, f"<div>{article}{side}</div>", f"<main>{article}</main>{side}")
        return f"<html><head><title>{self.some(2, 6)}</title></head><body>{top}{middle}{end}</body></html>"

    def labelled(self) -> tuple[list[Node], list[bool]]:
        nodes = parse(self.page())
        state = [any(isinstance(t, str) and self.MARK in t for t in node.parts) for node in nodes]
        for node in nodes:
            node.parts = [t.replace(self.MARK, "") if isinstance(t, str) else t for t in node.parts]
        return nodes, state


def fit(pages: list[str]) -> Extractor:
    """An extractor from a bounded list of pages; it may be empty."""
    parsed = [(nodes, state) for nodes in map(parse, pages) if (state := plain_labels(nodes)) is not None]
    words = sorted({w for nodes, _ in parsed for node in nodes for t in node.parts if isinstance(t, str) for w in t.split()[:WORDS_OF_A_TEXT] if w.isalpha()})
    maker = _Maker(words[:: max(1, len(words) // MADE_WORDS)])
    data = [*parsed, *(maker.labelled() for _ in range(MADE_PAGES))]
    labels = [_label_rows(nodes, state) for nodes, state in data]
    good, bad = Counter(), Counter()
    for (nodes, _), (share, length) in zip(data, labels):
        for node, s, size in zip(nodes, share, length):
            if size:
                (good if s >= 0.5 else bad).update(set(node.words))
    odds = {word: float(np.log((good[word] + 0.5) / (bad[word] + 0.5))) for word in {*good, *bad}}
    odds |= {word: min(odds.get(word, 0.0), -2.0) for word in UNWANTED}
    rows = [features(nodes, odds)[0] for nodes, _ in data]
    share = np.concatenate([s for s, _ in labels])
    length = np.concatenate([n for _, n in labels])
    # Elements whose text is partly wanted teach nothing clear: they count by how clear they are.
    weight = np.log1p(length) * np.abs(2 * share - 1)
    pick = weight > 0
    return Extractor(odds, boost(np.concatenate(rows)[pick], (share[pick] >= 0.5).astype(float), weight[pick]))


def train(pages: DataFrame, id_column: str = "page_id", column: str = "html", most: int = SAMPLE_PAGES) -> Extractor:
    """Fit on at most ``most`` pages, picked by a hash of their ids, alike on every run.

    Pages are taken in that order while they have ``SAMPLE_CHARS`` characters together; one that would
    exceed them is passed over.
    """
    known = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("html")).dropna()
    sizes = known.groupBy("id").agg(F.max(F.length("html")).alias("n")).orderBy(F.xxhash64("id"), "id").limit(most)
    ids, room = [], SAMPLE_CHARS
    for row in sizes.collect():  # ``most`` rows of an id and a number
        if row.n <= room:
            ids.append(row.id)
            room -= row.n
    chosen = known.where(F.col("id").isin(ids)).groupBy("id").agg(F.max("html").alias("html"))
    return fit([row.html for row in sorted(chosen.collect())])


def main_text(extractor: Extractor, page: Column) -> Column:
    """The main text of a page, whole: its blocks, joined by an empty line.

    A null or empty page, or one without an article, gives an empty text. Markup of any kind,
    however broken, is read without failing.
    """

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), 200):
                out += extractor.texts([page or "" for page in batch[at : at + 200].to_pylist()])
            yield pa.array(out, pa.string())

    return extract(page)
