"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a variable, content or boilerplate. Its own features give it a potential; each pair of
parent and child has another, chosen by the kind of the child. Messages passed from the leaves to the root and back give
the exact marginal of every element, and text whose block is content with probability one half or more is kept.
Potentials are learned from labelled pages: ``labelled_pages`` writes a fixed number of them from templates; ``train`` takes
any others, in which elements carry ``data-content="1"`` or ``"0"`` (unmarked ones take their parent's label).

Defined cases: a null or empty page, or one without text, has an empty text; unclosed, crossed and stray tags are repaired;
an unfinished tag at the end is text; pages are judged one by one, so ties and repeated rows do not matter; extra columns
pass through.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
QUOTE_OR_END = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
TOKEN = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Never text of a page, whatever the model says.
HIDDEN = frozenset("head button select option optgroup datalist svg math canvas object audio video map".split()) | RAW
#: An opening tag ends these open elements, unless one of the second set stands between.
ENDS = {
    "li": ("li", frozenset(("ul", "ol", "menu"))),
    "dt": ("dt dd", frozenset(("dl",))),
    "dd": ("dt dd", frozenset(("dl",))),
    "tr": ("tr td th", frozenset(("table",))),
    "td": ("td th", frozenset(("table", "tr"))),
    "th": ("td th", frozenset(("table", "tr"))),
    "option": ("option", frozenset(("select",))),
}
ENDS = {k: (frozenset(a.split()), b) for k, (a, b) in ENDS.items()}
SCOPE = frozenset("article aside body div footer form header html main nav section table td th ul ol li blockquote figure".split())


class Node:
    __slots__ = ("attributes", "children", "label", "links", "parent", "runs", "tag", "text")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []
        self.text, self.links, self.runs, self.label = 0, 0, [], None


class Tags:
    """The tags of a page, from left to right, in time linear in the page whatever it holds.

    A quote that is never closed does not hide what follows: such a tag ends at the first ``>``.
    """

    def __init__(self, html: str):
        self.html = html
        self.missing: dict[str, int] = {}  # no such string from this place on
        self.failed: set[int] = set()  # quotes from which no end of a tag is found
        self.next = (0, -1)  # from the first place to the second no quote and no end

    def _find(self, what: str, at: int) -> int:
        if at >= self.missing.get(what, len(self.html)):
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing[what] = at
        return found

    def _stop(self, at: int) -> int:
        """The first quote or end of a tag from ``at`` on."""
        if not self.next[0] <= at <= self.next[1]:
            m = QUOTE_OR_END.search(self.html, at)
            self.next = (at, m.start() if m else len(self.html))
        return self.next[1]

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``."""
        seen, here = [], at
        while (place := self._stop(here)) < len(self.html):
            if self.html[place] == ">":
                return place
            seen.append(place)
            close = -1 if place in self.failed else self._find(self.html[place], place + 1)
            if close < 0:
                break
            here = close + 1
        self.failed.update(seen)
        return self._find(">", at)

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """Start, end, whether it closes, name and attributes; comments and declarations have no name."""
        html, at = self.html, 0
        while (at := self._find("<", at)) >= 0:
            if html.startswith("<!--", at):
                end = self._find("-->", at + 4)
                end = len(html) if end < 0 else end + 3
                yield at, end, False, "", ""
            elif html[at + 1 : at + 2] in ("!", "?"):
                end = self._find(">", at) + 1
                if end:
                    yield at, end, False, "", ""
            elif m := NAME.match(html, at):
                end = self._end(m.end()) + 1
                if end:
                    name = m[2].lower()
                    if name in RAW and not m[1]:
                        close = re.compile(f"</{name}\\s*>", re.I).search(html, end)
                        yield at, close.end() if close else len(html), False, "", ""
                        end = close.end() if close else len(html)
                    else:
                        yield at, end, bool(m[1]), name, html[m.end() : end - 1]
            else:
                end = 0
            at = end or at + 1


class Open:
    """The open elements; inline ones share the block around them. Every look-up takes a bounded number of steps."""

    def __init__(self, root: Node):
        self.tags, self.blocks = ["html"], [root]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.scopes = [0]  # places of elements beyond which most end tags do not reach
        self.links = self.hidden = 0

    def push(self, tag: str, block: Node) -> None:
        place = len(self.tags)
        self.tags.append(tag)
        self.blocks.append(block)
        self.places.setdefault(tag, []).append(place)
        if tag in SCOPE:
            self.scopes.append(place)
        self.links += tag == "a"
        self.hidden += tag in HIDDEN

    def pop(self, to: int) -> bool:
        """Close all elements from place ``to`` on; whether one of them was a block."""
        block = False
        while len(self.tags) > to:
            tag = self.tags.pop()
            self.blocks.pop()
            self.places[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            self.links -= tag == "a"
            self.hidden -= tag in HIDDEN
            block = block or tag not in INLINE
        return block

    def last(self, tags) -> int:
        """Place of the innermost of these elements, 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def first_after(self, tags, place: int) -> int:
        """Place of the outermost of these elements inside the one at ``place``, 0 if there is none."""
        found = []
        for t in tags:
            mine = self.places.get(t, ())
            k = bisect_right(mine, place)
            if k < len(mine):
                found.append(mine[k])
        return min(found, default=0)


def parse(html: str) -> tuple[Node, list[Node], list[tuple[Node, list[str]]]]:
    """The root, all block elements in page order (parents first), and runs of text with the block they stand in."""
    root = Node("html", "", None)
    blocks, runs, run = [root], [], []
    opened = Open(root)
    at = 0

    def flush() -> None:
        nonlocal run
        if run:
            runs.append((opened.blocks[-1], run))
            run = []

    def close(to: int) -> None:
        if any(t not in INLINE for t in opened.tags[to:]):
            flush()
        opened.pop(to)

    def say(piece: str) -> None:
        if opened.hidden or not piece:
            return
        piece, owner = unescape(piece), opened.blocks[-1]
        run.append(piece)
        n = len(piece.strip())
        owner.text += n
        owner.links += n if opened.links else 0

    for start, end, closes, tag, attributes in Tags(html):
        say(html[at:start])
        at = end
        if not tag:
            continue
        if closes:
            place = opened.last((tag,))
            if place and (tag not in INLINE or place > opened.scopes[-1]):
                close(place)
            continue
        if tag in VOID:
            if tag == "br":
                say(" ")
            elif tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            place = opened.last("p")
            if place > opened.scopes[-1]:  # a block ends an open paragraph
                close(place)
            if tag in ENDS:
                ended, stop = ENDS[tag]
                bound = opened.last(stop)
                place = opened.first_after(ended, bound) if tag == "tr" else opened.last(ended)
                if place > bound:
                    close(place)
            flush()
            if tag == "html" or tag == "body" and opened.last(("body",)):
                continue
            owner = opened.blocks[-1]
            node = Node(tag, attributes, owner)
            owner.children.append(node)
            blocks.append(node)
            opened.push(tag, node)
        else:
            opened.push(tag, opened.blocks[-1])
    say(html[at:])
    flush()
    return root, blocks, runs


def names(node: Node) -> set[str]:
    """Words of class, id, role and label."""
    out = set()
    if node.attributes:
        for k, a, b, c in ATTRIBUTE.findall(node.attributes):
            if k.lower() in ("class", "id", "role", "aria-label", "itemprop"):
                out.update(TOKEN.findall((a or b or c).lower()))
    return out


def steps(x: float, bounds: tuple[float, ...]) -> int:
    return sum(x > b for b in bounds)


def features(node: Node, total: tuple[int, int], page: int) -> list[str]:
    """What a block shows of itself. ``total`` are characters of text and of links at or below it, ``page`` those of the page."""
    (text, links), children = total, len(node.children)
    under = node.parent.tag if node.parent is not None else ""
    out = [f"tag={node.tag}", f"under={under}>{node.tag}", f"{'inner' if children else 'leaf'}={steps(text, (0, 25, 80, 200, 600))}", f"own={steps(node.text, (0, 25, 80, 200))}"]
    out.append(f"links={steps(links / text if text else 0, (0.05, 0.3, 0.6, 0.9))}")
    out.append(f"children={steps(children, (0, 2, 8))}")
    if children:
        out.append(f"share={steps(text / page if page else 0, (0.02, 0.1, 0.3, 0.6, 0.85))}")
        out += [f"has={tag}" for tag in {c.tag for c in node.children}]
    for w in names(node):
        out += [f"name={w}", f"name={w}.{node.tag}"]
    return out


def totals(blocks: list[Node]) -> dict[int, tuple[int, int]]:
    out = {id(b): [b.text, b.links] for b in blocks}
    for b in reversed(blocks):
        if b.parent is not None:
            up, own = out[id(b.parent)], out[id(b)]
            up[0] += own[0]
            up[1] += own[1]
    return out


#: Kinds of children with a potential of their own; all others share one.
EDGE_KINDS = frozenset(
    "p li ul ol dl dt dd div section article main h1 h2 h3 h4 h5 h6 blockquote pre table thead tbody tfoot tr td th caption figure figcaption details summary address header footer aside nav form".split()
)


def edge_kind(node: Node) -> str:
    return node.tag if node.tag in EDGE_KINDS else "other"


class Model:
    """Weights of features for ``content`` and, per kind of child, log potentials [parent][child]."""

    def __init__(self, weights: dict[str, float], edges: dict[str, list[list[float]]]):
        self.weights, self.edges = weights, edges

    def marginals(self, blocks: list[Node]) -> list[float]:
        """Probability that each block is content."""
        total, w = totals(blocks), self.weights
        shown = (features(b, total[id(b)], total[id(blocks[0])][0]) for b in blocks)
        return propagate(blocks, [w["bias"] + sum(w.get(f, 0.0) for f in x) for x in shown], self.edges)


def propagate(blocks: list[Node], own: list[float], edges: dict[str, list[list[float]]]) -> list[float]:
    """Sum-product up and down the tree. ``own`` is each block's log odds by itself."""
    number = {id(b): i for i, b in enumerate(blocks)}
    parents = [-1 if b.parent is None else number[id(b.parent)] for b in blocks]
    kinds = [edges.get(edge_kind(b)) or edges["other"] for b in blocks]
    low, high = [0.0] * len(blocks), list(own)  # log of the potential times the children's messages, for 0 and 1
    up = [(0.0, 0.0)] * len(blocks)
    for i in range(len(blocks) - 1, 0, -1):
        e, p = kinds[i], parents[i]
        up[i] = (log_sum(e[0][0] + low[i], e[0][1] + high[i]), log_sum(e[1][0] + low[i], e[1][1] + high[i]))
        low[p] += up[i][0]
        high[p] += up[i][1]
    for i in range(1, len(blocks)):  # low and high of the parent are whole by now; this child's part comes off
        e, p = kinds[i], parents[i]
        p0, p1 = low[p] - up[i][0], high[p] - up[i][1]
        low[i] += log_sum(e[0][0] + p0, e[1][0] + p1)
        high[i] += log_sum(e[0][1] + p0, e[1][1] + p1)
    return [1 / (1 + math.exp(min(700.0, max(-700.0, x - y)))) for x, y in zip(low, high, strict=True)]


def log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def extract(html: str | None, model: Model) -> str:
    if not html:
        return ""
    _, blocks, runs = parse(html)
    content = {id(b): p >= 0.5 for b, p in zip(blocks, model.marginals(blocks), strict=True)}
    kept = (SPACE.sub(" ", "".join(run)).strip() for owner, run in runs if content[id(owner)])
    return "\n".join(x for x in kept if x)


def train(pages: list[str], rounds: int = 600, decay: float = 2e-6, speed: float = 0.1, rare: int = 5) -> Model:
    """Potentials that make the labels of the given pages likeliest.

    The gradient of the likelihood is what the labels show less what the messages expect: of each feature on content
    blocks, of each kind of child under content (``one``), and of each kind of content child under content (``both``).
    All trees pass their messages together, level by level.
    """
    rows, labels, parents, depths, kinds = [], [], [], [], []
    for page in pages:
        _, blocks, _ = parse(page)
        total, number = totals(blocks), {}
        for b in blocks:
            mark = re.search(r'data-content="([01])"', b.attributes)
            b.label = int(mark[1]) if mark else b.parent.label if b.parent is not None else 0
            number[id(b)] = len(rows)
            rows.append(["bias", *features(b, total[id(b)], total[id(blocks[0])][0])])
            labels.append(b.label)
            parents.append(-1 if b.parent is None else number[id(b.parent)])
            depths.append(0 if b.parent is None else depths[parents[-1]] + 1)
            kinds.append(edge_kind(b))
    seen = Counter(f for row in rows for f in row)
    index = {f: i for i, f in enumerate(f for f, n in seen.items() if n >= rare)}  # a rarer name says nothing
    rows = [[index[f] for f in row if f in index] for row in rows]
    kind_names, kind = np.unique(kinds, return_inverse=True)
    y, parent, depth = np.array(labels, float), np.array(parents), np.array(depths)
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max(initial=0) + 1)]
    sizes = [len(index), len(kind_names), len(kind_names)]
    theta, mean, square = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    inner = np.flatnonzero(parent >= 0)
    shown = np.concatenate([
        np.bincount(flat, y[of], sizes[0]),
        np.bincount(kind[inner], y[parent[inner]], sizes[1]),
        np.bincount(kind[inner], y[parent[inner]] * y[inner], sizes[1]),
    ])
    for step in range(1, rounds + 1):
        w, one, both = np.split(theta, np.cumsum(sizes)[:-1])
        one, both = one[kind], both[kind]
        low, high = np.zeros(len(rows)), np.bincount(of, w[flat], len(rows))
        up0, up1 = np.zeros(len(rows)), np.zeros(len(rows))
        for i in reversed(levels):
            up0[i] = np.logaddexp(low[i], high[i])
            up1[i] = np.logaddexp(one[i] + low[i], one[i] + both[i] + high[i])
            np.add.at(low, parent[i], up0[i])
            np.add.at(high, parent[i], up1[i])
        pair = np.zeros(len(rows))
        for i in levels:
            p0, p1 = low[parent[i]] - up0[i], high[parent[i]] - up1[i]
            four = np.stack([p0 + low[i], p0 + high[i], p1 + one[i] + low[i], p1 + one[i] + both[i] + high[i]])
            pair[i] = np.exp(four[3] - np.logaddexp.reduce(four))
            low[i] += np.logaddexp(p0, one[i] + p1)
            high[i] += np.logaddexp(p0, one[i] + both[i] + p1)
        p = 1 / (1 + np.exp(np.clip(low - high, -700, 700)))
        expected = [np.bincount(flat, p[of], sizes[0]), np.bincount(kind[inner], p[parent[inner]], sizes[1]), np.bincount(kind[inner], pair[inner], sizes[1])]
        slope = (shown - np.concatenate(expected)) / len(rows) - decay * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta = theta + speed * (1 - step / (rounds + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    w, one, both = np.split(theta, np.cumsum(sizes)[:-1])
    edges = {k: [[0.0, 0.0], [float(a), float(a + b)]] for k, a, b in zip(kind_names.tolist(), one, both, strict=True)}
    edges.setdefault("other", [[0.0, 0.0], [0.0, 0.0]])
    return Model({f: float(w[i]) for f, i in index.items()}, edges)


def labelled_pages(number: int = 1500, seed: int = 11) -> list[str]:
    """Training pages from templates: articles with menus, headers, footers, sidebars, notices, adverts, forms and comments.

    Some articles have no element of their own: their blocks stand in ``body`` or in unnamed ``div``s, which are then content."""
    r = random.Random(seed)
    syllables = "an be co de el fi ga ho in ja ke lo mi nu or pa que ri so tu".split()

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(lo, hi))).capitalize() + r.choice([".", ".", "!", "?", ""])

    def pick(*options):
        return r.choice(options)

    def links(lo: int, hi: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(r.randint(lo, hi)))

    def plain(tag: str, name: str, inner: str) -> str:
        named = pick(f' class="{name}"', f' id="{name}"', f' class="{name} block"', f' class="site-{name}"')
        return f'<{tag}{named} data-content="0">{inner}</{tag}>'

    def comment() -> str:
        return plain("div", "comment", f"<p>{words(1, 2)}</p><p>{words(5, 60)}</p>")

    def junk(kind: int | None = None) -> str:
        kind = r.randrange(12) if kind is None else kind
        if kind == 0:
            return f'<nav{pick("", " class=menu", " role=navigation")} data-content="0"><ul>{links(2, 9)}</ul></nav>'
        if kind == 1:
            return plain("div", pick("menu", "navbar", "breadcrumb", "breadcrumbs", "nav", "navigation", "pagination", "pager", "toolbar", "tabs"), f"<ul>{links(2, 9)}</ul>")
        if kind == 2:
            return f'<header{pick("", " class=header")} data-content="0">{pick("<h1>" + words(1, 4) + "</h1>", "<p>" + words(2, 8) + "</p>", "<div>" + words(1, 4) + "</div>")}<p>{words(2, 9)}</p></header>'
        if kind == 3:
            return f'<aside{pick("", " class=sidebar")} data-content="0">{pick("<h2>" + words(1, 3) + "</h2>", "")}{pick("<ul>" + links(2, 6) + "</ul>", "<p>" + words(5, 50) + "</p>")}</aside>'
        if kind == 4:
            return plain("div", pick("sidebar", "related", "widget", "recommended", "popular", "trending", "share", "social", "tags", "newsletter", "subscribe", "signup", "author", "byline", "meta", "promo"), pick(f"<ul>{links(2, 6)}</ul>", f"<p>{words(3, 40)}</p>", words(3, 40)))
        if kind == 5:
            return plain(pick("div", "section"), pick("cookie", "cookies", "consent", "notice", "banner", "gdpr", "alert", "popup", "modal", "paywall", "disclaimer", "privacy", "overlay"), pick(words(4, 50), f"<p>{words(4, 50)}</p>"))
        if kind == 6:
            return plain(pick("div", "section", "ins"), pick("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "adsbygoogle", "promoted"), pick(words(4, 40), f"<p>{words(4, 40)}</p>"))
        if kind == 7:
            return f'<form data-content="0"><p>{words(2, 12)}</p><label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button></form>'
        if kind == 8:
            return plain(pick("div", "section"), pick("comments", "responses", "discussion", "replies", "disqus", "feedback", "reviews"), f"<h3>{words(1, 3)}</h3>" + "".join(comment() for _ in range(r.randint(1, 5))))
        if kind == 9:
            return f'<section class="comments" data-content="0"><ol>{"".join("<li>" + words(4, 50) + "</li>" for _ in range(r.randint(1, 4)))}</ol></section>'
        if kind == 10:
            return plain("div", pick("footer", "copyright", "legal", "bottom"), pick(words(3, 30), f"<p>{words(3, 30)}</p><ul>{links(1, 4)}</ul>"))
        return plain("div", pick("header", "masthead", "topbar", "logo", "search", "login", "top"), pick(words(1, 8), f"<p>{words(1, 8)}</p>", f"<h1>{words(1, 4)}</h1>", f"<h1>{words(1, 4)}</h1><p>{words(1, 8)}</p>"))

    def odd() -> str:
        """An attribute that says nothing: none, or a name never seen elsewhere."""
        made = "".join(r.choices("bcdfgklmnpqrstvwxz", k=r.randint(3, 9)))
        return pick("", "", f' class="{made}"', f' id="{made}"', f' class="{made}-{r.randint(1, 99)} {made[::-1]}"', f' data-x="{made}"')

    terse = False  # a page of few words

    def paragraph() -> str:
        kind = r.randrange(12)
        if terse:
            return f"<p{odd()}>{words(1, 8)}</p>"
        if kind == 0:
            return f"<p{odd()}><a href='/x'>{words(1, 12)}</a></p>"
        if kind == 1:
            return f"<p>{words(3, 20)} <a href='/x'>{words(1, 4)}</a> {words(3, 30)}</p>"
        if kind == 2:
            return f"<p><b>{words(3, 60)}<br><p>{words(1, 40)}</p>"
        if kind == 3:
            return f"<p{odd()}>{words(100, 400)}</p>"
        if kind == 4 or r.random() < 0.05:
            return f'<p class="{pick("author", "author", "lead", "intro", "author", "summary", "caption", "first", "dropcap", "note")}">{words(1, 30)}</p>'
        return f"<p{odd()}>{words(1, 5) if r.random() < 0.3 else words(4, 90)}</p>"

    def items(tag: str) -> str:
        lo, hi = pick((1, 3), (2, 20), (15, 60))
        inner = lambda: pick(words(lo, hi), words(lo, hi), f"<p>{words(lo, hi)}</p>", f'<a href="/x">{words(1, 4)}</a> {words(lo, hi)}')
        nested = f"<ul><li>{words(1, 9)}</li></ul>" if r.random() < 0.1 else ""
        return f"<{tag}{odd()}>" + "".join(f"<li>{inner()}{nested}</li>" for _ in range(r.randint(1, 6))) + f"</{tag}>"

    def rows() -> str:
        line = lambda tag, n: "<tr>" + "".join(f"<{tag}>{words(1, r.choice([2, 5, 15]))}</{tag}>" for _ in range(n)) + "</tr>"
        n = r.randint(1, 4)
        head, body = line("th", n) if r.random() < 0.6 else "", "".join(line("td", n) for _ in range(r.randint(1, 4)))
        if r.random() < 0.4:
            head, body = f"<thead>{head}</thead>" if head else "", f"<tbody>{body}</tbody>"
            body += f"<tfoot>{line('td', n)}</tfoot>" if r.random() < 0.2 else ""
        if r.random() < 0.2:
            body = "".join(f"<tr><th>{words(1, 3)}</th><td>{words(1, 8)}</td></tr>" for _ in range(r.randint(1, 4)))
        return f"<table{odd()}>{f'<caption>{words(1, 9)}</caption>' if r.random() < 0.3 else ''}{head}{body}</table>"

    def block(depth: int = 0) -> str:
        """Any block that may stand in an article."""
        kind = r.randrange(24 if depth < 3 else 18)
        if kind < 6:
            return paragraph()
        if kind == 6:
            n = r.randint(2, 6)
            return f"<h{n}{odd()}>{words(1, 8)}</h{n}>"
        if kind in (7, 8):
            return items(pick("ul", "ol"))
        if kind == 9:
            return f"<dl{odd()}>" + "".join(f"<dt>{words(1, 4)}</dt><dd>{pick(words(1, 30), f'<p>{words(2, 30)}</p>')}</dd>" for _ in range(r.randint(1, 4))) + "</dl>"
        if kind == 10:
            return f"<blockquote{odd()}>{pick(words(3, 40), f'<p>{words(5, 40)}</p>')}</blockquote>"
        if kind in (11, 12):
            return rows()
        if kind == 13:
            return f"<pre{odd()}>{pick('', '<code>')}{words(2, 20)}</pre>"
        if kind == 14:
            return f'<figure{odd()}><img src="x.png">{f"<figcaption>{words(2, 20)}</figcaption>" if r.random() < 0.8 else ""}</figure>'
        if kind == 15:
            return f"<details{odd()}><summary>{words(1, 8)}</summary>{pick(words(3, 30), paragraph())}</details>"
        if kind == 16:
            return pick(f"<address{odd()}>{words(2, 20)}</address>", f"<header{odd()}>{pick('', f'<h2>{words(1, 8)}</h2>')}<p>{words(2, 40)}</p></header>")
        if kind == 17:
            tag = pick("div", "div", "center", "x-text")
            return f"<{tag}{odd()}>{words(1, 50)}</{tag}>"
        tag = pick("div", "div", "section")
        head = f"<h{r.randint(2, 5)}>{words(1, 8)}</h2>" if r.random() < 0.5 else ""
        return f"<{tag}{odd()}>{head}{''.join(block(depth + 1) for _ in range(r.choice([1, 1, 2, 3])))}</{tag}>"

    content_names = (
        "content article post entry story main body text page-content wysiwyg rte richtext prose markdown article-body post-content story-text "
        "beitrag artikel inhalt contenido articulo cuerpo noticia contenu corps texte contenuto articolo testo conteudo treść innehåll".split()
    )
    out = []
    for _ in range(number):
        terse = r.random() < 0.08
        length = r.choice([1, 2, 3, 4] if terse else [0, 1, 1, 2, 3, 4, 8, 16])
        sectioned = r.random() < 0.15
        parts = [f"<section{odd()}>{''.join(block(1) for _ in range(r.randint(1, 3)))}</section>" if sectioned else paragraph() if terse and r.random() < 0.6 else block() for _ in range(length)]
        body = "".join(x + (junk(pick(4, 4, 4, 0, 1, 3, 5, 6, 7, 8, 9, 10)) if r.random() < 0.2 else "") for x in parts)
        title = f"<h1{odd()}>{words(1, 10)}</h1>" if r.random() < 0.8 else ""
        if r.random() < 0.2 and title:
            title = f'<header data-content="1">{title}{pick("", f"<p>{words(2, 40)}</p>", f"<div>{words(1, 20)}</div>")}</header>'
        name = pick(f' class="{r.choice(content_names)}"', f' id="{r.choice(content_names)}"', odd())
        tags = pick(("article",), ("article",), ("main", "article"), ("main",), ("div",), ("div",), ("div",), ("div",), ("div", "div"), ("section",), ("article", "div"), ("main", "div", "div"))
        named = "".join(f'<{t}{name if k == len(tags) - 1 and (t in ("div", "section") or r.random() < 0.3) else ""} data-content="1">' for k, t in enumerate(tags))
        article = named + title + body + "".join(f"</{t}>" for t in tags[::-1])
        depth = r.choice([0, 0, 0, 1, 2]) if r.random() < 0.3 else None
        if depth is not None:
            article = '<div data-content="1">' * depth + title + body + "</div>" * depth
        before = "".join(junk() for _ in range(r.randint(0, 4)))
        after = "".join(junk() for _ in range(r.randint(0, 4)))
        foot = f'<footer data-content="0">{pick(words(2, 30), f"<p>{words(2, 30)}</p>", f"<ul>{links(2, 6)}</ul>", f"<address>{words(2, 12)}</address>", f"<div><p>{words(2, 20)}</p></div>")}</footer>' if r.random() < 0.8 else ""
        if depth != 0 and r.random() < 0.3:
            article = f'<div class="{pick("container", "wrapper", "page", "row", "layout")}" data-content="0">{article}{junk()}</div>'
        out.append(f"<html><head><title>x</title></head><body{' data-content="1"' if depth == 0 else ""}>{before}{article}{after}{foot}</body></html>")
    return out


def add_text(pages: DataFrame, model: Model | None = None, html: str = "html", to: str = "text") -> DataFrame:
    """``pages`` without the html, with its main text."""
    model = model or train(labelled_pages())
    rest = [f for f in pages.schema.fields if f.name not in (html, to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), model) for h in batch.column(batch.schema.get_field_index(html))]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*(f.name for f in rest), to])

    return pages.mapInArrow(run, T.StructType([*rest, T.StructField(to, T.StringType())]))
