"""Main-text extraction with gradient-boosted trees over DOM-node features.

Every element is a node with features of its tag, the tokens of its naming attributes (class, id, role and the like), its
subtree (text, tags, links, text per tag and per block, sentence marks, controls, copyright signs), its depth and ancestors,
its siblings (how many look like it, what share of their text it has) and its place relative to the node whose children have
most running text. Boosted regression trees on the logistic loss give each node the log-odds that it belongs to the article
or encloses a part of it.

Hierarchical decoding: a node is kept or dropped; a dropped node drops its whole subtree, so no kept node lies under a
dropped one. Among all such labellings the one of largest total log-odds is chosen by one bottom-up and one top-down pass.

The trees learn from pages that ``training_pages`` composes (no labelled pages exist): articles in many wrappings, tables
among them, with menus, headers, footers, sidebars, notices, adverts, forms and reader comments around and inside them. Only
a part of the pages name things in English, and some of those misleadingly; the others have hashed names, names of an unknown
language or none, so that names help but shape and place decide. Learning takes some seconds on the driver, does not depend on
the data, and gives a model of fixed size. Extraction is one scan without a shuffle.

The text of kept nodes: character references decoded, white space inside a block made one space, blocks trimmed and joined
in page order by one space, and nothing else changed. Elements that are not shown (head, script, style and the like) have
no text.

Defined results: null and empty pages give an empty text; text outside any element is kept; where keeping and dropping a node
are worth the same it is kept; broken markup never fails; pages of any length are read whole; repeated rows get equal
results; a null id or url is kept as it is; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridweave.llm.dom import Page, read
from gridweave.llm.textblock import blocks, in_batches

#: Attribute tokens that speak for and against the article.
GOOD = frozenset("article articles body content entry main post story text prose column page hentry blogpost markdown".split())
BAD = frozenset(
    "ad ads advert advertisement adsense banner sponsor sponsored promo promotion promoted outbrain taboola nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead topbar footer sidebar aside rail widget related recommended recommendations share sharing social "
    "follow comment comments commenter disqus reply replies respond discussion notice cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup form login search paywall toolbar tags pagination pager copyright legal hidden skip contentinfo "
    "complementary".split()
)
CONTENT_TAGS = frozenset(("article", "main"))
CONTROLS = frozenset("button textarea select option".split())
FRAME_TAGS = frozenset("nav aside footer header form menu dialog button select fieldset noscript template svg iframe object".split())
GROUPS = [
    CONTENT_TAGS,
    frozenset(("nav", "menu")),
    frozenset(("header", "footer", "aside")),
    frozenset("form button select fieldset input label option dialog".split()),
    frozenset(("p", "pre", "blockquote")),
    frozenset("h1 h2 h3 h4 h5 h6".split()),
    frozenset(("ul", "ol", "dl")),
    frozenset(("li", "dt", "dd")),
    frozenset("table thead tbody tfoot tr td th".split()),
    frozenset(("div", "section", "center")),
    frozenset(("html", "body", "#document")),
]
TREES = 100
DEPTH = 4
BINS = 32
RATE = 0.2
#: Share of the nodes that each tree learns from, and of the features it may ask for.
BAG, ASKED = 0.4, 0.5
TRAIN_PAGES = 2_000
MARK = "furniture"


def features(page: Page) -> np.ndarray:
    """(nodes, features) of a page."""
    n = len(page.tag)
    parent = np.array(page.parent)
    controls = np.array([t in CONTROLS for t in page.tag], np.float64) + page.controls
    running = np.array(page.chars, np.float64) - page.link
    blocks = (running > 0).astype(np.float64)
    own = np.array([page.chars, page.link, page.stops, page.inner, [1] * n, [t == "p" for t in page.tag], controls, page.signs, blocks, [t == "a" for t in page.tag]], np.float64)
    total = own.copy()
    longest = running.copy()
    for i in range(n - 1, 0, -1):
        total[:, parent[i]] += total[:, i]
        longest[parent[i]] = max(longest[parent[i]], longest[i])
    good = np.array([sum(t in GOOD for t in tokens) for tokens in page.tokens], np.float64)
    bad = np.array([sum(t in BAD for t in tokens) for tokens in page.tokens], np.float64)
    frame = np.array([t in FRAME_TAGS for t in page.tag], np.float64)
    article = np.array([t in CONTENT_TAGS for t in page.tag], np.float64)
    above = np.zeros((5, n))
    for i in range(1, n):
        p = parent[i]
        above[:, i] = above[:, p] + (1, good[p], bad[p], frame[p], article[p])
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parent[i]].append(i)
    siblings = np.zeros((6, n))
    shape = [(page.tag[i], tuple(page.tag[c] for c in children[i][:3]), tuple(page.tokens[i])) for i in range(n)]
    for own_children in children:
        count = len(own_children)
        chars = sum(total[0, c] for c in own_children)
        same: dict[str, int] = {}
        alike: dict[tuple, int] = {}
        for c in own_children:
            same[page.tag[c]] = same.get(page.tag[c], 0) + 1
            alike[shape[c]] = alike.get(shape[c], 0) + 1
        for k, c in enumerate(own_children):
            twins = alike[shape[c]] if children[c] else 0
            siblings[:, c] = (count, k / count, same[page.tag[c]] / count, total[0, c] / chars if chars else 0, twins, count - 1 - k)
    place = _place(page, parent, children, running, total)
    words = np.maximum(total[0], 1)
    over = np.maximum(parent, 0)
    repeated = siblings[4].copy()
    for i in range(1, n):
        repeated[i] = max(repeated[i], repeated[parent[i]])
    order = np.concatenate([[0], np.cumsum(np.array(page.chars))[:-1]])
    rows = [
        *[np.array([t in g for t in page.tag], np.float64) for g in GROUPS],
        good,
        bad,
        frame,
        *above,
        np.log1p(total[0]),
        np.log1p(own[0]),
        total[1] / words,
        total[2] / words,
        total[0] / (total[4] + total[3]),
        total[5],
        np.log1p(total[4]),
        np.arange(n) / n,
        total[0] / max(total[0, 0], 1),
        order / max(total[0, 0], 1),
        total[6],
        total[7],
        np.log1p(longest),
        np.log1p((total[0] - total[1]) / np.maximum(total[8], 1)),
        total[9] / np.maximum(total[8], 1),
        *place,
        *siblings,
        (total[1] / words)[over],
        place[5][over],
        (total[2] / words)[over],
        repeated,
    ]
    return np.stack(rows, axis=1)


def _place(page: Page, parent: np.ndarray, children: list[list[int]], running: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Where nodes are relative to the main node, whose children (and itself) have most running text in blocks.

    Rows: it is the main node or inside, it encloses it, it comes after it; steps up to a node that encloses it, steps from
    there down to it; its running text as a share of the main node's.
    """
    n = len(page.tag)
    mass = running.copy()
    for i in range(1, n):
        if page.tag[i] not in FRAME_TAGS and page.tag[i] != "a":
            mass[parent[i]] += running[i] * (1 - total[1, i] / max(total[0, i], 1)) * (0.5 if page.tag[i] in ("li", "td", "th", "div", "span") else 1.0)
    main = int(mass.argmax())
    above = {}
    at, steps = main, 0
    while at >= 0:
        above[at] = steps
        at, steps = int(parent[at]), steps + 1
    out = np.zeros((6, n))
    up, down = np.zeros(n), np.zeros(n)
    inside = np.zeros(n, bool)
    inside[main] = True
    best = max(float((total[0] - total[1])[main]), 1.0)
    for i in range(n):
        p = parent[i]
        if i in above:
            up[i], down[i] = 0, above[i]
        else:
            up[i], down[i] = up[p] + 1, down[p]
            inside[i] = inside[p]
    out[0], out[1] = inside, np.array([i in above and i != main for i in range(n)])
    out[2] = (np.arange(n) > main) & ~inside
    out[3], out[4] = np.minimum(up, 9), np.minimum(down, 9)
    out[5] = np.minimum((total[0] - total[1]) / best, 3.0)
    return out


@dataclass
class BoostedTrees:
    """edges: bin borders per feature; feature, border: inner nodes of each tree, level by level; leaf: their values."""

    base: float
    edges: list[np.ndarray]
    feature: np.ndarray
    border: np.ndarray
    leaf: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        b = self.binned(x)
        out, every = np.full(len(x), self.base), np.arange(len(x))
        for feature, border, leaf in zip(self.feature, self.border, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[every, feature[at]] > border[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Histogram-based boosting of TREES trees of DEPTH levels, each on a share BAG of the rows and ASKED of the features; the same every time."""
    rng = np.random.default_rng(5)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    share = y.mean()
    model = BoostedTrees(float(np.log(share / (1 - share))), edges, *(np.zeros((TREES, 2**DEPTH - 1), np.int64) for _ in range(2)), np.zeros((TREES, 2**DEPTH)))
    b = model.binned(x).astype(np.int64)
    margin = np.full(len(x), model.base)
    for tree in range(TREES):
        own = np.flatnonzero(rng.random(len(x)) < BAG)
        asked = np.flatnonzero(rng.random(x.shape[1]) < ASKED)
        bins, p = b[own], 1 / (1 + np.exp(-margin[own]))
        g, h = p - y[own], p * (1 - p)
        at = np.zeros(len(own), np.int64)
        for level in range(DEPTH):
            first, wide = 2**level - 1, 2**level
            best = np.full(wide, 0.0)
            for j in asked:
                key = (at - first) * BINS + bins[:, j]
                sums = [np.bincount(key, w, wide * BINS).reshape(wide, BINS).cumsum(axis=1) for w in (g, h)]
                (gl, hl), (gt, ht) = (s[:, :-1] for s in sums), (s[:, -1:] for s in sums)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                pick = gain.argmax(axis=1)
                value = gain[np.arange(wide), pick]
                better = value > best + 1e-9
                best[better] = value[better]
                model.feature[tree, first : first + wide][better] = j
                model.border[tree, first : first + wide][better] = pick[better]
            useless = best <= 0
            model.border[tree, first : first + wide][useless] = BINS
            at = 2 * at + 1 + (bins[np.arange(len(own)), model.feature[tree, at]] > model.border[tree, at])
        leaf = at - (2**DEPTH - 1)
        gs, hs = np.bincount(leaf, g, 2**DEPTH), np.bincount(leaf, h, 2**DEPTH)
        model.leaf[tree] = -RATE * gs / (hs + 1)
        every, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (b[every, model.feature[tree, at]] > model.border[tree, at])
        margin += model.leaf[tree][at - (2**DEPTH - 1)]
    return model


def decode(parent: list[int], odds: list[float]) -> list[bool]:
    """Kept nodes of the best labelling in which a dropped node drops its subtree; node 0 is always kept."""
    n = len(parent)
    keep, drop = list(odds), [-o for o in odds]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = [True] * n
    for i in range(1, n):
        out[i] = out[parent[i]] and keep[i] >= drop[i]
    return out


def kept_text(page: Page, kept: list[bool]) -> str:
    parts = []
    for block in page.blocks:
        line = "".join([unescape(piece) if "&" in piece else piece for node, piece in block if kept[node]])
        if line := " ".join(line.split()):
            parts.append(line)
    return " ".join(parts)


def extract(pages: list[str], model: BoostedTrees) -> list[str]:
    """Main text of each page."""
    read_pages = [read(p) for p in pages]
    if not read_pages:
        return []
    odds = model.margins(np.concatenate([features(p) for p in read_pages])).tolist()
    out, at = [], 0
    for page in read_pages:
        n = len(page.tag)
        out.append(kept_text(page, decode(page.parent, odds[at : at + n])))
        at += n
    return out


def _words(rng: random.Random, low: int, high: int) -> str:
    syllables = ("ba", "lo", "ter", "in", "sho", "mi", "ra", "den", "ul", "ke", "po", "an")
    out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    return " ".join(w + rng.choice(("", "", "", "", ",", ".")) for w in out).capitalize()


def _links(rng: random.Random, low: int, high: int) -> str:
    items = [f'<a href="/{i}">{_words(rng, 1, 4)}</a>' for i in range(rng.randint(low, high))]
    if rng.random() < 0.7:
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    return rng.choice((" ", " | ", " / ")).join(items)


class Names:
    """Class and id names of one page: English (at times misleading), hashed, of an unknown language, or none."""

    def __init__(self, rng: random.Random, modes: tuple[str, ...]) -> None:
        self.rng, self.mode = rng, rng.choice(modes)
        self.known: dict[str, str] = {}

    def name(self, names: tuple[str, ...]) -> str:
        rng = self.rng
        if self.mode == "english":
            if rng.random() < 0.06:
                names = MISLEADING
            return rng.choice(("", "", "site-", "c-", "x ")) + rng.choice(names) + rng.choice(("", "", "-box", "_wrap", " col", "-1", " clearfix"))
        key = rng.choice(names)
        if key not in self.known:
            letters = "abcdefghijklmnopqrstuvwxyz"
            made = "".join(rng.choices(letters, k=rng.randint(5, 8))) if self.mode == "hashed" else "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
            self.known[key] = f"css-{made}{rng.randint(0, 99)}" if self.mode == "hashed" and rng.random() < 0.5 else made
        return self.known[key]

    def opened(self, tag: str, names: tuple[str, ...]) -> str:
        """An opening tag with a name, if the page names things."""
        if self.mode == "none" or not names:
            return f"<{tag}>"
        return f'<{tag} {self.rng.choice(("class", "class", "id"))}="{self.name(names)}">'


#: Kinds of page furniture: elements that mark it, names that mark it, and what it is made of.
FURNITURE = [
    (("nav", "menu"), ("nav", "menu", "navbar", "navigation", "breadcrumbs", "mainMenu"), "links"),
    (("header",), ("header", "masthead", "topbar", "siteHeader"), "head"),
    (("footer",), ("footer", "legal", "copyright", "pageFooter"), "foot"),
    (("aside",), ("sidebar", "rail", "widget", "related", "recommended", "right-col", "latest"), "list"),
    ((), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "adsense"), "short"),
    ((), ("notice", "cookie", "cookies-consent", "alert", "popup", "gdpr", "paywall"), "notice"),
    (("form",), ("newsletter", "subscribe", "login", "search", "signup"), "form"),
    ((), ("comments", "comment-list", "disqus", "discussion", "replies", "respond"), "comments"),
    ((), ("share", "social", "tags", "pagination", "follow"), "links"),
]
#: Kinds that may stand inside an article or in its wrappers, with names that tell them apart and without.
INSIDE, INSIDE_UNNAMED = (4, 4, 6, 8, 3), (6, 8, 3)
WRAPPED, WRAPPED_UNNAMED = (3, 4, 7, 8), (3, 7, 8)
#: Names that say the wrong thing: parts of articles named like furniture, and furniture named like articles.
MISLEADING = ("commentary", "more-detail", "reader", "header-story", "topic", "note", "panel", "content", "block", "main", "text")
ARTICLE = ("content", "article-body", "post", "entry-content", "story", "main", "postText")


def _comment(rng: random.Random, opened: str, tag: str) -> str:
    author = f"<{(mark := rng.choice(('b', 'strong', 'cite', 'h4', 'span')))}>{_words(rng, 1, 2)}</{mark}>"
    body = "".join(f"<p>{_words(rng, 3, 50)}</p>" for _ in range(rng.choice((1, 1, 1, 2)))) if rng.random() < 0.8 else f"<div>{_words(rng, 3, 50)}</div>"
    reply = f'<a href="#r">{_words(rng, 1, 1)}</a>' if rng.random() < 0.5 else ""
    return f"{opened}{author}{rng.choice(('', ' ', ': '))}{body}{reply}</{tag}>"


def _inner(rng: random.Random, names: Names, made: str, tag: str) -> str:
    """What a piece of furniture holds."""
    if tag == "ul":
        return "".join(f'<li><a href="/{i}">{_words(rng, 1, 4)}</a></li>' if made in ("links", "list") or rng.random() < 0.5 else f"<li>{_words(rng, 1, 5)}</li>" for i in range(rng.randint(2, 9)))
    if made == "links":
        return _links(rng, 2, 12)
    if made == "head":
        return f"<{(h := rng.choice(('h1', 'h2', 'a', 'div', 'p')))}>{_words(rng, 1, 4)}</{h}>" + (_links(rng, 2, 7) if rng.random() < 0.5 else "")
    if made == "foot":
        owner = f"{rng.choice(('&copy; ', '&copy; ', chr(169) + ' ', 'Copyright ', ''))}{rng.choice(('', '2024 ', '2019-2023 '))}{_words(rng, 1, 14)}"
        return f"{rng.choice(('', '<p>'))}{owner}" + (_links(rng, 1, 6) if rng.random() < 0.5 else "")
    if made == "list":
        heading = f"<{(h := rng.choice(('h2', 'h3', 'h4', 'b', 'div')))}>{_words(rng, 1, 3)}</{h}>" if rng.random() < 0.8 else ""
        return heading + (_links(rng, 2, 9) if rng.random() < 0.7 else "".join(f"<p>{_words(rng, 2, 14)}</p>" for _ in range(rng.randint(1, 4))))
    if made == "short":
        return _words(rng, 2, 25) if rng.random() < 0.6 else f"<p>{_words(rng, 2, 20)}</p>" + (f'<a href="/b">{_words(rng, 1, 3)}</a>' if rng.random() < 0.4 else "")
    if made == "notice":
        return f"{rng.choice(('', '<p>'))}{_words(rng, 3, 40)}" + (f"<button>{_words(rng, 1, 2)}</button>" if rng.random() < 0.6 else f'<a href="/c">{_words(rng, 1, 2)}</a>')
    if made == "form":
        return f"<label>{_words(rng, 1, 3)}</label><input name=q><button>{_words(rng, 1, 2)}</button>" + (f"<p>{_words(rng, 3, 20)}</p>" if rng.random() < 0.5 else "")
    item = rng.choice(("div", "div", "li", "article" if rng.random() < 0.1 else "section"))
    opened = names.opened(item, ("item", "comment", "reply")) if rng.random() < 0.6 else f"<{item}>"
    heading = f"<{(h := rng.choice(('h2', 'h3', 'h4', 'p')))}>{_words(rng, 1, 3)}</{h}>" if rng.random() < 0.6 else ""
    listed = "".join(_comment(rng, opened, item) for _ in range(rng.randint(2, 7)))
    return heading + (f"<ul>{listed}</ul>" if item == "li" else listed) + (f"<form><textarea></textarea><button>{_words(rng, 1, 2)}</button></form>" if rng.random() < 0.3 else "")


def _furniture(rng: random.Random, names: Names, kinds: tuple[int, ...]) -> str:
    tags, marks, made = FURNITURE[rng.choice(kinds)]
    by_tag = bool(tags) and rng.random() < (0.6 if names.mode == "english" else 0.75)
    tag = rng.choice(tags) if by_tag else rng.choice(("div", "div", "div", "section", "ul" if made in ("links", "list") else "div", "aside" if made != "comments" else "section"))
    opened = f"<{tag}>" if by_tag and rng.random() < 0.6 else names.opened(tag, marks)
    return f'{opened[:-1]} itemprop="{MARK}">{_inner(rng, names, made, tag)}</{tag}>'


def _body(rng: random.Random, names: Names) -> str:
    if rng.random() < 0.1:
        return f"<p>{_words(rng, 1, 6)}{rng.choice(('', '</p>'))}"
    least, most = rng.choice(((1, 120), (1, 120), (20, 90), (8, 30), (4, 15)))
    parts = [f"<h1>{_words(rng, 2, 10)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice((1, 2, 2, 3, 6, 12, 30)) if rng.random() < 0.95 else 0):
        roll = rng.random()
        if roll < 0.62:
            parts.append(f"<p>{rng.choice(('', '', '', '<b>', '<em>'))}{_words(rng, least, most)}{rng.choice(('', '<br>', '</p>', '</p>', '</p>'))}")
        elif roll < 0.68:
            parts.append(f"<h2>{_words(rng, 1, 8)}</h2>")
        elif roll < 0.74:
            parts.append("<ul>" + "".join(f"<li>{_words(rng, 1, 25)}</li>" for _ in range(rng.randint(1, 7))) + "</ul>")
        elif roll < 0.8:
            parts.append(f"<blockquote>{'<p>' * rng.randint(0, 1)}{_words(rng, 5, 40)}</blockquote>")
        elif roll < 0.83:
            parts.append("<table>" + "".join(f"<tr><td>{_words(rng, 1, 5)}</td><td>{_words(rng, 1, 5)}</td></tr>" for _ in range(rng.randint(1, 6))) + "</table>")
        elif roll < 0.86:
            parts.append(f'<div>{_words(rng, 2, 60)}</div><p>{_words(rng, 2, 30)} <a href="/r">{_words(rng, 1, 6)}</a> {_words(rng, 1, 20)}</p>')
        elif roll < 0.88:
            parts.append(f'<figure><img src="x.png"><figcaption>{_words(rng, 2, 12)}</figcaption></figure>')
        elif roll < 0.95:
            tag = rng.choice(("section", "div"))
            inner = "".join(f"<p>{_words(rng, 5, 80)}</p>" for _ in range(rng.randint(1, 4)))
            parts.append(f"{names.opened(tag, MISLEADING + ('section', 'part', 'detail', 'more-detail'))}{f'<h3>{_words(rng, 1, 6)}</h3>' if rng.random() < 0.4 else ''}{inner}</{tag}>")
        else:
            parts.append(_furniture(rng, names, INSIDE if names.mode == "english" else INSIDE_UNNAMED))
    return "".join(parts)


MODES = ("english", "english", "hashed", "foreign", "none")


def training_pages(count: int, seed: int, modes: tuple[str, ...] = MODES) -> list[str]:
    """Pages in which the item property MARK names what is not article."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        names = Names(rng, modes)
        table = rng.random() < 0.12
        tag = "td" if table else rng.choice(("article", "article", "main", "div", "div", "section"))
        marks = MISLEADING if rng.random() < 0.2 else ARTICLE
        opened = f"<{tag}>" if tag in ("article", "main") and rng.random() < 0.6 else names.opened(tag, marks)
        if tag in ("div", "section") and rng.random() < 0.3:
            opened = rng.choice((f"<{tag}>", f'<{tag} class="col-8">', f'<{tag} class="inner x1">'))
        body = _body(rng, names)
        inner = f"{opened}{body}</{tag}>"
        if table:
            side = f'<td itemprop="{MARK}">{_inner(rng, names, rng.choice(("links", "list")), "td")}</td>'
            cells = rng.choice((side + inner, inner + side, side + inner + side))
            top = f'<tr itemprop="{MARK}"><td colspan="3">{_inner(rng, names, "head", "td")}</td></tr>' if rng.random() < 0.5 else ""
            low = f'<tr itemprop="{MARK}"><td colspan="3">{_inner(rng, names, "foot", "td")}</td></tr>' if rng.random() < 0.5 else ""
            inner = f"<table>{top}<tr>{cells}</tr>{low}</table>"
        before = "".join(_furniture(rng, names, (0, 0, 1, 4, 5, 6, 8)) for _ in range(rng.choice((0, 1, 2, 2, 4))))
        after = "".join(_furniture(rng, names, (2, 2, 3, 4, 5, 6, 7, 7, 8)) for _ in range(rng.choice((0, 1, 1, 3))))
        for _ in range(rng.choice((0, 0, 1, 2, 4, 8, 25))):
            wrap = rng.choice(("<div>", "<div>", names.opened("div", ("wrapper", "container row", "root", "page")), "<section>"))
            inner = f"{wrap}{inner}" + (_furniture(rng, names, WRAPPED if names.mode == "english" else WRAPPED_UNNAMED) if rng.random() < 0.25 else "") + f"</{wrap[1:].split()[0].rstrip('>')}>"
        out.append(f"<!DOCTYPE html><html><head><title>{_words(rng, 1, 6)}</title><script>var a='</p>';</script></head><body>{before}{inner}{after}</body></html>")
    return out


def labelled(html: str) -> tuple[Page, np.ndarray]:
    """A training page without its marks, and which of its nodes are to be kept."""
    page = read(html)
    dropped = [False] * len(page.tag)
    for i, tokens in enumerate(page.tokens):
        dropped[i] = MARK in tokens or (i > 0 and dropped[page.parent[i]])
        page.tokens[i] = [t for t in tokens if t != MARK]
    return page, 1.0 - np.array(dropped, np.float64)


@lru_cache(maxsize=1)
def train() -> BoostedTrees:
    """The model; the same every time."""
    pairs = [labelled(p) for p in training_pages(TRAIN_PAGES, 11)]
    return fit(np.concatenate([features(p) for p, _ in pairs]), np.concatenate([y for _, y in pairs]))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(train())
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "html"):
                texts = extract(part.column("html").to_pylist(), shared.value)
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return in_batches(pages.select("page_id", "url", "html"), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op1_query(pages: DataFrame) -> DataFrame:
    return extract_pages(pages)
