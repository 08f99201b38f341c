"""A tolerant HTML reader: one pass over the tags, into flat arrays of nodes, text pieces and blocks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Fixed values of the HTML standard: elements by how the reader treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title textarea xmp iframe noembed noframes noscript template svg math object audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag closes these if they are open above it, within the scope.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("html body table td th ul ol dl div article section main nav aside header footer form".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]|$))""", re.I | re.S)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """Nodes are in document order, parents before children; node 0 is the document."""

    tag: list[str] = field(default_factory=lambda: ["#document"])
    parent: list[int] = field(default_factory=lambda: [-1])
    tokens: list[list[str]] = field(default_factory=lambda: [[]])
    #: Characters of text directly in the node, and how many of them are inside links.
    chars: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [0])
    stops: list[int] = field(default_factory=lambda: [0])
    inner: list[int] = field(default_factory=lambda: [0])
    #: Void controls and copyright signs directly in the node.
    controls: list[int] = field(default_factory=lambda: [0])
    signs: list[int] = field(default_factory=lambda: [0])
    #: Blocks of (node, text as it stands) pieces.
    blocks: list[list[tuple[int, str]]] = field(default_factory=list)


def attribute_tokens(attributes: str) -> list[str]:
    """Lower-case letter runs of the naming attributes."""
    out = []
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() == "hidden":
            out.append("hidden")
        out += [t.lower() for t in _TOKEN.findall(value)]
    return out


def read(html: str) -> Page:
    """Parse a page. Never fails: unknown, unclosed and crossed tags are handled as browsers do, in outline."""
    page = Page()
    stack: list[tuple[str, int]] = [("#document", 0)]
    block: list[tuple[int, str]] = []
    links, unseen, at = 0, 0, 0

    def flush() -> None:
        nonlocal block
        if block:
            page.blocks.append(block)
            block = []

    def text(piece: str) -> None:
        if piece and not unseen:
            node = stack[-1][1]
            block.append((node, piece))
            n = len(piece.strip())
            if n:
                page.chars[node] += n
                page.link[node] += n if links else 0
                if "&copy;" in piece or "\xa9" in piece:
                    page.signs[node] += 1
                page.stops[node] += piece.count(". ") + piece.count(", ") + piece.endswith((".", "!", "?"))

    def pop(depth: int) -> None:
        nonlocal links, unseen
        while len(stack) > depth:
            name, _ = stack.pop()
            links -= name == "a"
            unseen -= name in UNSEEN
            if name not in INLINE:
                flush()

    def close(names: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                return pop(depth)
            if stack[depth][0] in SCOPE:
                return None
        return None

    while at < len(html):
        m = _TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name == "p" and not any(n == "p" for n, _ in stack):
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    pop(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        name = (m[2] or m[4] or "").lower()
        if not name:
            continue
        if name in CLOSES_P:
            close(("p",))
        if name in CLOSES:
            close(CLOSES[name])
        if name == "a" and links:
            close(("a",))
        if name not in INLINE:
            flush()
        if name in VOID:
            page.inner[stack[-1][1]] += 1
            page.controls[stack[-1][1]] += name == "input"
            continue
        attributes = m[3] or m[5] or ""
        if attributes.endswith("/") and name not in INLINE and name in ("svg", "math"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        tokens = attribute_tokens(attributes) if attributes.strip() else []
        if name in INLINE and not tokens:
            node = stack[-1][1]
            page.inner[node] += 1
        else:
            node = len(page.tag)
            page.tag.append(name)
            page.parent.append(stack[-1][1])
            page.tokens.append(tokens)
            for column in (page.chars, page.link, page.stops, page.inner, page.controls, page.signs):
                column.append(0)
        links += name == "a"
        unseen += name in UNSEEN
        stack.append((name, node))
    flush()
    return page
