"""A small forgiving reader of HTML into block elements, and features of these nodes.

Inline elements make no node: their text belongs to the block element around them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

# Fixed values of the HTML standard: elements by how a parser treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title".split())
ASIDE = frozenset("noscript template object".split())
FOREIGN = frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section table ul".split()
)
# Start tags at which a parser leaves svg and math, and the elements inside these that may hold HTML.
BREAKOUT = (
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr"
    " ol p pre ruby s small span strong strike sub sup table tt u ul var"
)
INTEGRATION = "foreignObject desc title annotation-xml mi mo mn ms mtext"
# A start tag ends an open element of its own kind, unless the other kind lies between.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"<]*"|'[^'<]*')*+|[^>]*)(?:>|\Z))""",
    re.DOTALL,
)
_BREAKOUT = re.compile(rf"<(?:{BREAKOUT.replace(' ', '|')})(?=[\s/>])", re.IGNORECASE)
_INTEGRATION = re.compile(rf"<(?:{INTEGRATION.replace(' ', '|')})(?=[\s/>])", re.IGNORECASE)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in RAW}
_PAIRED = {name: re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in ASIDE | FOREIGN}
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Attribute words by what they usually mark, and elements by kind.
TOKENS = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs toc pagination pager tabs toolbar skip",
    "head": "header head masthead topbar top logo brand branding hero",
    "foot": "footer foot bottom copyright colophon legal",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular more teaser secondary",
    "advert": "ad ads adv advert advertisement adslot banner promo promotion sponsor sponsored commercial affiliate",
    "notice": "notice notices cookie cookies consent gdpr privacy alert popup modal overlay newsletter subscribe subscription paywall disclaimer warning message",
    "form": "form search login signup signin register contact input",
    "comment": "comment comments commentlist disqus reply replies respond responses discussion thread reviews",
    "share": "share sharing social follow tags meta byline author buttons actions print",
    "body": "article content main post entry story text body page blog news maincontent contentinfo",
}
KINDS = {
    "article": "article main",
    "division": "div section center body html",
    "paragraph": "p blockquote pre address",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "item": "li dt dd",
    "list": "ul ol dl menu",
    "cell": "table tbody thead tfoot tr td th caption",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside",
    "form": "form fieldset button select option input legend dialog",
    "figure": "figure figcaption picture video audio details summary",
}
_GROUP = {w: i for i, ws in enumerate(TOKENS.values()) for w in ws.split()}
_KIND = {t: i for i, ts in enumerate(KINDS.values()) for t in ts.split()}
_NG, _NK = len(TOKENS), len(KINDS)


@dataclass
class Page:
    """Block elements in page order (a parent before its children) and the blocks of text."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    groups: list[set[int]] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _groups(attributes: str) -> set[int]:
    out = set()
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        words = _PART.findall(value)
        for w in words:
            g = _GROUP.get(w.lower())
            if g is not None:
                out.add(g)
    return out


def _pairs(html: str, name: str) -> dict[int, int]:
    """Where the content of each closed element of a name starts, and where its end tag ends."""
    out, starts = {}, []
    for m in _PAIRED[name].finditer(html):
        if not m[1]:
            if not m[0].endswith("/>"):
                starts.append(m.end())
        elif starts:
            out[starts.pop()] = m.end()
    return out


def _after_foreign(html: str, at: int, end: int | None) -> int:
    """Where an svg or math element ends that starts at ``at`` and has its end tag before ``end``, if any."""
    inner = _INTEGRATION.search(html, at, end or len(html))
    out = _BREAKOUT.search(html, at, end or len(html))
    if out and (end is None or not inner or out.start() < inner.start()):
        return out.start()
    return end or len(html)


def read(html: str | None) -> Page:
    """Any text gives a page; what is broken is closed where a browser would, about.

    What an element of ``RAW`` holds is left out, to the end of the page if it is not closed. Of
    ``ASIDE``, closed elements are left out and others read as ordinary ones; of ``FOREIGN``, all up to
    their end or to a start tag that a parser leaves them at. None of these ends a block.
    """
    html = html or ""
    page = Page(["html"], [-1], [set()])
    stack = [0]
    parts: list[str] = []
    linked = link = 0
    pairs: dict[str, dict[int, int]] = {}

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.blocks.append((stack[-1], text, linked))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if link:
                linked += len(text)

    def close(names: tuple[str, ...], until: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            name = page.tag[stack[depth]]
            if name in names:
                end_block()
                del stack[depth:]
                return
            if name in until:
                return

    at = 0
    while m := _TAG.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                link = 0
            elif name not in INLINE and name not in ("html", "body"):
                close((name,), ())
            continue
        if name in RAW:
            if not m[3].endswith("/"):
                end = _ENDS[name].search(html, at)
                at = end.end() if end else len(html)
            continue
        if name in ASIDE or name in FOREIGN:
            if m[3].endswith("/"):
                continue
            if name not in pairs:
                pairs[name] = _pairs(html, name)
            end = pairs[name].get(at)
            if name in FOREIGN:
                at = _after_foreign(html, at, end)
                continue
            if end is not None:
                at = end
                continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            link = 1
        if name in INLINE or name in ("html", "head", "body"):
            continue
        if name in CLOSES_P:
            close(("p",), ("td", "th", "li", "div", "article", "section", "blockquote", "form", "table"))
        if name in SIBLINGS:
            close(*SIBLINGS[name])
        end_block()
        if name in VOID:
            continue
        link = 0
        page.tag.append(name)
        page.parent.append(stack[-1])
        page.groups.append(_groups(m[3]) if m[3] else set())
        stack.append(len(page.tag) - 1)
    add(html[at:])
    end_block()
    return page


FEATURES = 2 * _NG + 2 * _NK + 14


def features(page: Page) -> np.ndarray:
    """One row per node: its attribute words and kind and those of its ancestors, the density of
    text and links in its subtree, depth, place, and how it compares with its siblings."""
    n = len(page.tag)
    out = np.zeros((n, FEATURES))
    chars, links, stops, nodes = (np.zeros(n) for _ in range(4))
    nodes += 1
    before = np.full(n, -1.0)
    seen = 0
    for node, text, linked in page.blocks:
        chars[node] += len(text)
        links[node] += min(linked, len(text))
        stops[node] += text.count(".") + text.count(",")
        if before[node] < 0:
            before[node] = seen
        seen += len(text)
    own = chars.copy()
    children = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for a in (chars, links, stops, nodes):
            a[p] += a[i]
        children[p] += 1
        if before[i] >= 0 and (before[p] < 0 or before[i] < before[p]):
            before[p] = before[i]
    total = max(seen, 1)
    depth = np.zeros(n)
    mates: dict[tuple[int, str], list[int]] = {}
    for i, (tag, parent, groups) in enumerate(zip(page.tag, page.parent, page.groups)):
        row = out[i]
        for g in groups:
            row[g] = 1
        kind = _KIND.get(tag, -1)
        if kind >= 0:
            row[2 * _NG + kind] = 1
        if parent >= 0:
            depth[i] = depth[parent] + 1
            up = out[parent]
            row[_NG : 2 * _NG] = np.maximum(up[:_NG], up[_NG : 2 * _NG])
            row[2 * _NG + _NK : 2 * _NG + 2 * _NK] = np.maximum(up[2 * _NG : 2 * _NG + _NK], up[2 * _NG + _NK : 2 * _NG + 2 * _NK])
        mates.setdefault((parent, tag), []).append(i)
    rest = out[:, 2 * (_NG + _NK) :]
    alike, mean = np.ones(n), np.zeros(n)
    for same in mates.values():
        alike[same] = len(same)
        mean[same] = chars[same].mean()
    parent = np.array(page.parent)
    rest[:, 0] = np.log1p(own)
    rest[:, 1] = np.log1p(chars)
    rest[:, 2] = chars / nodes
    rest[:, 3] = links / np.maximum(chars, 1)
    rest[:, 4] = stops / np.maximum(chars, 1)
    rest[:, 5] = chars / total
    rest[:, 6] = depth
    rest[:, 7] = before / total
    rest[:, 8] = children
    rest[:, 9] = alike
    rest[:, 10] = chars / np.maximum(mean, 1)
    rest[1:, 11] = chars[1:] / np.maximum(chars[parent[1:]], 1)
    rest[1:, 12] = (links / np.maximum(chars, 1))[parent[1:]]
    rest[:, 13] = np.log1p(nodes)
    return out


def decode(page: Page, chance: np.ndarray, cost: float = 0.5) -> str:
    """The text of the best consistent choice of nodes.

    Every subtree is taken whole, left out whole, or divided among its children at a cost; the sum
    of the nodes' log chances decides, so no node is in while its ancestor is out or the reverse
    without the ancestor being divided.
    """
    n = len(page.tag)
    chance = np.clip(chance, 0.005, 0.995)
    yes, no = np.log(chance), np.log(1 - chance)
    texts = np.zeros(n, bool)
    texts[[b[0] for b in page.blocks]] = True
    all_in, all_out = yes.copy(), no.copy()
    split = np.where(texts, np.maximum(yes, no), 0.0)
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best[i] = max(all_in[i], all_out[i], split[i] - cost)
        p = page.parent[i]
        if p >= 0:
            all_in[p] += all_in[i]
            all_out[p] += all_out[i]
            split[p] += best[i]
    state = np.zeros(n, int)  # 1 in, -1 out, 0 divided
    for i in range(n):
        p = page.parent[i]
        if p >= 0 and state[p]:
            state[i] = state[p]
        elif best[i] == all_out[i]:
            state[i] = -1
        elif best[i] == all_in[i]:
            state[i] = 1
    taken = (state == 1) | ((state == 0) & (yes > no))
    return "\n".join(text for node, text, _ in page.blocks if taken[node])
