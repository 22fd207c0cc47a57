"""HTML pages as trees of block elements, with features for every element."""

from __future__ import annotations

import html as _html
import re
import zlib
from typing import List, Optional, Tuple

import numpy as np

#: The inside of a tag after its name.  A quote opens a value only behind ``=`` and only if it is closed somewhere;
#: any other value runs to white space or ``>``, whatever quotes it holds.  Nothing is read twice.
INSIDE_TAG = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^>=])*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({INSIDE_TAG})(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[^\S ]\s*| \s+")

#: Elements whose content is never text of the page (annotations repeat a formula in another notation).
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "select", "head", "annotation",
       "annotation-xml"}
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that run inside a line; their text belongs to the block around them.
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "object", "canvas", "svg", "g", "defs", "use", "symbol", "desc", "text", "tspan", "textpath", "path", "rect", "circle",
          "ellipse", "line", "polyline", "polygon", "lineargradient", "radialgradient", "stop", "clippath", "mask", "pattern",
          "marker", "filter", "foreignobject", "image", "switch", "metadata",
          "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "mstyle", "merror",
          "mpadded", "mphantom", "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover",
          "mmultiscripts", "mprescripts", "none", "mtable", "mtr", "mtd", "mlabeledtr", "maction"}
#: Inline elements whose text stands apart from what is beside it.
_APART = {"object", "canvas", "svg", "text", "desc", "mtext", "mtr", "mtd", "math"}
_ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
           "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav",
           "ol", "p", "pre", "section", "table", "ul"}
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}


#: Tag of the elements made for text directly in the body.
BARE = "#text"


class Node:
    __slots__ = ("tag", "attrs", "parent", "index", "runs", "depth", "order")

    def __init__(self, tag: str, attrs: str, parent: Optional["Node"], index: int, order: int):
        #: ``index``: number in the page's list of elements.
        self.tag, self.attrs, self.parent, self.index = tag, attrs, parent, index
        #: Stretches of text that stand in this block itself: (place, text, characters inside links).
        self.runs: List[Tuple[int, str, int]] = []
        self.depth = 0 if parent is None else parent.depth + 1
        self.order = order


def parse(page: str) -> List[Node]:
    """Block elements of a page in page order; the first is its root.  Unclosed
    and stray tags are repaired as browsers do in the common cases; text is
    kept whole, character references decoded, white space of a stretch turned
    into single spaces.  A stretch that stands directly in the body becomes an
    element of its own, with the tag :data:`BARE`."""
    root = Node("html", "", None, 0, 0)
    nodes, here, links, order = [root], root, 0, 0
    pieces: List[str] = []
    in_link = 0

    def flush():
        nonlocal pieces, in_link, order
        if pieces:
            text = "".join(pieces)
            if "&" in text:
                text = _html.unescape(text)
            text = _SPACE.sub(" ", text).strip()
            if text:
                order += 1
                block = here
                if here is root:
                    block = Node(BARE, "", root, len(nodes), order)
                    nodes.append(block)
                block.runs.append((order, text, min(in_link, len(text))))
            pieces, in_link = [], 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            pieces.append(text)
            if links:
                in_link += len(text)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m[1] else 1
            elif tag in _APART:
                pieces.append(" ")
            continue
        if tag in RAW and tag != "head":
            if not m[1] and not m[3].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "textarea", "title"):
                    at = size
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr":
                flush()
            continue
        flush()
        links = 0
        if m[1]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in _ENDS_P or tag in _CLOSES:
            stop, bound = ({"p"}, _ENDS_P - {"p"}) if tag in _ENDS_P else _CLOSES[tag]
            node, last = here, None
            while node is not root and node.tag not in bound:
                if node.tag in stop:
                    last = node
                node = node.parent
            if last is not None:
                here = last.parent
        if m[3].endswith("/") and tag not in _ENDS_P:
            continue
        order += 1
        here = Node(tag, m[3], here, len(nodes), order)
        nodes.append(here)
    flush()
    return nodes


TAGS = ["article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "ul", "ol", "li", "nav", "header", "footer", "aside",
        "form", "table", "blockquote", "pre", "figure", "head", "dialog", "dl"]
_PLACE = {t: k for k, t in enumerate(TAGS)}
_FURNITURE = [_PLACE[t] for t in ("nav", "header", "footer", "aside", "form", "dialog")]
_MAIN = [_PLACE[t] for t in ("article", "main")]
#: Words of attributes are hashed to this many odds.
ATTR_BUCKETS = 4096


def attr_tokens(attrs: str) -> List[str]:
    """Words of the class, id, role and aria-label of an element, lower-case."""
    if not attrs or attrs.isspace():
        return []
    out = []
    for name, a, b, c in _ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role", "aria-label", "itemprop"):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c)
            out += _WORD.findall(spaced.lower())
    return out


def token_buckets(node: Node) -> List[int]:
    return [zlib.crc32(w.encode()) % ATTR_BUCKETS for w in attr_tokens(node.attrs)]


def features(pages: List[List[Node]], odds: np.ndarray) -> np.ndarray:
    """A row of numbers for each element of some pages, back to back: its tag,
    the learned odds of its and its ancestors' attribute words (hashed;
    ``odds`` by bucket), depth, text, link and element density of its subtree,
    and how it compares with its siblings, parent and page."""
    nodes = [x for page in pages for x in page]
    n = len(nodes)
    if not n:
        return np.zeros((0, len(TAGS) + 23), np.float32)
    sizes = np.array([len(page) for page in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.array([-1 if x.parent is None else x.parent.index for x in nodes])
    up = np.where(parent < 0, np.arange(n), parent + base)
    depth = np.array([x.depth for x in nodes])
    tag = np.array([_PLACE.get(x.tag, len(TAGS)) for x in nodes])
    own, linked, stops, blocks = (np.zeros(n) for _ in range(4))
    worst, best = np.zeros(n), np.zeros(n)
    for i, x in enumerate(nodes):
        if x.runs:
            own[i] = sum([len(t) for _, t, _ in x.runs])
            linked[i] = sum([k for _, _, k in x.runs])
            stops[i] = sum([t.count(".") + t.count(",") + t.count(";") for _, t, _ in x.runs])
            blocks[i] = len(x.runs)
        if x.attrs:
            words = token_buckets(x)
            if words:
                o = odds[words]
                worst[i], best[i] = o.min(), o.max()
    levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max()) + 1)]
    chars, elements = own.copy(), np.ones(n)
    for own_level in reversed(levels):     # sums over subtrees, a depth at a time
        for v in (chars, linked, stops, blocks, elements):
            np.add.at(v, up[own_level], v[own_level])
    furniture, body = np.isin(tag, _FURNITURE).astype(float), np.isin(tag, _MAIN).astype(float)
    above = np.stack([furniture, body, worst, best])       # telling tags, worst and best words here or above
    for own_level in levels:
        p = up[own_level]
        above[[0, 1, 3], own_level[:, None]] = np.maximum(above[[0, 1, 3], own_level[:, None]], above[[0, 1, 3], p[:, None]])
        above[2, own_level] = np.minimum(above[2, own_level], above[2, p])
    child = parent >= 0
    kids = np.bincount(up[child], minlength=n)
    kind = up * (len(TAGS) + 1) + tag
    _, which, alike = np.unique(np.where(child, kind, -1), return_inverse=True, return_counts=True)
    siblings = np.maximum(kids[up], 1)
    by = np.argsort(np.where(child, up, -1), kind="stable")
    firsts = np.searchsorted(np.where(child, up, -1)[by], np.where(child, up, -1))
    rank = np.empty(n)
    rank[by] = np.arange(n)
    whole = np.maximum(chars[base], 1)
    some = np.maximum(chars, 1)
    out = np.zeros((n, len(TAGS) + 23), np.float32)
    out[np.arange(n), tag] = 1
    out[:, len(TAGS) + 1:] = np.stack([
        depth, np.log1p(chars), np.log1p(own), chars / whole, linked / some, chars / elements, np.log1p(elements),
        np.log1p(blocks), chars / np.maximum(blocks, 1), stops / some * 100, siblings,
        np.where(child, alike[which] / siblings, 0), np.where(child, (rank - firsts) / siblings, 0),
        chars / np.maximum(chars[up], 1), above[0], above[1], (np.arange(n) - base) / np.repeat(sizes, sizes),
        linked[up] / np.maximum(chars[up], 1), worst, best, above[2], above[3]], 1)
    return out
