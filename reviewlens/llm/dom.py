"""A forgiving HTML reader: from markup to a tree of blocks and the text that stands in each."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Fixed values of the HTML standard: elements without an end, with text that is not the page's, and on lines of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style template noscript iframe object svg math canvas head title select textarea xmp".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul").split())
#: A start of the first ends an open one of the second, unless one of the third lies between.
_LISTS, _TABLE = frozenset({"ul", "ol", "menu", "dir"}), frozenset({"table"})
IMPLIED = {
    "li": (frozenset({"li"}), _LISTS), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})), "tr": (frozenset({"tr", "td", "th"}), _TABLE),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot"}), _TABLE), "tfoot": (frozenset({"thead", "tbody"}), _TABLE),
}
_P = frozenset({"p"})
_P_SCOPE = frozenset({"td", "th", "caption", "table", "button"})
_NOT_IN_P = BLOCKS - {"html", "body", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def names_of(attributes: str) -> frozenset[str]:
    """The words of the class, id, role and similar attributes, in lower case."""
    if "=" not in attributes:
        return frozenset()
    found = _ATTRIBUTE.findall(attributes)
    return frozenset(w for _, a, b, c in found for w in _NAME.findall(_CAMEL.sub(" ", unescape(a or b or c)).lower()))


@dataclass
class Tree:
    """Nodes in page order; `parts` are (node, text) in page order, with (-1, "") where a block begins or ends."""

    tag: list[str] = field(default_factory=list)
    names: list[frozenset[str]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)  # inline elements of the node's own
    linked: list[int] = field(default_factory=list)  # letters of the node's own that stand in links
    parts: list[tuple[int, str]] = field(default_factory=list)


def parse(html: str | None, is_node=lambda names: bool(names)) -> Tree:
    """Read a page. Nodes are block elements, and inline ones whose attribute words `is_node` accepts; the text of
    other inline elements is the text of the node around them. A null page is a tree of its root alone."""
    html = (html or "").replace("\0", "")
    tree = Tree(["#root"], [frozenset()], [-1], [0], [0])
    stack: list[tuple[str, int]] = [("#root", 0)]
    links, at = 0, 0
    parts = tree.parts

    def close(tags: frozenset[str], stops: frozenset[str]) -> bool:
        """End the nearest open element of these, and all within, unless one of the stops comes first."""
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                links -= sum(t == "a" for t, _ in stack[i:])
                if any(t in BLOCKS for t, _ in stack[i:]):
                    parts.append((-1, ""))
                del stack[i:]
                return True
            if stack[i][0] in stops:
                break
        return False

    def read(text: str) -> None:
        if text:
            node = stack[-1][1]
            text = unescape(text) if "&" in text else text
            parts.append((node, text))
            if links:
                tree.linked[node] += len(text)

    while True:
        found = _TAG.search(html, at)
        if not found:
            read(html[at:])
            return tree
        read(html[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            # An inline end does not reach over a block; a block's own end does.
            if not close(frozenset({tag}), frozenset() if tag in BLOCKS else BLOCKS) and tag == "p":
                parts.append((-1, ""))  # the end of a paragraph that is not open is an empty one
            continue
        attributes = found[3]
        if tag in UNREAD:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                if tag == "head":
                    end = re.compile(r"</head\b[^>]*>|(?=<body\b)", re.I).search(html, at)
                at = end.end() if end else at if tag in ("head", "title", "svg", "math") else len(html)
            continue
        if tag in _NOT_IN_P:
            close(_P, _P_SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in ("html", "body"):
            continue
        names = names_of(attributes)
        block = tag in BLOCKS
        node = stack[-1][1]
        if block or is_node(names):
            tree.tag.append(tag)
            tree.names.append(names)
            tree.parent.append(node)
            tree.inside.append(0)
            tree.linked.append(0)
            node = len(tree.tag) - 1
            if block:
                parts.append((-1, ""))
        else:
            tree.inside[node] += 1
        if tag == "br":
            parts.append((node, " "))
        if tag in VOID or attributes.endswith("/") and not block:
            continue
        links += tag == "a"
        stack.append((tag, node))


def text_of(parts: list[tuple[int, str]], kept) -> str:
    """The text of the kept nodes: white space within a block as one space, blocks joined by line ends."""
    blocks, now = [], []
    for node, text in [*parts, (-1, "")]:
        if node >= 0:
            if kept[node]:
                now.append(text)
        elif now:
            if words := "".join(now).split():
                blocks.append(" ".join(words))
            now = []
    return "\n".join(blocks)
