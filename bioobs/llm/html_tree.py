"""Pages as trees of block elements with pieces of text as leaves.

Inline elements do not cut text. Broken markup is read as browsers do in the
common cases: a block closes an open paragraph, items close items of their kind,
an end tag closes what it left open, unknown end tags are ignored.
"""

from __future__ import annotations

import html
import re

# fixed values: elements by their part in a page
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style title textarea xmp iframe noembed noframes template svg math".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_SAME = frozenset("li p td th tr dt dd option".split())
CONTENT_TAGS = frozenset("article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)


class Node:
    """An element, or a piece of text (``text`` is set) below one."""

    __slots__ = ("tag", "names", "parent", "text", "linked", "hidden", "within")

    def __init__(self, tag: str, names: str, parent: int, text: str | None = None, linked: float = 0.0):
        self.tag, self.names, self.parent = tag, names, parent
        self.text, self.linked = text, linked
        self.hidden = False
        self.within = False  # an article or main element


def parse_page(page: str | None) -> list[Node]:
    """Nodes in page order, each after its parent; the first is the page itself."""
    nodes = [Node("page", "", -1)]
    stack = [0]
    run: list[str] = []
    linked = 0  # characters of the run inside links
    anchors = 0
    in_head = False

    def flush() -> None:
        nonlocal linked
        if run:
            raw = "".join(run)
            text = " ".join(html.unescape(raw).split())
            if text:
                nodes.append(Node("text", "", stack[-1], text, min(1.0, linked / max(1, len(raw)))))
            run.clear()
        linked = 0

    page = page or ""
    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token["name"]
        if name is None:
            if token["text"] is not None and not in_head:
                run.append(token["text"])
                if anchors:
                    linked += len(token["text"])
            continue
        name = name.lower()
        if token["end"]:
            if name == "head":
                in_head = False
            elif name == "a":
                anchors = max(0, anchors - 1)
            elif name not in INLINE and name not in EMPTY:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == name:
                        del stack[depth:]
                        break
            continue
        if name in RAW:
            # nothing inside is markup or text
            close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = close.start() if close else size
            if not in_head and name == "textarea":
                flush()
            continue
        if name == "head":
            in_head = True
            continue
        if name == "body":
            in_head = False
        if in_head:
            if name in EMPTY or name in INLINE or name == "noscript":
                continue
            in_head = False  # a head that was never closed
        if name == "a":
            anchors += 1
            continue
        if name == "br":
            run.append("\n")
            continue
        if name in INLINE:
            continue
        flush()
        if name in EMPTY:
            continue
        anchors = 0
        if nodes[stack[-1]].tag == "p" or (name in CLOSES_SAME and nodes[stack[-1]].tag == name):
            stack.pop()
            if name in CLOSES_SAME and nodes[stack[-1]].tag == name and name != "p":
                stack.pop()
        rest = token["rest"]
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(rest)).lower() if rest else ""
        node = Node(name, names, stack[-1])
        above = nodes[stack[-1]]
        node.hidden = bool(rest and _HIDDEN.search(rest))
        node.within = above.within or above.tag in CONTENT_TAGS
        nodes.append(node)
        stack.append(len(nodes) - 1)
    flush()
    return nodes
