"""Tolerant reading of HTML: blocks of text and the tree they hang in. Standard library only."""

from __future__ import annotations

import html
import re

# Tags that don't end a block, and tags that have no content.
INLINE = frozenset("a b i em strong span code sup br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr !doctype".split())
# Which open elements a start tag closes, up to the containers.
CLOSES = {
    "p": ({"p"}, {"div", "td", "th", "li", "body", "table", "ul", "ol", "main", "article", "section", "blockquote", "aside", "header", "footer", "nav", "dd", "form"}),
    "li": ({"li", "p"}, {"ul", "ol", "div", "td", "body", "main", "article", "section", "aside", "nav", "header", "footer", "menu"}),
    "tr": ({"tr", "td", "th", "p", "li"}, {"table"}), "td": ({"td", "th", "p", "li"}, {"tr", "table"}), "th": ({"td", "th", "p", "li"}, {"tr", "table"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
}
for _x in "div ul ol h1 h2 h3 h4 h5 h6 blockquote table section article aside header footer main nav form pre figure hr".split():
    CLOSES[_x] = ({"p"}, CLOSES["p"][1])
_SKIP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_TAG = re.compile(r"<(/?)([A-Za-z!][A-Za-z0-9:!-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z!][A-Za-z0-9:!-]*)([^>]*)>")


class Node:
    """Element: its tag, parent, children, and the counts of its whole subtree."""

    __slots__ = ("tag", "up", "kids", "chars", "link_chars", "tags", "link_tags", "attrs", "order")

    def __init__(self, tag: str, up: Node | None, attrs: str = ""):
        self.tag, self.up, self.attrs = tag, up, attrs
        self.kids: list[Node] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.order = 0


class Block:
    """Text between two tags that aren't inline; ``node`` holds its start, ``linked`` is the share inside links."""

    __slots__ = ("no", "text", "node", "chars", "link_chars")

    def __init__(self, no: int, text: str, node: Node, chars: int, link_chars: int):
        self.no, self.text, self.node, self.chars, self.link_chars = no, text, node, chars, link_chars


def block_texts(body: str) -> list[str]:
    """The texts of the blocks alone, without the tree."""
    out: list[str] = []
    parts: list[str] = []
    body = _SKIP.sub("", body)
    at = 0
    for m in _TAG.finditer(body):
        if m.start() > at:
            raw = body[at : m.start()]
            parts.append(html.unescape(raw) if "&" in raw else raw)
        at = m.end()
        name = (m[2] or m[5]).lower()
        if name in INLINE:
            if name == "br":
                parts.append("\n")
        elif parts:
            if joined := "".join(parts).strip():
                out.append(joined)
            parts = []
    parts.append(html.unescape(body[at:]))
    if joined := "".join(parts).strip():
        out.append(joined)
    return out


def parse(body: str) -> tuple[Node, list[Block]]:
    """The tree and the blocks in order; text outside any element hangs in the root."""
    body = _SKIP.sub("", body)
    root = node = Node("#root", None)
    nodes = [root]
    blocks: list[Block] = []
    parts: list[str] = []
    link, chars, link_chars, at = 0, 0, 0, 0
    for m in (*_TAG.finditer(body), None):
        end = m.start() if m else len(body)
        if end > at:
            raw = body[at:end]
            if "&" in raw:
                raw = html.unescape(raw)
            parts.append(raw)
            n = len(raw) - raw.count(" ") - raw.count("\n")
            chars += n
            if link:
                link_chars += n
        if m:
            at = m.end()
            slash, name, attrs = (m[1], m[2].lower(), m[3]) if m[2] else (m[4], m[5].lower(), m[6])
            if name in INLINE:
                if not slash:
                    node.tags += 1
                    if name == "br":
                        parts.append("\n")
                if name == "a":
                    link = 0 if slash else 1
                    node.link_tags += link
                continue
        if parts:
            if joined := "".join(parts).strip():
                blocks.append(Block(len(blocks), joined, node, chars, link_chars))
                node.chars += chars
                node.link_chars += link_chars
            parts, chars, link_chars = [], 0, 0
        if not m or name[0] == "!":
            continue
        if slash:
            up = node
            while up is not None and up.tag != name:
                up = up.up
            if up is not None and up.up is not None:
                node = up.up
            link = 0
            continue
        if name in CLOSES:
            shut, stops = CLOSES[name]
            up, to = node, None
            while up.up is not None and up.tag not in stops:
                if up.tag in shut:
                    to = up
                up = up.up
            if to is not None:
                node = to.up
        new = Node(name, node, attrs)
        new.order = len(nodes)
        new.tags = 1
        nodes.append(new)
        node.kids.append(new)
        if name not in VOID and not attrs.rstrip().endswith("/"):
            node = new
    for n in reversed(nodes[1:]):  # children come after their parents
        up = n.up
        up.chars += n.chars
        up.link_chars += n.link_chars
        up.tags += n.tags
        up.link_tags += n.link_tags
    return root, blocks


def path(node: Node) -> list[Node]:
    """The node and its ancestors, nearest first."""
    out = []
    while node is not None:
        out.append(node)
        node = node.up
    return out
