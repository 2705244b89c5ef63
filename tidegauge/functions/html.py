"""Small HTML tree, enough to find containers, headings and text blocks.

Spark partitions the pages; this helper only reads one page at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from weakref import ref

VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
# a start tag of the key ends an open element of the value, when no element of
# SCOPE lies between
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "center", "dd", "div", "dl", "dt", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre",
    "section", "table", "td", "th", "tr", "ul",
}
SCOPE = {"article", "body", "div", "li", "main", "ol", "section", "table", "td", "th", "ul", "blockquote"}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
LIST_SCOPE = {"ul", "ol", "dl", "table", "select", "body"}
RAW = {"script", "style", "template"}


class Element:
    """A tree lives as long as its root is held: no element holds its parent, so nothing waits for a cycle collector."""

    __slots__ = ("tag", "attrs", "children", "_parent", "__weakref__")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Element | None"):
        self.tag, self.attrs = tag, attrs
        self._parent = None if parent is None else ref(parent)
        self.children: list[Element | str] = []

    @property
    def parent(self) -> "Element | None":
        return None if self._parent is None else self._parent()

    def walk(self) -> Iterator["Element"]:
        """Descendants in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Element))

    def find(self, test: Callable[["Element"], bool]) -> "Element | None":
        return next((e for e in self.walk() if test(e)), None)

    def text(self, without: frozenset[str] = frozenset()) -> str:
        parts: list[str] = []
        stack = self.children[::-1]
        while stack:
            child = stack.pop()
            if isinstance(child, str):
                parts.append(child)
            elif child.tag not in RAW and child.tag not in without:
                stack.extend(reversed(child.children))
        return "".join(parts)

    def inside(self, tags: frozenset[str]) -> bool:
        node = self.parent
        while node is not None:
            if node.tag in tags:
                return True
            node = node.parent
        return False


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.top = Element("#document", {}, None)

    def _close(self, ends: set[str], scope: set[str]) -> None:
        """Close the nearest open element of ``ends``, not looking past ``scope``."""
        node = self.top
        while node is not self.root:
            if node.tag in ends:
                self.top = node.parent
                return
            if node.tag in scope:
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, SCOPE)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], LIST_SCOPE)
        node = Element(tag, {k: v or "" for k, v in attrs}, self.top)
        self.top.children.append(node)
        if tag not in VOID:
            self.top = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.top
        while node is not self.root:
            if node.tag == tag:
                self.top = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.top.children.append(data)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def clean_text(text: str) -> str:
    """Trimmed lines and double-space phrases, joined by single spaces."""
    phrases = (p.strip() for line in text.splitlines() for p in line.strip().split("  "))
    return " ".join(p for p in phrases if p)


def tagged(*tags: str) -> Callable[[Element], bool]:
    return lambda e: e.tag in tags


def with_attribute(tag: str, name: str, pattern: str, flags: int = 0) -> Callable[[Element], bool]:
    found = re.compile(pattern, flags)

    def test(e: Element) -> bool:
        # class is a list of names; any one may match
        values = e.attrs.get(name, "").split() if name == "class" else [e.attrs.get(name, "")]
        return e.tag == tag and any(found.search(v) for v in values)

    return test
