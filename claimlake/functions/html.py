"""A small HTML tree with CSS selectors, on the standard library alone.

Selectors: type, ``#id``, ``.class``, ``[attr]``, ``[attr='v']``, ``[attr*='v']``,
descendants, children (``>``), lists, and at the end ``::text`` (an element's own
text nodes) or ``::attr(name)``.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What opening one of these closes when it is open, up to a block.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self):  # noqa: ANN201
        """The elements below, in document order."""
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def own_text(self) -> list[str]:
        return [c for c in self.children if isinstance(c, str)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        closes = _CLOSES.get(tag, {"p"} if tag in _ENDS_P else set())
        if closes and self.at.tag in closes and self.at.parent:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        # Neighbouring pieces of one text are one node.
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


def parse(markup: str | None) -> Node:
    """The tree of a page; broken markup gives what could be read."""
    builder = _Builder()
    builder.feed(markup or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"""(?P<tag>^[\w-]+|^\*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w:-]+)(?:(?P<op>[*^$~]?=)(?P<q>['"]?)(?P<val>.*?)(?P=q))?\]""")


@lru_cache(maxsize=512)
def _compile(selector: str) -> tuple:
    """``((steps, output), …)``; a step is (combinator, tests)."""
    out = []
    for part in re.split(r",(?![^\[]*\])", selector):
        part, _, output = part.strip().partition("::")
        steps, combinator = [], " "
        for token in re.findall(r"""(?:\[[^\]]*\]|[^\s>\[])+|>""", part):
            if token == ">":
                combinator = ">"
                continue
            tests = tuple((m.lastgroup if m.lastgroup in ("tag", "id", "cls") else "attr", m.group("tag") or m.group("id") or m.group("cls") or m.group("attr"), m.group("op"), m.group("val")) for m in _SIMPLE.finditer(token))
            steps.append((combinator, tests))
            combinator = " "
        out.append((tuple(steps), output))
    return tuple(out)


def _fits(node: Node, tests: tuple) -> bool:
    for kind, name, op, value in tests:
        if kind == "tag":
            if name != "*" and node.tag != name:
                return False
        elif kind == "id":
            if node.attrs.get("id") != name:
                return False
        elif kind == "cls":
            if name not in node.attrs.get("class", "").split():
                return False
        else:
            held = node.attrs.get(name)
            if held is None:
                return False
            if op == "=" and held != value or op == "*=" and value not in held or op == "^=" and not held.startswith(value) or op == "$=" and not held.endswith(value) or op == "~=" and value not in held.split():
                return False
    return True


def _matches(node: Node | None, steps: tuple) -> bool:
    if node is None or not _fits(node, steps[-1][1]):
        return False
    if len(steps) == 1:
        return True
    if steps[-1][0] == ">":
        return _matches(node.parent, steps[:-1])
    above = node.parent
    while above is not None:
        if _matches(above, steps[:-1]):
            return True
        above = above.parent
    return False


def nodes(root: Node, selector: str) -> list[Node]:
    """The elements that a selector without output finds, in document order."""
    options = [steps for steps, _ in _compile(selector)]
    return [n for n in root.walk() if any(_matches(n, s) for s in options)]


def select(root: Node, selector: str) -> list[str]:
    """The texts or attribute values that a selector with an output finds, in document order."""
    options = _compile(selector)
    found: list[str] = []
    for node in root.walk():
        for steps, output in options:
            if _matches(node, steps):
                if output == "text":
                    found += node.own_text()
                elif output.startswith("attr("):
                    value = node.attrs.get(output[5:-1])
                    found += [value] if value is not None else []
                break
    return found


def first(root: Node, *selectors: str) -> str | None:
    """Per selector its first match alone; the first that isn't blank, squeezed."""
    for selector in selectors:
        found = select(root, selector)
        text = " ".join(found[0].split()) if found else ""
        if text:
            return text
    return None
