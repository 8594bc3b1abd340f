"""A lenient HTML parser: any text gives a well-formed sequence of starts, texts and ends.

Element names are lower case. html, head and body are implied; void and self-closed elements end at once; the texts of script and style are raw, those of title and textarea hold no elements.
What recovery does: an anchor ends where another anchor or a block begins, and where an element around it ends; a paragraph ends where a block begins; list items, definitions, options and
parts of tables end where their next sibling begins; a title goes to the head wherever it stands; an end tag that nothing is open for is left out; elements without an end last to the end
of the page; a quote without an end closes at the next blank or `>`; `<` before anything but a name is text; a comment without an end lasts to the end of the page."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.entities import html5

Event = tuple[str, str, dict[str, str] | None]

# Elements without content, and those that begin a block.
VOID = frozenset("area base basefont br col embed frame hr img input isindex link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is text, and if its entities count.
RAW = {"script": False, "style": False, "title": True, "textarea": True}
#: Elements that belong to the head as well as to the body.
HEAD = frozenset("base link meta script style title".split())
#: What ends before an element begins, up to the nearest of the elements named after it.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "tr": (("td", "th", "tr"), ("table",)), **dict.fromkeys(("tbody", "thead", "tfoot"), (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",))),
}
_NAME = re.compile(r"[A-Za-z][^\s/>\x00]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|[\"']?([^\s>]*)))?")
_BLANK = re.compile(r"[\s/]*")
_ENTITY = re.compile(r"&(?:#[xX]([0-9a-fA-F]{1,8})|#([0-9]{1,9})|([A-Za-z][A-Za-z0-9]*));?")


def _char(m: re.Match[str]) -> str:
    if m[3]:
        return html5.get(f"{m[3]};", m[0])
    number = int(m[1], 16) if m[1] else int(m[2])
    return chr(number) if 0 < number < 0x110000 and not 0xD800 <= number < 0xE000 else "�"


def unescape(text: str) -> str:
    """Entities by name, with or without a semicolon, and by number; unknown ones stay."""
    return _ENTITY.sub(_char, text) if "&" in text else text


def _tag(html: str, at: int) -> tuple[str, dict[str, str], bool, int] | None:
    """The tag whose name begins at `at`: name, attributes (the first of a name counts), if it is self-closed, where it ends. None if it has no end."""
    name = _NAME.match(html, at)
    at, attributes = name.end(), {}
    while True:
        begin, at = at, _BLANK.match(html, at).end()
        if at >= len(html):
            return None
        if html[at] == ">":
            return name[0].lower(), attributes, "/" in html[begin:at], at + 1
        m = _ATTRIBUTE.match(html, at)
        if m is None:  # a stray equals sign
            at += 1
            continue
        attributes.setdefault(m[1].lower(), unescape(next((v for v in m.groups()[1:] if v is not None), "")))
        at = m.end()


def tokens(html: str) -> Iterator[Event]:
    """Tags and texts as they stand: ("start", name, attributes), ("empty", name, attributes), ("end", name, None), ("text", text, None)."""
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", unescape(html[at:]), None
            return
        after = html[lt + 1 : lt + 2]
        if after.isascii() and after.isalpha():
            if lt > at:
                yield "text", unescape(html[at:lt]), None
            found = _tag(html, lt + 1)
            if found is None:
                return
            name, attributes, closed, at = found
            yield "empty" if closed or name in VOID else "start", name, attributes
            if name in RAW and not closed:
                end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                stop = end.start() if end else html.find("<", at) if RAW[name] else n
                stop = n if stop < 0 else stop
                if stop > at:
                    yield "text", unescape(html[at:stop]) if RAW[name] else html[at:stop], None
                at = stop
                if not end:
                    yield "end", name, None
        elif after in ("/", "!", "?"):
            if lt > at:
                yield "text", unescape(html[at:lt]), None
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            end = html.find(">", lt)
            name = _NAME.match(html, lt + 2) if after == "/" else None
            at = n if end < 0 else end + 1
            if name and end >= 0:
                yield "end", name[0].lower(), None
        else:
            yield "text", unescape(html[at : lt + 1]), None
            at = lt + 1


class _Tree:
    """The open elements."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.open: Counter[str] = Counter()

    def push(self, name: str) -> None:
        self.names.append(name)
        self.open[name] += 1

    def close(self, name: str) -> Iterator[Event]:
        """Ends the innermost element of this name and all in it."""
        while True:
            last = self.names.pop()
            self.open[last] -= 1
            yield "end", last, None
            if last == name:
                return

    def siblings(self, names: tuple[str, ...], within: tuple[str, ...]) -> str | None:
        """The outermost of `names` that is open inside the innermost of `within`."""
        if not any(self.open[x] for x in names):
            return None
        found = None
        for x in reversed(self.names):
            if x in within:
                break
            if x in names:
                found = x
        return found


def parse(html: str) -> Iterator[Event]:
    """Starts, texts and ends, each start with its end. Elements that aren't in the page but implied have no attributes (None)."""
    tree = _Tree()
    for kind, name, attributes in tokens(html):
        if kind == "text":
            if not tree.open["body"] and not name.isspace() and tree.names[-1:] not in (["title"], ["script"], ["style"]):
                yield from _body(tree)
            yield kind, name, None
        elif kind == "end":
            if name == "br":
                yield "start", "br", {}
                yield "end", "br", None
            elif tree.open[name] and name not in ("html", "body"):
                yield from tree.close(name)
        else:
            yield from _begin(tree, name, attributes or {}, kind == "empty")
    if tree.names:
        yield from tree.close(tree.names[0])


def _body(tree: _Tree) -> Iterator[Event]:
    for name in ("html", "body"):
        if tree.open["head"]:
            yield from tree.close("head")
        if not tree.open[name]:
            tree.push(name)
            yield "start", name, None


def _begin(tree: _Tree, name: str, attributes: dict[str, str], empty: bool) -> Iterator[Event]:
    if name in ("html", "head", "body") and (tree.open[name] or tree.open["body"]):
        return
    if tree.open["a"] and (name == "a" or name in BLOCK):
        yield from tree.close("a")
    if tree.open["p"] and name in BLOCK:
        yield from tree.close("p")
    if name in SIBLINGS:
        while before := tree.siblings(*SIBLINGS[name]):
            yield from tree.close(before)
    if name == "title" and not tree.open["head"]:
        while tree.names and tree.names[-1] != "html":
            yield from tree.close(tree.names[-1])
    if name != "html" and not tree.open["html"]:
        tree.push("html")
        yield "start", "html", None
    if name == "title" and not tree.open["head"]:
        tree.push("head")
        yield "start", "head", None
    elif name not in HEAD and name not in ("html", "head", "body"):
        yield from _body(tree)
    elif name == "body" and tree.open["head"]:
        yield from tree.close("head")
    yield "start", name, attributes
    if empty:
        yield "end", name, None
    else:
        tree.push(name)
