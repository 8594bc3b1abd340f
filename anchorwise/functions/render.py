"""A renderer from wiki markup to HTML, as a parser with stacks: of lists, tables and cells for lines, of links and emphasis inside them.

It covers nested lists and definitions, nested tables with captions, heads and cells of several lines, headings, rules, preformatted lines, links (with further links in the captions of media), emphasis,
references, comments, inline HTML (which stays), nowiki, pre and the like, and galleries. Templates stay as they are, for the step that expands them, but for links and emphasis in them; they are set aside
while lines and cells are cut. Article links become root-relative anchors. Every part of a page is looked at a bounded number of times."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .templates import Templates

#: What is set aside or left out: comments, references, elements whose text isn't markup, and the ends of templates.
_ASIDE = re.compile(r"<!--.*?(?:-->|\Z)|<(ref|nowiki|pre|math|source|syntaxhighlight|score|timeline|gallery)(\b[^<>]*?)(/?)>|<references\b[^<>]*/?>|__[A-Z]+__|\{\{|\}\}", re.DOTALL | re.IGNORECASE)
_INLINE = re.compile(r"\[\[|\]\]|\[(?=https?://)|\]|\|")
_QUOTES = re.compile(r"'{2,}")
_HEADING = re.compile(r"(={1,6})\s*(.*?)\s*\1\s*$")
_ITEM = re.compile(r"([*#:;]+)\s*(.*)$", re.DOTALL)
#: A place where something was set aside: characters that pages don't hold.
_MARK = re.compile("\ue000(\\d+)\ue001")
#: Targets in these name spaces are shown, not linked: their text is the last part.
_MEDIA = re.compile(r"^\s*:?(?:file|image|media)\s*:", re.IGNORECASE)
_CATEGORY = re.compile(r"^\s*category\s*:", re.IGNORECASE)
#: Links within links, which captions may hold; what is deeper is text.
DEEPEST = 20
_LIST = {"*": ("ul", "li"), "#": ("ol", "li"), ":": ("dl", "dd"), ";": ("dl", "dt")}


def _link(parts: list[str]) -> str:
    target = parts[0].strip()
    if _CATEGORY.match(target):
        return ""
    if _MEDIA.match(target):
        return parts[-1] if len(parts) > 1 else ""
    name, _, anchor = target.lstrip(":").partition("#")
    href = "/" + quote(name.strip().replace(" ", "_"), safe="/:()',.!*-_~") + (f"#{quote(anchor.replace(' ', '_'))}" if anchor else "")
    return f'<a href="{html.escape(href)}">{"|".join(parts[1:]) or target}</a>'


def _outside(text: str) -> str:
    url, *label = text.split(None, 1)
    return f'<a href="{html.escape(url)}">{label[0] if label else url}</a>'


def _emphasis(text: str) -> str:
    """Two quotes for italics, three for bold, five for both; what is open at the end is closed there."""
    if "''" not in text:
        return text
    out, open_, at = [], [], 0
    for m in _QUOTES.finditer(text):
        out.append(text[at : m.start()])
        at, n = m.end(), len(m[0])
        extra = n - 5 if n > 5 else n == 4
        out.append("'" * extra)
        tags = {2: ["i"], 3: ["b"], 5: ["b", "i"]}[n - extra]
        tags.sort(key=lambda t: -open_.index(t) if t in open_ else 2)  # the innermost ends first
        for tag in tags:
            if tag not in open_:
                open_.append(tag)
                out.append(f"<{tag}>")
                continue
            inner = open_[open_.index(tag) + 1 :]
            out += [f"</{x}>" for x in reversed([tag, *inner])] + [f"<{x}>" for x in inner]
            open_.remove(tag)
    return "".join([*out, text[at:], *(f"</{x}>" for x in reversed(open_))])


def _inline(text: str) -> str:
    """Links and emphasis of a piece of text. A link without an end is text."""
    if "[" not in text:
        return _emphasis(text)
    frames: list[tuple[str, list[str]]] = [("", [""])]  # what opened each, and its parts
    at = 0

    def add(x: str) -> None:
        frames[-1][1].append(x)

    def joined(parts: list[str]) -> list[str]:
        """Pieces to arguments: a bar alone stands between them."""
        out = [[]]
        for x in parts:
            if x == "|":
                out.append([])
            else:
                out[-1].append(x)
        return [_emphasis("".join(x)) for x in out]

    while m := _INLINE.search(text, at):
        add(text[at : m.start()])
        at, token = m.end(), m[0]
        if token == "]]" and frames[-1][0] == "[" and text.startswith("]", at):  # of three, the first ends the link to outside
            at, token = m.start() + 1, "]"
        if token in ("[[", "[") and len(frames) < DEEPEST:
            frames.append((token, [""]))
        elif token == "]]" and any(f[0] == "[[" for f in frames[-2:]):
            if frames[-1][0] == "[":  # a link to outside that has no end
                _, parts = frames.pop()
                frames[-1][1].extend(["[", *parts])
            _, parts = frames.pop()
            add(_link(joined(parts)))
        elif token in ("]", "]]") and frames[-1][0] == "[":
            _, parts = frames.pop()
            add(_outside(_emphasis("".join(parts))) + token[1:])
        else:
            add(token)
    add(text[at:])
    return _emphasis("".join(x for token, parts in frames for x in (token, *parts)))


def _aside(text: str) -> tuple[str, list[tuple[str, str]]]:
    """The text with marks, and what they stand for: templates (raw), and other elements (as HTML)."""
    out: list[str] = []
    kept: list[tuple[str, str]] = []
    opens: list[int] = []  # places in out where a template begins
    at, n = 0, len(text)
    ends: dict[str, int] = {}  # per element, from where on it has no end

    def keep(kind: str, what: str) -> None:
        out.append(f"\ue000{len(kept)}\ue001")
        kept.append((kind, what))

    while at < n:
        m = _ASIDE.search(text, at)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.end()
        if m[0] == "{{":
            opens.append(len(out))
            out.append("{{")
        elif m[0] == "}}":
            if opens:
                begin = opens.pop()
                whole = "".join(out[begin:]) + "}}"
                del out[begin:]
                if opens:
                    out.append(whole)
                else:
                    keep("template", whole)
            else:
                out.append("}}")
        elif m[1]:
            name = m[1].lower()
            if m[3]:
                continue
            end = None if ends.get(name, n + 1) <= at else re.compile(rf"</{name}\s*>", re.IGNORECASE).search(text, at)
            if end is None:  # no end: the tag alone goes
                ends[name] = at
                continue
            inner, at = text[at : end.start()], end.end()
            if name == "gallery":
                captions = (line.partition("|")[2] for line in inner.split("\n"))
                keep("html", "".join(f"<p>{_inline(c.strip())}</p>" for c in captions if c.strip()))
            elif name not in ("ref", "math", "score", "timeline"):
                plain = html.escape(html.unescape(inner), quote=False).replace("{", "&#123;")
                keep("html", plain if name == "nowiki" else f"<pre>{plain}</pre>")
    out.append(text[at:])
    return "".join(out), kept


class _Lines:
    """Takes lines, gives HTML: a stack of open tables, each with its own lists and paragraph."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.lists: list[str] = []  # the characters of the open list
        self.paragraph: list[str] = []
        self.cells: list[tuple[str | None, bool, list[str]]] = []  # of each open table: its open cell, if a row is open, the lists around it

    def close_paragraph(self) -> None:
        if self.paragraph:
            joined = " ".join(self.paragraph)
            # The first line of a cell is its own text; elsewhere text is a paragraph.
            self.out.append(joined if self.cells and self.cells[-1][0] and self.out[-1] == f"<{self.cells[-1][0]}>" else f"<p>{joined}</p>")
            self.paragraph.clear()

    def close_lists(self, depth: int = 0) -> None:
        while len(self.lists) > depth:
            kind, item = _LIST[self.lists.pop()]
            self.out.append(f"</{item}></{kind}>")

    def close(self) -> None:
        self.close_paragraph()
        self.close_lists()

    def item(self, marks: str, text: str) -> None:
        self.close_paragraph()
        same = 0
        while same < min(len(marks), len(self.lists)) and _LIST[marks[same]][0] == _LIST[self.lists[same]][0]:
            same += 1
        if same == len(marks):
            self.close_lists(same)
            self.out.append(f"</{_LIST[self.lists[-1]][1]}><{_LIST[marks[-1]][1]}>")
            self.lists[-1] = marks[-1]
        else:
            self.close_lists(same)
            for mark in marks[same:]:
                self.out.append(f"<{_LIST[mark][0]}><{_LIST[mark][1]}>")
                self.lists.append(mark)
        if marks[-1] == ";" and ":" in re.sub(r"https?:|\[\[[^\[\]]*\]\]", "", text):
            term, _, definition = text.partition(" :") if " :" in text else text.partition(":")
            self.out.append(f"{_inline(term.strip())}</dt><dd>{_inline(definition.strip())}")
            self.lists[-1] = ":"
        else:
            self.out.append(_inline(text))

    def open_table(self) -> None:
        self.close_paragraph()
        self.cells.append((None, False, self.lists))
        self.lists = []
        self.out.append("<table>")

    def close_cell(self) -> None:
        self.close()
        cell, row, lists = self.cells[-1]
        if cell:
            self.out.append(f"</{cell}>")
        self.cells[-1] = (None, row, lists)

    def close_row(self) -> None:
        self.close_cell()
        if self.cells[-1][1]:
            self.out.append("</tr>")
        self.cells[-1] = (None, False, self.cells[-1][2])

    def close_table(self) -> None:
        self.close_row()
        self.out.append("</table>")
        self.lists = self.cells.pop()[2]

    def cell(self, kind: str, text: str) -> None:
        self.close_cell()
        _, row, lists = self.cells[-1]
        if kind != "caption" and not row:
            self.out.append("<tr>")
            row = True
        head, bar, body = text.partition("|")
        self.out.append(f"<{kind}>")
        self.cells[-1] = (kind, row, lists)
        content = (body if bar and "[[" not in head else text).strip()
        if content:
            self.line(content) if content[:1] in "*#:;" else self.paragraph.append(_inline(content))

    def line(self, line: str) -> None:
        bare = line.strip()
        if bare.lstrip(":").startswith("{|"):
            self.open_table()
        elif self.cells and bare.startswith("|}"):
            self.close_table()
        elif self.cells and bare.startswith("|-"):
            self.close_row()
        elif self.cells and bare.startswith("|+"):
            self.cell("caption", bare[2:])
        elif self.cells and bare[:1] in ("|", "!"):
            head = bare[0] == "!"
            for text in re.split(r"\|\||!!" if head else r"\|\|", bare[1:]):
                self.cell("th" if head else "td", text)
        elif m := _HEADING.match(line):
            self.close()
            self.out.append(f"<h{len(m[1])}>{_inline(m[2])}</h{len(m[1])}>")
        elif line.startswith("----"):
            self.close()
            self.out.append("<hr>")
        elif m := _ITEM.match(line):
            self.item(m[1], m[2])
        elif not bare:
            self.close()
        elif line[0] == " " and not self.cells and not self.paragraph:
            self.close()
            self.out.append(f"<pre>{_inline(bare)}</pre>")
        else:
            self.close_lists()
            self.paragraph.append(_inline(line))

    def html(self) -> str:
        self.close()
        while self.cells:
            self.close_table()
        return "\n".join(self.out)


def render(text: str | None) -> str:
    """HTML of a page body. Null is empty."""
    marked, kept = _aside((text or "").replace("\ue000", "").replace("\ue001", ""))
    lines = _Lines()
    for line in marked.split("\n"):
        lines.line(line)
    back = lambda m: (lambda kind, what: _inline(what.replace("\n", " ")) if kind == "template" else what)(*kept[int(m[1])])
    return _MARK.sub(back, re.sub(r"\n(?=</(?:li|dd|dt|td|th|caption|ul|ol|dl)>)|(?<=<li>)\n|(?<=<d[dt]>)\n|(?<=<t[dh]>)\n|(?<=<caption>)\n", "", lines.html()))


def page(title: str, body: str) -> str:
    return f"<html><head><title>{title}</title></head><body>{body}</body></html>"


def rendered(text: Column, rules: list[tuple[str, str]] | None = None, *, expand: bool = False) -> Column:
    """The HTML of page bodies, with `expand` also with their templates expanded: one pass through Python for both. Null for a page that fails, so that it can be counted."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        templates = Templates(rules) if expand else None

        def one(t: str | None) -> str | None:
            try:
                page = render(t)
                return templates.page(page) if templates and "{{" in page else page
            except Exception:  # noqa: BLE001  whatever a page does to the renderer, the others go on
                return None

        for texts in batches:
            yield texts.map(one, na_action=None)

    return run(text)
