"""Terms near links: pages of HTML to (article, term, linked article, distance), without a shuffle.

A page is cut at its anchors into pieces: the text before an anchor, its href and its label. Its terms form one list: the words of each text, and each label and the title as a
single term. A link's position is the number of terms before it. Every term in [position - d, position + d) is paired with the link.

Pieces come from regular expressions, in the JVM, where a page is plain: where its anchors are closed and hold nothing but text and closed inline elements, tags and entities are whole, and scripts hold no
entities. Other pages (parse="auto") go through the lenient parser in an Arrow function, as do all with parse="lenient"; parse="native" takes every page for plain, with
no Python in the plan. Both give the same pieces for plain pages. A page that can't be parsed has null pieces, no terms and counts as an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html_parser
from ..functions import terms as T
from ..functions.element_path import ElementPath
from ..functions.render import page, render
from ..functions.templates import Templates

MAX_DISTANCE = 100
PIECES = "array<struct<text:string,href:string,label:string>>"
_INLINE = frozenset(T.INLINE)
# What a plain page doesn't hold: other entities, torn tags, elements that want a parser, scripts or titles that hold tags or (scripts) entities, self-closed anchors.
_KNOWN = "|".join(e[1:-1] for e, _ in T.ENTITIES)
_ODD = [
    rf"&(?!(?:{_KNOWN});)(?:#|[A-Za-z])",
    r"(?i)<(?!/?[A-Za-z][\w-]*+(?:\s(?:[^<>\x{22}']++|\x{22}[^<>\x{22}]*+\x{22}|'[^<>']*+')*+)?/?>|!doctype[^<>]*+>)",
    r"(?i)<(?:textarea|xmp|plaintext|listing|noembed|noframes|iframe|svg|math|frameset|a-)",
    r"(?i)<(script|style)\b[^>]*+>[^<&]*+(?!</\1\s*>)",
    r"(?i)<title\b[^>]*+>[^<]*+(?!</title\s*>)",
    r"(?is)<title\b.*<title\b",
    r"(?i)<a(?:\s[^>]*)?/>",
]
#: A label of text and closed inline elements.
_PLAIN_LABEL = rf"(?i)^[^<]*+(?:<({'|'.join(x for x in T.INLINE if x not in ('a', 'script'))})(?:\s[^<>]*+)?>[^<]*+</\1\s*>[^<]*+|<(?:br|img|wbr)(?:\s[^<>]*+)?>[^<]*+)*+$"


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with the value made once."""
    return F.transform(F.array(value), body)[0]


def _cleaned(html: Column) -> Column:
    """Without comments; in scripts and styles no `<` is left."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), T.COMMENT, ""), T.RAW_LESS, "$1$2 ")


def is_plain(html: Column) -> Column:
    """If regular expressions give the same pieces as a parser."""
    return _let(_cleaned(html), lambda page: _plain(html, page))


def _plain(html: Column, page: Column) -> Column:
    """Of a page and its cleaned form."""
    plain = ~F.coalesce(html, F.lit("")).rlike(r"(?i)<(?:script|style)\b[^>]*+>[^<]*+<!--|<!--(?!(?s:.*?)-->)|<!--[^>]*<(?:script|style)")
    plain = plain & ~F.regexp_replace(F.regexp_extract(page, r"(?is)^(.*?)<title\b", 1), r"</?(?!a\b)[A-Za-z!][^>]*>", "").rlike(r"\S")  # no text and no anchor before a title
    for pattern in _ODD:
        plain = plain & ~page.rlike(pattern)
    labels = F.regexp_extract_all(page, F.lit(T.ANCHOR), F.lit(2))
    return plain & _let(labels, lambda x: (F.size(x) == F.regexp_count(page, F.lit(r"(?i)<a\b"))) & F.forall(x, lambda label: ~label.contains("<") | label.rlike(_PLAIN_LABEL)))


def plain_pieces(html: Column, check: bool = False) -> Column:
    """The pieces of a plain page. With `check`, null for others."""
    title = lambda page: F.struct(F.lit("").alias("text"), F.lit(None).cast("string").alias("href"), T.phrase_text(F.regexp_extract(page, T.TITLE, 1)).alias("label"))
    piece = lambda x: F.struct(T.plain_text(x["0"]).alias("text"), T.href(x["1"]).alias("href"), T.phrase_text(x["2"]).alias("label"))
    # The three arrays are arguments of one function: inside its lambda they would be made anew for every piece.
    zipped = lambda body: F.arrays_zip(F.split(body, T.ANCHOR, -1), F.regexp_extract_all(body, F.lit(T.ANCHOR), F.lit(1)), F.regexp_extract_all(body, F.lit(T.ANCHOR), F.lit(2)))

    def of(page: Column) -> Column:
        pieces = F.concat(F.filter(F.array(title(page)), lambda t: page.rlike(T.TITLE)), _let(F.regexp_replace(page, T.TITLE, ""), lambda body: F.transform(zipped(body), piece)))
        return F.when(_plain(html, page), pieces) if check else pieces

    return F.when(html.isNotNull(), _let(_cleaned(html), of))


class Pieces:
    """What a page's elements give: takes the events of a parse in order."""

    def __init__(self) -> None:
        self.path, self.out, self.text, self.label = ElementPath(), [], [], []

    def _flush(self, href: str | None) -> None:
        self.out.append(["".join(self.text), href, None])
        self.text.clear()

    def start(self, name: str, attributes: dict[str, str] | None) -> None:
        self.path.push(name)
        if self.path.at("head/title"):
            self.text.clear()
        elif name == "a":
            self._flush((attributes or {}).get("href"))
            self.label.clear()
        elif name not in _INLINE and attributes is not None:  # implied elements break no words
            self.text.append(" ")

    def end(self) -> None:
        if self.path.at("head/title"):
            self.out.append(["", None, "".join(self.text)])
            self.text.clear()
        elif self.path.at("a"):
            self.out[-1][2] = "".join(self.label)
        self.path.pop()

    def characters(self, text: str) -> None:
        (self.label if self.path.within("a") else self.text).append(text)


def pieces_of(html: str) -> list[list[str | None]]:
    """[text, href, label] of each piece of a page: href and label are null where there is none."""
    pieces = Pieces()
    for kind, name, attributes in html_parser.parse(html):
        if kind == "start":
            pieces.start(name, attributes)
        elif kind == "end":
            pieces.end()
        else:
            pieces.characters(name)
    pieces._flush(None)
    return pieces.out


_PIECE = pa.list_(pa.struct([(c, pa.string()) for c in ("text", "href", "label")]))


def _attempt(make: Callable[[], list]) -> list[dict] | None:
    """The pieces that `make` gives; null if it fails, whatever the page does: the others go on."""
    try:
        return [dict(zip(("text", "href", "label"), p, strict=True)) for p in make()]
    except Exception:  # noqa: BLE001
        return None


def _parsed(html: pa.Array) -> pa.Array:
    return pa.array([None if x is None else _attempt(lambda x=x: pieces_of(x)) for x in html.to_pylist()], _PIECE)


def parsed_pieces(html: Column) -> Column:
    """pieces_of() of each page; null for null and for pages that can't be parsed."""
    return F.arrow_udf(_parsed, PIECES)(html)


def markup_pieces(title: Column, text: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The pieces of a page of markup: rendered, its templates expanded and parsed in one pass. Null for pages that fail."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        expander = Templates(rules)  # rules that are no patterns are at fault, not pages

        def one(name: str | None, markup: str | None) -> list:
            body = render(markup)
            return pieces_of(page(name or "", expander.page(body) if "{{" in body else body))

        for names, texts in batches:
            yield pa.array([_attempt(lambda x=x: one(*x)) for x in zip(names.to_pylist(), texts.to_pylist(), strict=True)], _PIECE)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, PIECES)(title, text)


def with_pieces(pages: DataFrame, *, html: str = "html", parse: str = "auto") -> DataFrame:
    """pages, with their pieces instead of their html: an array of (text, href, label), null where the page is null or can't be parsed."""
    if parse not in ("auto", "native", "lenient"):
        raise ValueError("parse must be auto, native or lenient")
    text = F.col(html)
    if parse == "lenient":
        return pages.withColumn("pieces", parsed_pieces(text)).drop(html)
    pages = pages.withColumn("pieces", plain_pieces(text, check=parse == "auto"))
    if parse == "auto":
        pages = pages.withColumn("pieces", F.coalesce("pieces", parsed_pieces(F.when(F.col("pieces").isNull(), text))))
    return pages.drop(html)


def piece_items(pieces: Column, tokenizer: str = "break", raw: bool = False) -> Column:
    """Terms and link marks of a page in order: an array of (term, ref), one of which is null. With `raw`, labels are terms as they stand, whatever they begin with."""
    null = F.lit(None).cast("string")
    term = lambda t: F.struct(t.alias("term"), null.alias("ref"))
    mark = lambda r: F.struct(null.alias("term"), r.alias("ref"))
    phrase = (lambda t: t) if raw else T.normalize_phrase

    def part(piece: Column) -> Column:
        words = F.transform(T.words(piece.text, tokenizer), term)
        marks = F.filter(F.array(mark(T.article_of(piece.href))), lambda x: x.ref.isNotNull())
        label = F.filter(F.array(term(phrase(piece.label))), lambda x: x.term.isNotNull() if raw else x.term.isNotNull() & T.accepted(x.term))
        return F.concat(words, marks, label)

    return F.coalesce(F.flatten(F.transform(pieces, part)), F.array().cast("array<struct<term:string,ref:string>>"))


def page_terms(pages: DataFrame, *, key: str = "article_name", html: str = "html", tokenizer: str = "break", drop_script: bool = False, raw: bool = False, parse: str = "auto") -> DataFrame:
    """key, terms (array), links (array of ref, pos). Of pages with their html, or with their pieces."""
    if "pieces" not in pages.columns:
        text = F.regexp_replace(html, T.SCRIPT, " ") if drop_script else F.col(html)
        pages = with_pieces(pages.select(F.col(key), text.alias("html")), parse=parse)
    items = pages.select(F.col(key), piece_items(F.col("pieces"), tokenizer, raw).alias("items"))
    marks = F.filter(F.transform("items", lambda x, k: F.struct(x.ref.alias("ref"), k.alias("at"))), lambda m: m.ref.isNotNull())
    # The n-th mark has n marks before it.
    links = F.transform(marks, lambda m, n: F.struct(m.ref.alias("ref"), (m["at"] - n).alias("pos")))
    return items.select(key, F.transform(F.filter("items", lambda x: x.term.isNotNull()), lambda x: x.term).alias("terms"), links.alias("links"))


def proximity_pairs(page: DataFrame, max_distance: int = MAX_DISTANCE, *, key: str = "article_name") -> DataFrame:
    """Of page_terms(): a row for each link and each term around it."""
    if max_distance < 0:
        raise ValueError("max_distance must be 0 or more")
    # The outer form, since for the inner one the optimizer would first evaluate the page again to see if it has links.
    link = page.select(F.col(key), "terms", F.explode_outer("links").alias("link")).filter("link is not null")
    low = F.greatest(F.col("link.pos") - max_distance, F.lit(0))
    size = F.greatest(F.least(F.col("link.pos") + max_distance, F.size("terms")) - low, F.lit(0))
    near = F.transform(F.slice("terms", low + 1, size), lambda t, j: F.struct(t.alias("term"), (low + j - F.col("link.pos")).cast("int").alias("distance")))
    return link.select(F.col(key), F.col("link.ref").alias("article_ref"), F.explode_outer(near).alias("n")).filter("n is not null").select(F.col(key).alias("article_name"), "n.term", "article_ref", F.col("n.distance").alias("term_distance"))


def terms_of_html(pages: DataFrame, max_distance: int = MAX_DISTANCE, **options: object) -> DataFrame:
    """(article_name, html) to terms near links."""
    return proximity_pairs(page_terms(pages, **options), max_distance)


def terms_of_markup(articles: DataFrame, max_distance: int = MAX_DISTANCE, *, rules: list[tuple[str, str]] | None = None, **options: object) -> DataFrame:
    """(article_name, article_text) to terms near links: markup is rendered, its templates are expanded and the page is parsed in one pass, the rest is native."""
    return terms_of_html(pages_of_markup(articles, rules), max_distance, **options)


def pages_of_markup(articles: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """(article_name, article_text) to (article_name, pieces). A page that can't be rendered or parsed has null, and so no terms."""
    return articles.select("article_name", markup_pieces(F.col("article_name"), F.col("article_text"), rules).alias("pieces"))


def link_refs(pages: DataFrame, *, key: str = "article_name", html: str = "html", parse: str = "auto") -> DataFrame:
    """The article links of each page."""
    pages = with_pieces(pages.select(F.col(key), F.col(html).alias("html")), parse=parse)
    return pages.select(F.col(key), F.explode(F.transform("pieces", lambda p: p.href)).alias("href")).select(F.col(key), T.article_of(F.col("href")).alias("article_ref")).filter("article_ref is not null")
