"""The term step as a table function of SQL: SELECT url, t.* FROM pages, LATERAL link_terms(html, 10) AS t.

Pages go to the lenient parser in Arrow batches; words are found by the pattern (the JDK's word boundaries have no form in Python). Null pages, and pages that can't be parsed, give no rows."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote_plus

import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import terms as T
from .link_terms import pieces_of

COLUMNS = "term string, article_ref string, term_distance int"
_WORD = regex.compile(T.WORD.replace(r"\x{22}", '"').replace(r"\x{AD}", "\xad"))
_LETTER = regex.compile(r"\p{L}")
_BAD_ESCAPE = regex.compile(r"%(?![0-9A-Fa-f]{2})")
# What is cut off the ends of terms, punctuation and the JDK's white space.
_EDGE = "[](),?!;:.'\""
_BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"


def _accepted(term: str) -> bool:
    return bool(term) and ord(term[0]) < 1 << 16 and _LETTER.match(term) is not None


def article_of(href: str | None) -> str | None:
    """See terms.article_of()."""
    if href is None or _BAD_ESCAPE.search(href):
        return None
    name = unquote_plus(href)
    return name[1:].partition("#")[0] if name.startswith("/") and ":" not in name else None


def terms_and_links(pieces: list) -> tuple[list[str], list[tuple[str, int]]]:
    """The terms of a page in order, and its links with the number of terms before each."""
    terms: list[str] = []
    links: list[tuple[str, int]] = []
    for text, href, label in pieces:
        terms += filter(_accepted, (w.lower().strip(_EDGE) for w in _WORD.findall(text)))
        if (ref := article_of(href)) is not None:
            links.append((ref, len(terms)))
        if label is not None and _accepted(phrase := label.lower().strip(_BLANK).strip(_EDGE)):
            terms.append(phrase)
    return terms, links


class LinkTerms:
    def eval(self, html: str, distance: int) -> Iterator[tuple[str, str, int]]:
        if distance < 0:
            raise ValueError("distance must be 0 or more")
        try:
            terms, links = terms_and_links(pieces_of(html)) if html is not None else ([], [])
        except Exception:  # noqa: BLE001  the other pages go on
            return
        for ref, at in links:
            for i in range(max(0, at - distance), min(at + distance, len(terms))):
                yield terms[i], ref, i - at


def register(spark: SparkSession, name: str = "link_terms") -> None:
    """Makes link_terms(html, distance) known to the session's SQL."""
    spark.udtf.register(name, F.udtf(LinkTerms, returnType=COLUMNS, useArrow=True))


