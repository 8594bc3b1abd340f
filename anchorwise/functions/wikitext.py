"""Columns over page titles and raw markup: page types, redirects, categories, disambiguation, and the article line format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns.
REDIRECT = r"(?i)#REDIRECT[ \t]*:*[ \n]*\[\[(.+?)(#.+?|)\]\]"
CATEGORY = r"(?i)\[\[Category:(.+?)\]\]"
TITLE_BREAK = r"[\t\n\r]"
# The plainer patterns of the survey of a markup sample.
PLAIN_REDIRECT, PLAIN_CATEGORY = r"#REDIRECT \[\[(.+?)\]\]", r"\[\[Category:(.+)\]\]"
# Names of disambiguation templates, as patterns.
DISAMBIGUATION_NAMES = [
    "disambiguation", "disambig", r"disambig\-[^ \t]+", "disamb", "dab", r"disambiguation[ \t]+cleanup", r"[^ \t]+[ \t]+disambiguation",
    "numberdis", r"Letter\-NumberCombDisambig", "hndis", r"hndis\-cleanup", "geodis", r"Mil\-unit\-dis",
]
DISAMBIGUATION = r"(?i)\{\{[ \t]*(?:" + "|".join(DISAMBIGUATION_NAMES) + r")[ \t]*(?:\|.*|)\}\}"
# Numbers of the name spaces.
MAIN, PROJECT, FILE, TEMPLATE, CATEGORY_SPACE, MODULE = 0, 4, 6, 10, 14, 828


def article_name(title: Column) -> Column:
    """Spaces become underscores."""
    return F.translate(title, " ", "_")


def redirect_target(text: Column) -> Column:
    """The article that a redirect leads to, without an anchor; null if there is no directive."""
    found = F.regexp_extract(text, REDIRECT, 1)
    return F.when(found != "", article_name(found))


def parent_categories(text: Column) -> Column:
    """Distinct parents, without sort keys, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit(CATEGORY), F.lit(1))
    return F.array_distinct(F.transform(found, lambda c: article_name(F.split_part(c, F.lit("|"), F.lit(1)))))


def is_disambiguation(text: Column) -> Column:
    return text.rlike(DISAMBIGUATION)


def page_type(title: Column, ns: Column, is_redirect: Column, text: Column) -> Column:
    """The first that applies; the order matters."""
    known = [(FILE, "file"), (TEMPLATE, "template"), (PROJECT, "project"), (MODULE, "module")]
    kind = F.when(ns == CATEGORY_SPACE, F.when(title.startswith("Category:"), "category").otherwise("category-invalid"))
    for number, name in known:
        kind = kind.when(ns == number, name)
    kind = kind.when(ns.isNull() | (ns != MAIN), "unknown")
    kind = kind.when(is_redirect, F.when(redirect_target(text).isNotNull(), "redirect").otherwise("redirect-invalid"))
    return kind.when(title.contains("(disambiguation)") | is_disambiguation(text), "disambiguation").otherwise("main")


def clean_title(title: Column) -> Column:
    return F.regexp_replace(title, TITLE_BREAK, " ")


def encode_body(text: Column) -> Column:
    """Base64 on one line."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")


def decode_body(body: Column) -> Column:
    return F.decode(F.unbase64(body), "UTF-8")


def article_line(title: Column, text: Column) -> Column:
    return F.concat_ws("\t", clean_title(title), encode_body(text))


def split_line(line: Column) -> Column:
    """Fields between tabs, without empty ones at the end."""
    return F.split(F.regexp_replace(line, "\t+$", ""), "\t")


def counter_name(group: str, name: str) -> str:
    return f"{group}.{name}"
