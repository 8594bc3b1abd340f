"""Columns that turn HTML into ordered terms and article links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that don't break words.
INLINE = (
    "b big i small tt abbr acronym cite code dfn em kbd strong samp time var a bdo img map object q script span sub sup button input label select textarea"
).split()
# Patterns. A word as the JDK breaks it: letters, digits and marks inside; quotes, dots and hyphens join letters.
WORD = r"[\p{L}\p{N}_]*\p{L}[-'.\x{22}\x{AD}](?:\p{L}(?:[\p{L}\p{N}_]*\p{L})?[-'.\x{22}\x{AD}])*\p{L}[\p{L}\p{N}_]*|[\p{L}\p{N}_]+"
#: What the JDK breaks at other places than WORD does: underscores, marks and formats that begin a word, dashes, scripts without blanks, letters of two halves.
OTHERWISE = r"[_\p{M}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\x{10000}-\x{10FFFF}]|[[\p{Cf}\p{Pd}]&&[^-\xAD]]"
ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a\s*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
COMMENT = r"(?s)<!--.*?-->"
SCRIPT = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>"
HREF = r"(?is)(?:^|[\s\x{22}'])href\s*=\s*(?:\x{22}([^\x{22}]*)|'([^']*)|([^\s\x{22}'>][^\s>]*))"
UNBROKEN = r"(?i)</[^>]*>|<(?:" + "|".join(INLINE) + r")(?:[\s/][^>]*)?>"
TAG = r"<[A-Za-z!?][^>]*>"
EDGE = r"^[\[\](),?!;:.'\x{22}]+|[\[\](),?!;:.'\x{22}]+$"
#: White space as the JDK knows it: no-break spaces are none.
BLANK_EDGE = r"^\p{javaWhitespace}+|\p{javaWhitespace}+$"
#: Any tag; and `<` in the text of a script or style, each found from the tag on or from the one before.
ANY_TAG = r"</?[A-Za-z!?][^>]*>"
RAW_LESS = r"(?i)(<(?:script|style)\b[^>]*+>|\G(?!^))([^<]*+)<(?!/(?:script|style)\b)"
# Entities, and further ones that attributes hold; the ampersand comes last.
ATTRIBUTE_ENTITIES = [("&#x27;", "'"), ("&#X27;", "'"), ("&#34;", '"'), ("&#x22;", '"'), ("&#38;", "&"), ("&#x26;", "&")]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def plain_text(html: Column) -> Column:
    """Text of a piece of HTML: inline and closing tags vanish, other opening tags become a space."""
    return entities(F.regexp_replace(F.regexp_replace(html, UNBROKEN, ""), TAG, " "))


def phrase_text(html: Column) -> Column:
    """Text of an anchor or title: all tags vanish."""
    return entities(F.regexp_replace(html, ANY_TAG, ""))


def normalize(word: Column) -> Column:
    """Of a word: lower case, no punctuation at the ends."""
    return F.regexp_replace(F.lower(word), EDGE, "")


def normalize_phrase(text: Column) -> Column:
    """Of any text: lower case, no white space at the ends, then no punctuation there. What is inside stays, and so does white space that punctuation was around."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), BLANK_EDGE, ""), EDGE, "")


def accepted(term: Column) -> Column:
    """A letter comes first; letters beyond the first 65,536 characters are two halves to the JDK, and none."""
    return term.rlike(r"^[\p{L}&&[^\x{10000}-\x{10FFFF}]]")


def words(text: Column, tokenizer: str = "break") -> Column:
    """Normalised, accepted terms of a text. `break`: the JDK's word boundaries; `pattern`: nearly the same by a regular expression; `cut`: the JDK's boundaries, but each word cut
    to what the pattern finds in it, as signs behind a number (`a27&`, `a5%`) belong to its word for the JDK, and points within; `space`: split at blanks, terms as they stand."""
    if tokenizer == "space":
        return F.filter(F.transform(F.split(text, r"[ \t\r\n]"), F.trim), accepted)
    by_pattern = lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))
    found = by_pattern(text) if tokenizer == "pattern" else F.flatten(F.sentences(text))
    if tokenizer == "cut":
        found = F.when(text.rlike(OTHERWISE), by_pattern(text)).otherwise(F.flatten(F.transform(found, by_pattern)))
    return F.filter(F.transform(found, normalize), accepted)


def href(attributes: Column) -> Column:
    """The href among an anchor's attributes, in double, single or no quotes, its entities decoded; empty where there is none."""
    found = F.concat(*(F.regexp_extract(attributes, HREF, k) for k in (1, 2, 3)))  # one of them at most holds something
    for entity, char in [*ATTRIBUTE_ENTITIES, *ENTITIES]:
        found = F.replace(found, F.lit(entity), F.lit(char))
    return found


def article_of(href: Column) -> Column:
    """The article that a url names: its bytes decoded, root-relative, without a colon, cut at #; null for other urls."""
    href = F.try_url_decode(href)
    return F.when(href.startswith("/") & ~href.contains(":"), F.regexp_extract(href, "^/([^#]*)", 1))


def link_target(attributes: Column) -> Column:
    """The article that an anchor's href names, null for other anchors."""
    return article_of(href(attributes))
