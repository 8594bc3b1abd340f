"""Columns of weights and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A term at its link weighs so much; the weight falls by 1 a step behind the link and is 1 at least.
AT_LINK = 10


def distance_weight(distance: Column, kind: str = "signed") -> Column:
    """`signed`: terms before a link weigh more the farther they are. `abs`: nearness counts on both sides."""
    d = F.abs(distance) if kind == "abs" else distance
    return F.greatest(F.lit(1), AT_LINK - d).cast("int")


def term_frequency(count: Column, total: Column) -> Column:
    return F.sqrt(count / total)


def inverse_document_frequency(docs: Column, docs_with_term: Column) -> Column:
    return 1 + F.log(docs / (docs_with_term + 1))


def document_frequency(articles: Column, of: Column) -> Column:
    return articles / of
