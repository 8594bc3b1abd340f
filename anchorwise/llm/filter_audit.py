"""Filter interaction audit (operator 11): what each of five filters removes, in every order in which they can be applied.

Native expressions give each document four bits, one for each filter that it fails by itself (too few words, too few distinct words, too many capitals, symbols). The fifth, that a
smaller doc_id has the identical text, follows from the least doc_id of each text: rows are grouped by the text's SHA-256 digest, so texts aren't shuffled, and a
text of very many rows is summed up before the shuffle. Documents are then counted by part and mask: 32 cells a part. All 120 orders are counted from the cells, as a
document is removed by the first filter of the order whose bit its mask has.

Null text is empty, a null part is the empty string. Words are runs of other characters than blanks, tabs, line ends and the like. A text is taken whole; a very long one needs
some ten times its size in memory while its words are counted. Rows with one doc_id never are copies of each other; a row with a null doc_id is no copy and has none. A document
is labelled if any row of the labels says so; rows of labels without doc_id count for none. An empty table gives no rows. Further columns don't matter, whatever their names."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, split_words

FILTERS = "ABCDE"
#: The filter that looks at other documents.
COPY = 1 << FILTERS.index("E")
#: Cells of a part.
CELLS = 1 << len(FILTERS)


def own_failures(text: Column) -> Column:
    """The bits of the filters A to D."""
    few = let(split_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = (few.n < 200, 100 * few.distinct < 50 * few.n, 100 * capitals.cast("long") > 3 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]"))
    bits = F.lit(0)
    for k, condition in enumerate(failed):
        bits = bits + F.when(condition, 1 << k).otherwise(0)
    return bits


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Counts of documents by part and mask: (part, mask, n, good, toxic), 32 rows a part at most."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), own_failures(text).alias("own"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = rows.groupBy("id", "digest", "part", "own").agg(F.count("*").alias("n"))  # repeated rows
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(*(F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.join(marks, "id", "left").select("id", "digest", "part", "own", "n", *(F.coalesce(F.col("n") * F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")))
    # A row for each text of a part, with the share of its least doc_id (of all rows without one apart).
    counted = ("n", "good", "toxic")
    rows = rows.groupBy("digest", "part", "own", F.col("id").isNull().alias("unknown")).agg(F.min("id").alias("first"), *(f(c).alias(to) for c in counted for f, to in ((F.sum, c), (lambda x: F.min_by(x, "id"), f"first_{c}"))))
    least = F.col("first") == F.min("first").over(Window.partitionBy("digest"))  # a row for each part in which a text occurs
    share = F.struct(*(F.when(F.col("unknown"), F.col(c)).when(least, F.col(f"first_{c}")).otherwise(0).alias(c) for c in counted))
    rows = rows.select("part", "own", share.alias("first"), F.struct(*counted).alias("all"))
    single = F.struct(F.col("own").alias("mask"), *(F.col(f"first.{c}").alias(c) for c in counted))
    copies = F.struct((F.col("own") + COPY).alias("mask"), *((F.col(f"all.{c}") - F.col(f"first.{c}")).alias(c) for c in counted))
    return rows.select("part", F.explode(F.array(single, copies)).alias("c")).groupBy("part", "c.mask").agg(*(F.sum(f"c.{c}").alias(c) for c in counted))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows for each part."""
    by_part = masks(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    rows = by_part.select("part", "cells", F.explode(orders).alias("filter_order"))
    bits = F.expr(f"transform(split(filter_order, ''), x -> shiftleft(1, instr('{FILTERS}', x) - 1))")
    rows = rows.select("part", "cells", "filter_order", F.posexplode(bits).alias("at", "bit"), bits.alias("bits"))
    before = F.aggregate(F.slice("bits", 1, F.col("at")), F.lit(0), lambda s, b: s + b)
    rows = rows.select("part", "cells", "filter_order", (F.col("at") + 1).alias("step"), F.substr("filter_order", F.col("at") + 1, F.lit(1)).alias("filter"), "bit", before.alias("before"))
    before, bit = F.col("before"), F.col("bit")
    fails = lambda c: c.mask.bitwiseAND(bit) != 0
    passed = lambda c: c.mask.bitwiseAND(before) == 0

    def total(field: str, which) -> Column:  # noqa: ANN001
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(which(c), c[field]).otherwise(0))

    rows = rows.select(
        "part", "filter_order", "step", "filter",
        total("n", lambda c: passed(c) & ~fails(c)).alias("kept"), total("n", lambda c: passed(c) & fails(c)).alias("removed"), total("n", lambda c: ~passed(c) & fails(c)).alias("redundant"),
        total("n", lambda c: c.mask == bit).alias("unique_fails"), total("good", lambda c: passed(c) & fails(c)).alias("good_lost"), total("toxic", lambda c: passed(c) & fails(c)).alias("toxic_lost"),
    )
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))
