"""Dump pages: routing by type, limit and sample of main pages, side tables, counters."""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import wikitext as W


#: Rows of a range of `order`, about; and the fewest ranges.
RANGE_ROWS, RANGES = 1_000_000, 64
#: Bins of a round of nth_least(), whose counts come to the driver.
BINS = 4096
# Counters of page types whose names aren't the types' own; all types, and what is counted besides.
COUNTERS = {"category": "category-valid-page", "redirect": "redirect-valid-page", "exception": "exception"}
TYPES = "main redirect redirect-invalid project file template category category-invalid module disambiguation unknown other exception".split()


def routed(pages: DataFrame) -> DataFrame:
    """Adds page_type to (title, ns, is_redirect, text, ordinal). Pages with a `malformed` source, if that column is there, are exceptions."""
    kind = W.page_type(F.col("title"), F.col("ns"), F.col("is_redirect"), F.col("text"))
    return pages.withColumn("page_type", F.when(F.col("malformed").isNotNull(), "exception").otherwise(kind) if "malformed" in pages.columns else kind)


def range_number(x: Column, cuts: list) -> Column:
    """How many of the sorted cuts are x or less. They are looked for in two levels, so that a row is compared with some two square roots of them."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    passed = lambda array: F.size(F.filter(array, lambda c: x >= c))
    group = F.greatest(passed(F.array(*(F.lit(g[0]) for g in groups))), F.lit(1))
    return (group - 1) * width + passed(F.element_at(F.array(*(F.array(*map(F.lit, g)) for g in groups)), group))


def main_before(df: DataFrame, is_main: Column, order: str = "ordinal") -> DataFrame:
    """Adds main_before, the number of main rows in front of each. Rows are counted by range of `order` first, so no task sees all of them:
    a running sum within a range, plus the sums of the ranges before (one row a range). Ranges hold about RANGE_ROWS rows."""
    buckets = max(RANGES, -(-df.count() // RANGE_ROWS))
    cuts = sorted(set(df.stat.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.1 / buckets)))
    rows = df.withColumn("__main", is_main.cast("long")).withColumn("__range", range_number(F.col(order), cuts))
    totals = rows.groupBy("__range").agg(F.sum("__main").alias("__sum"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    front = totals.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__front"))
    w = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(front), "__range").withColumn("main_before", F.col("__front") + F.coalesce(F.sum("__main").over(w), F.lit(0)))
    return rows.drop("__main", "__range", "__front")


def nth_least(df: DataFrame, column: str, n: int) -> int | None:
    """The n-th least value of a column of whole numbers; None if there are fewer. Each round counts values by bin (pre-aggregated in the scan, BINS counts
    to the driver) and goes on in the bin that holds the n-th, so no rows are shuffled or sorted; a file is scanned for this column alone."""
    v = F.col(column).cast("decimal(20,0)")
    rows = df.filter(F.col(column).isNotNull())
    low, high, have = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if have < n:
        return None
    while low < high:
        step = (high - low) // BINS + 1
        # A difference may be wider than 64 bits; pmod keeps the quotient whole.
        off = v - F.lit(low).cast("decimal(20,0)")
        bins = rows.filter(F.col(column).between(low, high)).select(((off - F.pmod(off, F.lit(step).cast("decimal(20,0)"))) / step).cast("int").alias("bin"))
        for b, count in sorted(map(tuple, bins.groupBy("bin").count().collect())):
            if n <= count:
                break
            n -= count
        low, high = low + b * step, min(high, low + (b + 1) * step - 1)
    return low


def page_limit(df: DataFrame, limit: int, is_main: Column, order: str = "ordinal") -> DataFrame:
    """Rows up to the one that makes `limit` main rows: a prefix, so rows of other types behind it go too. Only the last row's `order` is looked for; rows stay where they are."""
    if limit < 1:
        return df.limit(0)
    last = nth_least(df.filter(is_main).select(order), order, limit)
    return df if last is None else df.filter(F.col(order) <= last)


def hash_sample(df: DataFrame, share: float, key: str, seed: int = 0) -> DataFrame:
    """Rows whose key hashes below `share`: the same ones in every run and on every cluster. 1 keeps all."""
    return df.filter(in_sample(share, key, seed))


def in_sample(share: float, key: str, seed: int = 0) -> Column:
    if not 0 <= share <= 1:
        raise ValueError("share must be from 0 to 1")
    return F.lit(True) if share == 1 else F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) < round(share * 1_000_000)


# The JDK's generator of random numbers.
FACTOR, ADDEND, STATE_BITS, FLOAT_BITS = 0x5DEECE66D, 0xB, 48, 24
#: Bits of a place in the sequence of draws.
PLACE_BITS = 44


def draw(place: Column, seed: int = 0) -> Column:
    """Of the JDK's Random(seed): the draw at this place (from 0) of its sequence of floats, as a whole number of 2^-24. Steps are affine, and so are 2^i of them at once; those of the
    bits of the place are put together, so a row needs no row before it. Products are made in halves, as they are wider than 64 bits."""
    whole, half = (1 << STATE_BITS) - 1, 1 << FLOAT_BITS
    factor, addend, jumps = FACTOR, ADDEND, []
    for bit in range(PLACE_BITS):
        jumps.append(F.struct(F.lit(1 << bit).cast("long").alias("bit"), F.lit(factor // half).cast("long").alias("high"), F.lit(factor % half).cast("long").alias("low"), F.lit(addend).cast("long").alias("add")))
        factor, addend = factor * factor & whole, (factor + 1) * addend & whole

    def step(state: Column, jump: Column) -> Column:
        high, low = F.shiftright(state, FLOAT_BITS), state.bitwiseAND(F.lit(half - 1))
        cross = (high * jump.low + low * jump.high).bitwiseAND(F.lit(half - 1))
        return F.when(place.bitwiseAND(jump.bit) == 0, state).otherwise((F.shiftleft(cross, FLOAT_BITS) + low * jump.low + jump.add).bitwiseAND(F.lit(whole).cast("long")))

    first = ((seed ^ FACTOR) & whole) * FACTOR + ADDEND & whole  # the state after the first step
    return F.shiftright(F.aggregate(F.array(*jumps), F.lit(first).cast("long"), step), STATE_BITS - FLOAT_BITS)


def drawn_sample(df: DataFrame, share: float, is_main: Column, order: str = "ordinal", seed: int = 0) -> DataFrame:
    """All other rows, and the main rows that a loop over them would keep which draws a number for each: that of the k-th main row by `order` is the k-th. 1 keeps all."""
    if not 0 <= share <= 1:
        raise ValueError("share must be from 0 to 1")
    if share == 1:
        return df
    most = math.floor(struct.unpack("f", struct.pack("f", share))[0] * (1 << FLOAT_BITS))
    mains = main_before(df.filter(is_main).select(order), F.lit(True), order)
    dropped = mains.filter(draw(F.col("main_before"), seed) > most).select(order)
    return df.join(dropped, order, "left_anti").select(df.columns)


def main_articles(pages: DataFrame) -> DataFrame:
    """Routed pages to (article_name, article_text) of main pages."""
    return ordered_articles(pages).drop("ordinal")


def ordered_articles(pages: DataFrame) -> DataFrame:
    """main_articles() with their ordinal."""
    return pages.filter("page_type = 'main'").select(W.clean_title(F.col("title")).alias("article_name"), F.coalesce("text", F.lit("")).alias("article_text"), "ordinal")


def exceptions(pages: DataFrame, most: int = 100) -> DataFrame:
    """(line) the first `most` pages that are no XML, each on one line."""
    return pages.filter("page_type = 'exception'").orderBy("ordinal").limit(most).select(F.regexp_replace("malformed", W.TITLE_BREAK, " ").alias("line"))


def categories(pages: DataFrame) -> DataFrame:
    """(name, parents) of category pages with a parent; of pages with one name the last counts."""
    rows = pages.filter("page_type = 'category'").select(W.article_name(F.substring("title", len("Category:") + 1, 1 << 30)).alias("name"), W.parent_categories(F.col("text")).alias("parents"), "ordinal")
    return rows.filter(F.size("parents") > 0).groupBy("name").agg(F.max_by("parents", "ordinal").alias("parents"))


def redirects(pages: DataFrame) -> DataFrame:
    """(from_title, to_title); of pages with one title the last counts."""
    rows = pages.filter("page_type = 'redirect'").select(W.article_name(F.col("title")).alias("from_title"), W.redirect_target(F.col("text")).alias("to_title"), "ordinal")
    return rows.groupBy("from_title").agg(F.max_by("to_title", "ordinal").alias("to_title"))


def plain_categories(pages: DataFrame) -> DataFrame:
    """(name, parents) of category pages by the plainer pattern, which runs to the last brackets of a line; names as they stand, without sort keys; of pages with one name the last counts."""
    parents = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(W.PLAIN_CATEGORY), F.lit(1)), lambda c: F.split_part(c, F.lit("|"), F.lit(1))))
    rows = pages.filter((F.col("ns") == W.CATEGORY_SPACE) & F.col("title").startswith("Category:"))
    rows = rows.select(F.substring("title", len("Category:") + 1, 1 << 30).alias("name"), parents.alias("parents"), "ordinal")
    return rows.groupBy("name").agg(F.max_by("parents", "ordinal").alias("parents"))


def plain_redirects(pages: DataFrame) -> DataFrame:
    """(from_title, to_title) of redirects by the plainer pattern, which keeps anchors; of pages with one title the last counts."""
    to = F.regexp_extract("text", W.PLAIN_REDIRECT, 1)
    rows = pages.filter((F.col("ns") == W.MAIN) & F.col("is_redirect") & (to != "")).select(W.article_name(F.col("title")).alias("from_title"), W.article_name(to).alias("to_title"), "ordinal")
    return rows.groupBy("from_title").agg(F.max_by("to_title", "ordinal").alias("to_title"))


def redirect_map(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """(from_title, to_title, order) to a map in which the first entry of a title counts."""
    return rows.groupBy("from_title").agg(F.min_by("to_title", order).alias("to_title"))


def resolve(terms: DataFrame, redirect: DataFrame, column: str = "article_ref") -> DataFrame:
    """Replaces redirected references. The join is left to the optimizer, as the map grows with the dump."""
    to = redirect.select(F.col("from_title").alias(column), "to_title")
    return terms.join(to, column, "left").withColumn(column, F.coalesce("to_title", column)).select(terms.columns)


def disambiguations(pages: DataFrame) -> DataFrame:
    return pages.filter("page_type = 'disambiguation'").select(W.article_name(F.col("title")).alias("title")).distinct()


def page_counters(pages: DataFrame) -> DataFrame:
    """(counter, value) for each page type, 0 where there is none, and for exceptions."""
    every = pages.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, TYPES))).alias("page_type"), F.lit(0).alias("n"))
    sums = pages.select("page_type", F.lit(1).alias("n")).union(every).groupBy("page_type").agg(F.sum("n").alias("value"))
    name = F.concat("page_type", F.lit("-page"))
    for kind, counter in COUNTERS.items():
        name = F.when(F.col("page_type") == kind, counter).otherwise(name)
    return sums.select(name.alias("counter"), "value")
