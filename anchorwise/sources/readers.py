"""Readers of all datasets."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import wikitext as W

_PAGE = "title string, ns int, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>, malformed string"
#: Bits of an ordinal for the place in a file: of the row in its task (33), and of the task.
PLACE_BITS = 50


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a MediaWiki XML dump of one file or more. Files are split among tasks; ordinal keeps the order of files by name and of places in them, as the splits
    of one file are dealt in order, whatever lies between them. `malformed` holds the source of pages that are no XML, and is null for the others."""
    pages = spark.read.format("xml").option("rowTag", "page").option("columnNameOfCorruptRecord", "malformed").schema(_PAGE).load(path)
    names = sorted(r.file_path for r in spark.read.format("binaryFile").load(path).select("_metadata.file_path").collect())  # no contents are read
    if len(names) >= 1 << 63 - PLACE_BITS:
        raise ValueError("too many dump files for ordinals")
    place, path_of = F.monotonically_increasing_id(), pages.metadataColumn("_metadata")["file_path"]
    file = F.array_position(F.array(*map(F.lit, names)), path_of) - 1 if len(names) > 1 else F.lit(0)
    ordinal = F.when(place < 1 << PLACE_BITS, F.shiftleft(file.cast("long"), PLACE_BITS) + place).otherwise(F.raise_error(F.lit("too many tasks for ordinals")).cast("long"))
    return pages.select("title", "ns", F.col("redirect").isNotNull().alias("is_redirect"), F.coalesce("revision.text._VALUE", F.lit("")).alias("text"), ordinal.alias("ordinal"), "malformed")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(line), one for each line of text."""
    return spark.read.text(path).toDF("line")


def articles(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(article_name, article_text) of article lines. A line has two fields; with an empty body one, which `strict` refuses
    like any other number."""
    return parse_articles(lines(spark, path), strict)


def parse_articles(rows: DataFrame, strict: bool = False) -> DataFrame:
    fields = W.split_line(F.col("line"))
    good = F.size(fields) == 2 if strict else F.size(fields).between(1, 2) & (F.get(fields, F.lit(0)) != "")
    if strict:
        rows = rows.withColumn("line", F.when(good, F.col("line")).otherwise(F.raise_error(F.concat(F.lit("not two fields: "), F.substring("line", 1, 80))).cast("string")))
    else:
        rows = rows.filter(good)
    return rows.select(F.get(fields, F.lit(0)).alias("article_name"), F.coalesce(W.decode_body(F.get(fields, F.lit(1))), F.lit("")).alias("article_text"))


def is_rejected(line: Column) -> Column:
    """Whether parse_articles() leaves a line out."""
    fields = W.split_line(line)
    return ~F.coalesce(F.size(fields).between(1, 2) & (F.get(fields, F.lit(0)) != ""), F.lit(False))


def rejected_lines(rows: DataFrame, most: int = 100) -> DataFrame:
    """The first lines, in number `most` at most, that parse_articles() leaves out."""
    return rows.filter(is_rejected(F.col("line"))).limit(most)


def terms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TERMS).parquet(path)


def parse_categories(rows: DataFrame) -> DataFrame:
    """(line) `name TAB parent|parent` to (name, parents); one field is a category without parents, more than two are left out."""
    fields = W.split_line(F.col("line"))
    rows = rows.filter(F.size(fields).between(1, 2) & (F.get(fields, F.lit(0)) != ""))
    return rows.select(F.get(fields, F.lit(0)).alias("name"), F.coalesce(F.filter(F.split(F.get(fields, F.lit(1)), r"\|"), lambda x: x != ""), F.array().cast("array<string>")).alias("parents"))


def categories(spark: SparkSession, path: str) -> DataFrame:
    return parse_categories(lines(spark, path))


def parse_redirects(rows: DataFrame, place: Column | None = None) -> DataFrame:
    """(line) `from TAB to` to (from_title, to_title, ordinal); other numbers of fields are left out. `place`: what orders the rows; their order in one file by default."""
    fields = W.split_line(F.col("line"))
    rows = rows.withColumn("ordinal", F.monotonically_increasing_id() if place is None else place).filter(F.size(fields) == 2)
    return rows.select(F.get(fields, F.lit(0)).alias("from_title"), F.get(fields, F.lit(1)).alias("to_title"), "ordinal")


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """ordinal is the file's path, the beginning of the split in it, and the order in that: the order of all lines of all files by name, however they are dealt."""
    rows = spark.read.text(path)
    place = rows.select(F.col("value").alias("line"), F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("place"))
    return parse_redirects(place, F.col("place"))


def graph(spark: SparkSession, path: str) -> DataFrame:
    """(name, parents) as written; parents that aren't nodes are dropped."""
    from ..operators.graph import resolve_parents

    return resolve_parents(spark.read.schema(schemas.CATEGORIES).parquet(path))


def counters(spark: SparkSession, path: str) -> dict[str, int]:
    """Counters of a job, a handful of names; those never written count as 0 with `.get(name, 0)`."""
    return {k: int(v) for r in spark.read.text(path, wholetext=True).collect() for k, v in json.loads(r.value).items()}
