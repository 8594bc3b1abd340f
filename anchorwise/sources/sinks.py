"""Writers of all datasets. Each replaces what lies at its path."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wikitext as W
from ..operators.dump import main_before

PAGES_PER_FILE = 100_000


def article_parts(articles: DataFrame, path: str, *, pages_per_file: int = PAGES_PER_FILE, compress: bool = False, order: str = "ordinal") -> None:
    """(article_name, article_text, order) as article lines by `order`, in files part-000, part-001 and so on of `pages_per_file` lines each, the last of the rest. One task
    sorts and writes a file, under Spark's commit protocol; files get their names at the end."""
    rows = main_before(articles, F.lit(True), order).withColumn("part", F.floor(F.col("main_before") / pages_per_file).cast("long"))
    rows = rows.repartition("part").sortWithinPartitions("part", order)
    lines = rows.select("part", W.article_line(F.col("article_name"), F.col("article_text")).alias("value"))
    lines.write.mode("overwrite").partitionBy("part").option("compression", "gzip" if compress else "none").text(path)
    spark, end = articles.sparkSession, "gz" if compress else "txt"
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.listStatus(top) if s.isDirectory() and s.getPath().getName().startswith("part=")]
    for folder in folders:  # one for each output file
        (file,) = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        fs.rename(file, hadoop.Path(top, f"part-{int(folder.getName().partition('=')[2]):03d}.{end}"))
        fs.delete(folder, True)
    if not folders:
        empty = fs.create(hadoop.Path(top, f"part-000.{end}"))
        empty.write(bytearray(gzip.compress(b"") if compress else b""))
        empty.close()


def rejects(rows: DataFrame, path: str) -> None:
    """(line) as text."""
    rows.select("line").coalesce(1).write.mode("overwrite").text(path)


def counts(rows: DataFrame, path: str) -> None:
    """(template, n), tab-separated."""
    _tabbed(rows.select("template", "n"), path)


def categories(rows: DataFrame, path: str) -> None:
    rows.select(F.concat_ws("\t", "name", F.array_join("parents", "|")).alias("value")).write.mode("overwrite").text(path)


def redirects(rows: DataFrame, path: str) -> None:
    rows.select(F.concat_ws("\t", "from_title", "to_title").alias("value")).write.mode("overwrite").text(path)


def disambiguations(rows: DataFrame, path: str) -> None:
    rows.select(F.col("title").alias("value")).write.mode("overwrite").text(path)


def terms(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def _tabbed(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "\t").csv(path)


def term_df(rows: DataFrame, path: str) -> None:
    _tabbed(rows.select("term", F.col("df").cast("float").alias("df")), path)


def term_scores(rows: DataFrame, path: str) -> None:
    _tabbed(rows.select("term", "doc", F.col("tf_idf").cast("float").alias("tf_idf")), path)


def graph(rows: DataFrame, path: str) -> None:
    rows.select("name", "parents").write.mode("overwrite").parquet(path)


def redirect_map(rows: DataFrame, path: str) -> None:
    rows.select("from_title", "to_title").write.mode("overwrite").parquet(path)


def counters(spark: SparkSession, values: dict[str, int], path: str) -> None:
    """A handful of names and values as one JSON text."""
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path)
