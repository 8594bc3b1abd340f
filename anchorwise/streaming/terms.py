"""The generate step on a stream: it is stateless by page, so new article files become terms as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import link_terms
from ..sources.readers import parse_articles


def article_stream(spark: SparkSession, folder: str, files_a_trigger: int = 64) -> DataFrame:
    rows = spark.readStream.option("maxFilesPerTrigger", files_a_trigger).text(folder).toDF("line")
    return parse_articles(rows)


def start(spark: SparkSession, folder: str, output: str, checkpoint: str, *, max_distance: int = link_terms.MAX_DISTANCE, once: bool = False) -> StreamingQuery:
    """Appends terms to Parquet files, each article once. `once`: stops when all present files are done."""
    terms = link_terms.terms_of_markup(article_stream(spark, folder), max_distance)
    writer = terms.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(output)
