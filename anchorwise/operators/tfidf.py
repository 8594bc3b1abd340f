"""Document frequency and TF-IDF of terms against documents.

Every figure comes from one aggregate: the summed weight of each (doc, term). The best documents of a term are chosen by term
frequency before the inverse document frequency is joined, which within a term is one positive factor and can't change the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring
from ..functions.shared import table

TOP = 20


def weighted(terms: DataFrame, kind: str = "signed") -> DataFrame:
    """terms near links to (doc, term, weight). Weights are 1 at least; rows without weight would go."""
    rows = terms.select(F.col("article_ref").alias("doc"), "term", scoring.distance_weight(F.col("term_distance"), kind).alias("weight"))
    return rows.filter("weight != 0")


def doc_term_counts(rows: DataFrame) -> DataFrame:
    """(doc, term, weight) to (doc, term, count): partial sums before the shuffle. Rows without a key count nowhere; to say so
    here makes all uses of the result read one exchange, as joins would else filter some of them."""
    return rows.filter("doc is not null and term is not null").groupBy("doc", "term").agg(F.sum("weight").alias("count"))


def counts_by_document(rows: DataFrame) -> DataFrame:
    """doc_term_counts() with the total of each document, of rows that come dealt out by document (see dealt()): neither counts nor totals travel. A table in the shared folder, as words are split once
    for all its uses."""
    counts = doc_term_counts(rows)
    return table(counts.withColumn("total", F.sum("count").over(Window.partitionBy("doc"))))


def doc_totals(counts: DataFrame) -> DataFrame:
    if "total" in counts.columns:
        return counts.select("doc", "total").distinct()
    return counts.groupBy("doc").agg(F.sum("count").alias("total"))


def frequencies(counts: DataFrame) -> DataFrame:
    """(doc, term, tf)."""
    with_total = counts if "total" in counts.columns else counts.join(doc_totals(counts), "doc")
    return with_total.select("doc", "term", scoring.term_frequency(F.col("count"), F.col("total")).alias("tf"))


def inverse_frequencies(counts: DataFrame) -> DataFrame:
    """(term, idf). Counts of documents, overall and by term, follow from the distinct pairs."""
    docs = doc_totals(counts).agg(F.count("total").alias("docs"))
    by_term = counts.groupBy("term").agg(F.count("count").alias("with_term"))
    return by_term.crossJoin(F.broadcast(docs)).select("term", scoring.inverse_document_frequency(F.col("docs"), F.col("with_term")).alias("idf"))


def scores(rows: DataFrame, top: int | None = TOP) -> DataFrame:
    """(doc, term, weight) to (term, doc, tf_idf), the `top` documents of each term (all with None); ties go by doc."""
    return scores_of(doc_term_counts(rows), top)


def scores_of(counts: DataFrame, top: int | None = TOP) -> DataFrame:
    """The same from doc_term_counts() or counts_by_document()."""
    tf = frequencies(counts)
    if top is not None:
        w = Window.partitionBy("term").orderBy(F.desc("tf"), "doc")
        tf = tf.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).drop("rank")
    return tf.join(inverse_frequencies(counts), "term").select("term", "doc", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def document_frequency(terms: DataFrame, articles: int | None = None) -> DataFrame:
    """(article_name, term) to (term, num_articles, df), most frequent first. `articles`: the number that df is a share of; all distinct ones by default."""
    pairs = terms.filter("article_name is not null and term is not null").groupBy("article_name", "term").agg(F.sum(F.lit(1)).alias("n"))  # distinct; both uses read this one exchange
    return document_frequency_of(pairs, articles)


def document_frequency_of(pairs: DataFrame, articles: int | None = None) -> DataFrame:
    """The same from distinct (article_name, term, n)."""
    counts = pairs.groupBy("term").agg(F.count("n").alias("num_articles"))
    if articles is None:
        counts = counts.crossJoin(F.broadcast(pairs.groupBy("article_name").agg(F.sum("n").alias("s")).agg(F.count("s").alias("of"))))
    else:
        counts = counts.withColumn("of", F.lit(articles))
    return counts.select("term", "num_articles", scoring.document_frequency(F.col("num_articles"), F.col("of")).alias("df")).orderBy(F.desc("num_articles"), "term")


def both_counts(terms: DataFrame, kind: str = "signed") -> DataFrame:
    """terms near links to one aggregate for both of their statistics, in one scan and one shuffle: (by, article_name, doc, term, count), where `by` is "doc" for
    doc_term_counts() and "article" for the distinct pairs of document_frequency(). Rows without weight count in the latter alone."""
    rows = terms.filter("term is not null").select("article_name", F.col("article_ref").alias("doc"), "term", scoring.distance_weight(F.col("term_distance"), kind).alias("weight"))
    sets = rows.groupingSets([["article_name", "term"], ["doc", "term"]], "article_name", "doc", "term")
    out = sets.agg(F.grouping("doc").alias("no_doc"), F.sum("weight").alias("count"), F.sum(F.lit(1)).alias("n"), F.count_if(F.col("weight") != 0).alias("weighed"))
    out = out.withColumn("by", F.when(F.col("no_doc") == 1, "article").otherwise("doc")).filter("(by = 'article' AND article_name IS NOT NULL) OR (by = 'doc' AND doc IS NOT NULL AND weighed > 0)")
    return out.select("by", "article_name", "doc", "term", "count", "n")
