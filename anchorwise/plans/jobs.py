"""The batch jobs: dump, generate, analyze, category graph, redirect map."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import templates
from ..functions import wikitext as W
from ..functions.render import rendered
from ..functions.shared import release, table
from ..functions.wikitext import counter_name
from ..operators import dump, graph, link_terms, tfidf
from ..sources import readers, sinks


def explained(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def dump_job(spark: SparkSession, input_file: str, output_dir: str, metadata_dir: str, *, pages_per_file: int = sinks.PAGES_PER_FILE, num_pages: int | None = None, sample_percent: float = 100.0, compress: bool = False) -> dict[str, int]:
    """Splits a dump into article lines, categories, redirects, disambiguations and the first pages that are no XML; gives counts of page types."""
    pages = dump.routed(readers.dump_pages(spark, input_file))
    is_main = F.col("page_type") == "main"
    routed = pages = table(pages)  # routed once, for all outputs
    sampled = None
    try:
        if sample_percent != 100:
            sampled = pages = table(dump.drawn_sample(pages, sample_percent / 100, is_main))
        if num_pages is not None:
            pages = dump.page_limit(pages, num_pages, is_main)
        sinks.article_parts(dump.ordered_articles(pages), output_dir, pages_per_file=pages_per_file, compress=compress)
        sinks.rejects(dump.exceptions(pages), f"{metadata_dir}/exceptions.txt")
        sinks.categories(dump.categories(pages), f"{metadata_dir}/categories.txt")
        sinks.redirects(dump.redirects(pages), f"{metadata_dir}/redirects.txt")
        sinks.disambiguations(dump.disambiguations(pages), f"{metadata_dir}/disambigs.txt")
        return {r.counter: r.value for r in dump.page_counters(pages).collect()}
    finally:
        release(routed, *([sampled] if sampled else []))


def generate_job(spark: SparkSession, input_dir: str, working_dir: str, *, max_distance: int = link_terms.MAX_DISTANCE, rules: list[tuple[str, str]] | None = None, strict: bool = False, plan_file: str | None = None) -> dict[str, int]:
    """Article lines to terms near links, with counters. No shuffle. The plan goes to `plan_file`, if given."""
    raw, seen, parsed, made = (Observation(x) for x in ("lines", "articles", "pages", "terms"))
    lines = readers.lines(spark, input_dir)
    articles = readers.parse_articles(lines.observe(raw, F.count_if(readers.is_rejected(F.col("line"))).alias("REJECTED")), strict).observe(seen, F.count(F.lit(1)).alias("ARTICLES"))
    pages = link_terms.pages_of_markup(articles, rules).observe(parsed, F.count("pieces").alias("HTML_PARSE"), F.count_if(F.col("pieces").isNull()).alias("HTML_PARSE_ERROR"))
    terms = link_terms.terms_of_html(pages, max_distance).observe(made, F.count(F.lit(1)).alias("WIKITERM"))
    if plan_file:
        Path(plan_file).write_text(explained(terms))
    sinks.terms(terms, f"{working_dir}/{schemas.TERMS_DIR}")
    if raw.get["REJECTED"]:  # only then is the input read for them
        sinks.rejects(readers.rejected_lines(lines), f"{working_dir}/{schemas.REJECTS_DIR}")
    counts = {counter_name("generate", k): int(v) for k, v in {**seen.get, **parsed.get, **made.get}.items()}
    sinks.counters(spark, counts, f"{working_dir}/{schemas.COUNTERS_DIR}/generate")
    return counts


def analyze_job(spark: SparkSession, working_dir: str, *, num_articles: int | None = None, top: int = tfidf.TOP, weight: str = "signed", plan_file: str | None = None) -> None:
    """Terms to document frequencies and to the best articles of each term: one scan and one aggregate for both. Its plan and that of the scores go to `plan_file`, if given."""
    both = tfidf.both_counts(readers.terms(spark, f"{working_dir}/{schemas.TERMS_DIR}"), weight)
    counts = table(both, by="by")
    try:
        scores = tfidf.scores_of(counts.filter("by = 'doc'").select("doc", "term", "count"), top)
        if plan_file:
            Path(plan_file).write_text(explained(both) + explained(scores))
        sinks.term_df(tfidf.document_frequency_of(counts.filter("by = 'article'").select("article_name", "term", "n"), num_articles), f"{working_dir}/{schemas.TERM_DF_DIR}")
        sinks.term_scores(scores.repartition("term").sortWithinPartitions("term", F.desc("tf_idf"), "doc"), f"{working_dir}/{schemas.TERM_SCORES_DIR}")
    finally:
        release(counts)


def category_graph_job(spark: SparkSession, input_file: str, output_file: str) -> int:
    """Category lines to a graph without cycles; gives the number of nodes."""
    sinks.graph(graph.build(readers.categories(spark, input_file)), output_file)
    return spark.read.parquet(output_file).count()


def redirect_map_job(spark: SparkSession, input_file: str, output_file: str) -> int:
    sinks.redirect_map(dump.redirect_map(readers.redirects(spark, input_file)), output_file)
    return spark.read.parquet(output_file).count()


def markup_job(spark: SparkSession, input_file: str, output_dir: str, *, max_distance: int = link_terms.MAX_DISTANCE) -> None:
    """A look at the markup of a dump, with the plainer rules (words between blanks, titles and anchors as they stand): pairs of terms and links, counts of templates
    without a rule, categories and redirects."""
    dumped = readers.dump_pages(spark, input_file).filter("malformed is null")
    main = dumped.filter((F.col("ns") == W.MAIN) & ~F.col("is_redirect"))
    articles = main.select(F.col("title").alias("article_name"), F.col("text").alias("article_text"))
    sinks.terms(link_terms.terms_of_html(link_terms.pages_of_markup(articles), max_distance, tokenizer="space", raw=True), f"{output_dir}/pairs")
    html = articles.select(rendered(F.col("article_text")).alias("html"))
    sinks.counts(templates.unknown_templates(html, "html").orderBy(F.desc("n"), "template"), f"{output_dir}/templates")
    sinks.categories(dump.plain_categories(dumped), f"{output_dir}/categories.txt")
    sinks.redirects(dump.plain_redirects(dumped), f"{output_dir}/redirects.txt")
