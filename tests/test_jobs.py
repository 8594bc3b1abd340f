import glob
import gzip
import math

import pytest
from pyspark.sql import functions as F

from anchorwise.__main__ import parser
from anchorwise.operators import link_terms
from anchorwise.operators.graph import same_graph
from anchorwise.plans import jobs
from anchorwise.sources import readers, sinks
from anchorwise.streaming import terms as stream

PAGES = [
    ("Category:Fruit", 14, "", "[[Category:Food]] [[Category:Plants]]"), ("Category:Bare", 14, "", "x"), ("File:a.png", 6, "", ""), ("Template:T", 10, "", ""), ("Project:P", 4, "", ""), ("Module:M", 828, "", ""), ("User:U", 2, "", ""),
    ("Old apple", 0, '<redirect title="Apple" />', "#REDIRECT [[Apple]]"), ("Broken", 0, '<redirect title="X" />', "no directive"), ("Pear (disambiguation)", 0, "", ""), ("Plum", 0, "", "{{disambig}}"),
    ("Apple", 0, "", "An '''apple''' grows on an [[Apple tree|tree]]. {{main|Orchard}} {{cite web|{{x}}}} See [[Cider#Dry]]."), ("Empty", 0, "", ""), ("Cider", 0, "", "Made of [[Apple]]s &amp; {{unclosed"),
]


def dump_file(folder):
    path = folder / "dump.xml"
    body = "".join(f"<page><title>{t}</title><ns>{n}</ns>{r}<revision><text xml:space=\"preserve\">{x}</text></revision></page>\n" for t, n, r, x in PAGES)
    path.write_text(f"<mediawiki>\n{body}</mediawiki>\n")
    return str(path)


def test_dump_generate_analyze(spark, tmp_path):
    out, meta, work = (str(tmp_path / x) for x in ("out", "meta", "work"))
    counts = jobs.dump_job(spark, dump_file(tmp_path), out, meta, pages_per_file=2)
    assert {k: v for k, v in counts.items() if v} == {"category-valid-page": 2, "file-page": 1, "template-page": 1, "project-page": 1, "module-page": 1, "unknown-page": 1, "redirect-valid-page": 1, "redirect-invalid-page": 1, "disambiguation-page": 2, "main-page": 3}
    assert len(counts) == 13 and counts["other-page"] == counts["exception"] == 0
    lines = [[x.split("\t")[0] for x in open(f"{out}/part-00{k}.txt")] for k in range(2)]
    assert lines == [["Apple", "Empty"], ["Cider"]] and len(glob.glob(f"{out}/*")) == 3  # and _SUCCESS
    assert [tuple(r) for r in readers.categories(spark, f"{meta}/categories.txt").collect()] == [("Fruit", ["Food", "Plants"])]
    assert [tuple(r)[:2] for r in readers.redirects(spark, f"{meta}/redirects.txt").collect()] == [("Old_apple", "Apple")]
    counts = jobs.generate_job(spark, out, work, max_distance=20, plan_file=str(tmp_path / "plan"))
    assert counts["generate.ARTICLES"] == 3 and counts["generate.WIKITERM"] > 0
    assert "Scan text" in (tmp_path / "plan").read_text()
    assert readers.counters(spark, f"{work}/counters/generate") == counts
    terms = readers.terms(spark, f"{work}/terms")
    assert terms.count() == counts["generate.WIKITERM"] and {r[0] for r in terms.select("article_ref").distinct().collect()} == {"Apple", "Apple_tree", "Cider"}
    jobs.analyze_job(spark, work)
    df = {r[0]: float(r[1]) for r in spark.read.option("sep", "\t").csv(f"{work}/term_df").collect()}
    assert math.isclose(df["apple"], 1.0) or df["apple"] > 0
    assert spark.read.option("sep", "\t").csv(f"{work}/term_scores").count() > 0
    # The same terms from a stream over the article lines.
    q = stream.start(spark, out, str(tmp_path / "s"), str(tmp_path / "ck"), max_distance=20, once=True)
    q.awaitTermination()
    assert readers.terms(spark, str(tmp_path / "s")).exceptAll(terms).isEmpty() and readers.terms(spark, str(tmp_path / "s")).count() == terms.count()


def test_limit_and_gzip(spark, tmp_path):
    counts = jobs.dump_job(spark, dump_file(tmp_path), str(tmp_path / "o"), str(tmp_path / "m"), num_pages=1, compress=True)
    assert counts["main-page"] == 1 and sum(len(gzip.open(f).read().splitlines()) for f in glob.glob(f"{tmp_path}/o/*.gz")) == 1
    counts = jobs.dump_job(spark, dump_file(tmp_path), str(tmp_path / "o"), str(tmp_path / "m"), sample_percent=0)
    assert counts["main-page"] == 0 and counts["file-page"] == 1 and open(tmp_path / "o" / "part-000.txt").read() == ""


def test_pages_of_several_files_go_by_file_and_place(spark, tmp_path):
    (tmp_path / "d").mkdir()
    page = lambda t, x: f"<page><title>{t}</title><ns>0</ns><revision><text>{x}</text></revision></page>\n"
    for name, titles, filler in (("a", "pqr", "x"), ("b", "stu", "y" * 100_000), ("c", "vw", "z" * 5000)):  # larger files are dealt first
        (tmp_path / "d" / f"{name}.xml").write_text("<mediawiki>\n" + "".join(page(t, filler) for t in titles) + "</mediawiki>\n")
    rows = readers.dump_pages(spark, str(tmp_path / "d")).orderBy("ordinal").collect()
    assert "".join(r.title for r in rows) == "pqrstuvw"
    counts = jobs.dump_job(spark, str(tmp_path / "d"), str(tmp_path / "o"), str(tmp_path / "m"), num_pages=5, pages_per_file=2)
    assert counts["main-page"] == 5 and [x.split("\t")[0] for k in range(3) for x in open(tmp_path / "o" / f"part-00{k}.txt")] == list("pqrst")


def test_malformed_pages_are_counted_and_kept(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<mediawiki>\n<page><title>Good</title><ns>0</ns><revision><text>a</text></revision></page>\n<page><title>Bad</title><ns>0</ns><revision><text>b</tex></revision></page>\n</mediawiki>\n")
    counts = jobs.dump_job(spark, str(tmp_path / "x.xml"), str(tmp_path / "o"), str(tmp_path / "m"))
    assert counts["main-page"] == 1 and counts["exception"] == 1
    assert ["Bad" in r.value for r in spark.read.text(str(tmp_path / "m" / "exceptions.txt")).collect()] == [True]


def test_pages_that_fail_and_lines_that_are_none_are_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-000.txt").write_text("A\tW1tCXV0geA==\nB\t\nx\ty\tz\n")
    counts = jobs.generate_job(spark, str(tmp_path / "in"), str(tmp_path / "w"))
    assert counts["generate.ARTICLES"] == counts["generate.HTML_PARSE"] == 2 and counts["generate.HTML_PARSE_ERROR"] == 0
    assert [r.value for r in spark.read.text(str(tmp_path / "w" / "rejects")).collect()] == ["x\ty\tz"]
    with pytest.raises(Exception, match="missing|unterminated"):  # rules that are no patterns are at fault, not pages
        jobs.generate_job(spark, str(tmp_path / "in"), str(tmp_path / "w"), rules=[("(", "ignore")])
    pages = spark.createDataFrame([("A", None), ("B", "x <a href='/Y'>y</a>")], "article_name string, html string")
    assert {r.article_name for r in link_terms.terms_of_html(pages).collect()} == {"B"}


def test_analyze_reads_terms_once(spark, tmp_path):
    from anchorwise.operators import tfidf

    rows = [("a", "t", "x", 1), ("a", "t", "y", -2), ("b", "t", "x", 3), ("b", "u", None, 1), (None, "u", "x", 2), ("c", None, "x", 1)]
    terms = spark.createDataFrame(rows, "article_name string, term string, article_ref string, term_distance int")
    terms.write.parquet(str(tmp_path / "terms"))
    both = tfidf.both_counts(readers.terms(spark, str(tmp_path / "terms")))
    plan = jobs.explained(both)
    assert plan.count("Scan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 1  # the scan is listed, then described
    norm = lambda df: sorted(tuple(r) for r in df.collect())
    assert norm(both.filter("by = 'doc'").select("doc", "term", "count")) == norm(tfidf.doc_term_counts(tfidf.weighted(terms)))
    assert norm(tfidf.document_frequency_of(both.filter("by = 'article'").select("article_name", "term", "n"))) == norm(tfidf.document_frequency(terms))
    jobs.analyze_job(spark, str(tmp_path))
    assert {r[0] for r in spark.read.option("sep", "\t").csv(str(tmp_path / "term_df")).collect()} == {"t", "u"}


def test_markup_job(spark, tmp_path):
    jobs.markup_job(spark, dump_file(tmp_path), str(tmp_path / "o"), max_distance=3)
    pairs = {tuple(r) for r in readers.terms(spark, str(tmp_path / "o" / "pairs")).collect()}
    assert ("Apple", "grows", "Apple_tree", -3) in pairs and ("Apple", "tree", "Apple_tree", 0) in pairs  # words and anchors as they stand
    assert {(r[0], r[1]) for r in spark.read.option("sep", "\t").csv(str(tmp_path / "o" / "categories.txt")).collect()} >= {("Fruit", "Food]] [[Category:Plants")}
    assert [tuple(r)[:2] for r in readers.redirects(spark, str(tmp_path / "o" / "redirects.txt")).collect()] == [("Old_apple", "Apple")]
    assert spark.read.option("sep", "\t").csv(str(tmp_path / "o" / "templates")).count() >= 0


def test_draws_are_those_of_a_loop(spark):
    from anchorwise.operators import dump

    def loop(seed, n):
        state = (seed ^ 0x5DEECE66D) % 2**48
        for _ in range(n):
            state = (state * 0x5DEECE66D + 11) % 2**48
            yield state >> 24

    for seed in (0, 1, -7, 123456789012345):
        got = [r[0] for r in spark.range(300).select(dump.draw(F.col("id"), seed)).collect()]
        assert got == [*loop(seed % 2**48, 300)]
    assert round(spark.range(1).select(dump.draw(F.col("id"))).first()[0] / 2**24, 6) == 0.730968  # the first float of Random(0)
    far = (1 << 33) + 12345  # a place that no loop reaches soon: by powers of the step as a matrix
    a, c, state, k = 0x5DEECE66D, 11, 0x5DEECE66D, far + 1
    while k:
        if k & 1:
            state = (state * a + c) % 2**48
        a, c, k = a * a % 2**48, (a + 1) * c % 2**48, k >> 1
    assert spark.range(1).select(dump.draw(F.lit(far))).first()[0] == state >> 24


def test_sample_of_main_pages_goes_by_their_place(spark, tmp_path):
    from anchorwise.operators import dump

    page = lambda t, ns: f"<page><title>{t}</title><ns>{ns}</ns><revision><text>x</text></revision></page>\n"
    (tmp_path / "x.xml").write_text("<mediawiki>\n" + "".join(page(f"P{k}", 0) + page(f"File:{k}.png", 6) for k in range(15)) + "</mediawiki>\n")
    counts = jobs.dump_job(spark, str(tmp_path / "x.xml"), str(tmp_path / "o"), str(tmp_path / "m"), sample_percent=20)
    assert counts["main-page"] == 1 and counts["file-page"] == 15  # one of the first fifteen
    assert open(tmp_path / "o" / "part-000.txt").read().startswith("P7\t")
    rows = spark.range(1000).select(F.col("id").alias("ordinal"), F.lit("main").alias("page_type"))
    assert dump.drawn_sample(rows, 1, F.lit(True)).count() == 1000 and dump.drawn_sample(rows, 0, F.lit(True)).count() == 0
    assert 150 < dump.drawn_sample(rows, 0.2, F.lit(True)).count() < 250 and dump.drawn_sample(rows.limit(0), 0.2, F.lit(True)).count() == 0
    with pytest.raises(ValueError, match="share"):
        dump.drawn_sample(rows, 2, F.lit(True))


def test_range_numbers(spark):
    from anchorwise.operators import dump

    for n in (0, 1, 2, 5, 17, 100):
        cuts = [3 * i for i in range(n)]
        got = spark.range(-2, 3 * n + 3).select("id", dump.range_number(F.col("id"), cuts).alias("k")).collect()
        assert all(r.k == sum(c <= r.id for c in cuts) for r in got)


def test_nth_least(spark):
    from anchorwise.operators.dump import nth_least

    values = [-(1 << 63), (1 << 63) - 1, 0, 5, 5, 5, 7, 1 << 50, -3] + [i * 1_000_003 for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    assert [nth_least(df, "v", n) for n in (1, 2, 3, 6, 100, len(values), len(values) + 1)] == [*(sorted(values)[n - 1] for n in (1, 2, 3, 6, 100, len(values))), None]


def test_category_graph_and_redirect_map(spark, tmp_path):
    (tmp_path / "categories.txt").write_text("Quince pies\t\nBakers of the north (coast)\tBakers by region|Northern cooks\na\tb\tc\n")
    assert jobs.category_graph_job(spark, str(tmp_path / "categories.txt"), str(tmp_path / "g")) == 4
    g = readers.graph(spark, str(tmp_path / "g"))
    assert g.filter("name like 'Quince%'").first().parents == []
    sinks.graph(g, str(tmp_path / "g2"))
    assert same_graph(g, readers.graph(spark, str(tmp_path / "g2")))
    (tmp_path / "r.txt").mkdir()
    (tmp_path / "r.txt" / "part-1").write_text("a\ty\n" + "b\tq\n" * 500)  # larger, so that it is dealt first
    (tmp_path / "r.txt" / "part-0").write_text("a\tx\na\ty\nbad\nb\tz\n")
    assert jobs.redirect_map_job(spark, str(tmp_path / "r.txt"), str(tmp_path / "m")) == 2
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {("a", "x"), ("b", "z")}


def test_plan_of_pairs_has_no_exchange_and_no_python(spark):
    from anchorwise.plans import registry

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("url AS article_name", "html")
    plan = jobs.explained(link_terms.terms_of_html(pages, 10, parse="native"))
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<url:string,html:string>" in plan
    plan = jobs.explained(link_terms.terms_of_html(pages, 10)).partition("\n\n\n")[0]
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1  # for pages that want a parser
    plan = jobs.explained(registry.queries()["tfidf_top20_lineitem"](spark, "/root/testdata/sf0.001"))
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_scores_read_their_input_once(spark):
    from anchorwise.plans import registry

    for name in ("tfidf_top20", "flagship_link_terms_top20", "term_document_frequency"):
        df = registry.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        final = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").partition("Initial Plan")[0]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_arguments():
    a = parser().parse_args(["generate", "--inputdir", "i", "--workingdir", "w"])
    assert a.maxdistance == 100 and a.job == "generate"


def test_rejected_lines(spark):
    rows = spark.createDataFrame([("a\tb\tc",), ("a\tYg==",), ("",)], "line string")
    assert {r.line for r in readers.rejected_lines(rows).collect()} == {"a\tb\tc", ""}
    assert rows.select(F.count("*")).first()[0] == 3


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """One split holds all rows, others none, as a row group is not cut."""
    from anchorwise.functions.shared import spread

    spark.range(20000).selectExpr("id", "string(hash(id)) AS t").coalesce(1).write.parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = spark.read.parquet(str(tmp_path / "t"))
        assert df.rdd.getNumPartitions() >= 4 and max(df.rdd.glom().map(len).collect()) == 20000
        assert max(spread(df).rdd.glom().map(len).collect()) < 5000 and spread(df).distinct().count() == 20000
        assert spread(df.filter("id < 0")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
