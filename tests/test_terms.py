import math
import random

import pytest
from pyspark.sql import functions as F

from anchorwise.functions import scoring, templates
from anchorwise.functions import terms as T
from anchorwise.functions.element_path import ElementPath
from anchorwise.functions.render import render
from anchorwise.operators import link_terms, tfidf


def page(spark, html, **options):
    df = spark.createDataFrame([("p", html)], "article_name string, html string")
    return link_terms.page_terms(df, **options).first()


@pytest.mark.parametrize("tokenizer", ["break", "pattern"])
def test_terms_and_links_in_order(spark, tokenizer):
    html = '<html><head><title>The Title</title></head><body><p>One two <a href="/Big_City#x">Big City</a> three<b>bold</b>. <a href="http://x.org/">Out Side</a><!-- no --> end<a href="/File:x">f</a><a href="/bad%zz">b</a><a href="/E%C3%A9">9</a> last</body></html>'
    r = page(spark, html, tokenizer=tokenizer)
    assert r.terms == ["the title", "one", "two", "big city", "threebold", "out side", "end", "f", "b", "last"]
    assert [(x.ref, x.pos) for x in r.links] == [("Big_City", 3), ("Eé", 9)]


def test_block_tags_break_words_only_where_they_open(spark):
    assert page(spark, "a<p>b</p>c<br>d<i>e</i>").terms == ["a", "bc", "de"]
    assert page(spark, None).terms == [] and page(spark, "").links == []


def test_scripts_can_be_dropped(spark):
    html = "<script>var x;</script>word"
    assert page(spark, html).terms == ["var", "x", "word"] and page(spark, html, drop_script=True).terms == ["word"]


def test_window_takes_the_lower_end_and_not_the_upper(spark):
    df = spark.createDataFrame([("p", ["a", "b", "c", "d", "e", "f"], [("X", 3), ("Y", 0), ("Z", 6)])], "article_name string, terms array<string>, links array<struct<ref:string,pos:int>>")
    got = [(r.article_ref, r.term, r.term_distance) for r in link_terms.proximity_pairs(df, 2).collect()]
    assert got == [("X", "b", -2), ("X", "c", -1), ("X", "d", 0), ("X", "e", 1), ("Y", "a", 0), ("Y", "b", 1), ("Z", "e", -2), ("Z", "f", -1)]
    assert link_terms.proximity_pairs(df, 0).count() == 0
    with pytest.raises(ValueError):
        link_terms.proximity_pairs(df, -1)


def test_normalised_terms(spark):
    df = spark.createDataFrame([(x,) for x in ["U.S.A.", "rock'n'roll", '"Quoted,"', "9lives", "(x)", "", "Éa b"]], "t string")
    assert [r[0] for r in df.select(T.normalize(F.col("t"))).collect()] == ["u.s.a", "rock'n'roll", "quoted", "9lives", "x", "", "éa b"]
    phrases = {" New\tYork \n": "new\tyork", "( foo )": " foo ", "\u3000a\u2028": "a", "\xa0a": "\xa0a", "...": "", "[The City], (old)": "the city], (old"}
    df = spark.createDataFrame([(x,) for x in phrases], "t string").select("t", T.normalize_phrase(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == phrases
    letters = {" foo ": False, "a": True, "É": True, "𝒳": False, "9": False, "": False, "_a": False, "ª": True}
    assert {r.t: r.a for r in spark.createDataFrame([(x,) for x in letters], "t string").select("t", T.accepted(F.col("t")).alias("a")).collect()} == letters
    assert df.limit(1).select(T.words(F.lit("A  b\t9c d. [e"), "space")).first()[0] == ["A", "b", "d."]


def test_weights(spark):
    df = spark.createDataFrame([(d,) for d in (-20, 0, 9, 50)], "d int")
    assert [r[0] for r in df.select(scoring.distance_weight(F.col("d"))).collect()] == [30, 10, 1, 1]
    assert [r[0] for r in df.select(scoring.distance_weight(F.col("d"), "abs")).collect()] == [1, 10, 1, 1]


def test_tfidf_by_hand(spark):
    rows = spark.createDataFrame([("d1", "x", 3), ("d1", "x", 1), ("d1", "y", 12), ("d2", "x", 5), ("d3", "z", 2)], "doc string, term string, weight int")
    idf = lambda df: 1 + math.log(3 / (df + 1))
    want = {("x", "d1"): math.sqrt(4 / 16) * idf(2), ("x", "d2"): idf(2), ("y", "d1"): math.sqrt(12 / 16) * idf(1), ("z", "d3"): idf(1)}
    assert {(r.term, r.doc): pytest.approx(r.tf_idf) for r in tfidf.scores(rows).collect()} == want
    assert [(r.term, r.doc) for r in tfidf.scores(rows, 1).orderBy("term").collect()] == [("x", "d2"), ("y", "d1"), ("z", "d3")]


def test_top_documents_ties_go_by_name(spark):
    rows = spark.createDataFrame([(f"d{i:02}", "t", 1) for i in range(30)], "doc string, term string, weight int")
    assert sorted(r.doc for r in tfidf.scores(rows).collect()) == [f"d{i:02}" for i in range(20)]


def test_document_frequency(spark):
    terms = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y")], "article_name string, term string")
    assert [tuple(r) for r in tfidf.document_frequency(terms).collect()] == [("x", 2, 1.0), ("y", 1, 0.5)]
    assert [r.df for r in tfidf.document_frequency(terms, 4).collect()] == [0.5, 0.25]


def test_rules():
    rules = templates.parse_rules(["", "# no", " a b => ignore # why", "c => alias:a b"])
    assert rules == [("a b", "ignore"), ("c", "alias:a b")]
    with pytest.raises(ValueError):
        templates.parse_rules(["a = b"])
    assert len(templates.default_rules()) == 79


EXPANDED = {
    "dablink|x|y=1|z": " x z, ", "See|A b|C": ' <a href="http://en.wikipedia.org/wiki/A_b">A b</a>  <a href="http://en.wikipedia.org/wiki/C">C</a> ', "CURRENTYEAR": "1900", "formatprice:1|2": "000", "cite book|t=1": "",
    "nope": None, "|": None, "": None, "Infobox person": "", "de icon": "", "film-stub": "", "julia": "", "sep entry|a": "",
}


def test_expansion_in_python_and_native(spark):
    t = templates.Templates()
    assert {k: t.expand(k) for k in EXPANDED} == EXPANDED
    df = spark.createDataFrame([(k,) for k in EXPANDED], "t string").select("t", templates.expand_template(F.col("t")).alias("e"))
    assert {r.t: r.e for r in df.collect()} == EXPANDED
    assert t.expand("main|A b", "text") == " _wikiarticle_A_b "
    assert templates.Templates([("a", "alias:b"), ("b", "alias:a"), ("c", "odd")]).expand("a") is None
    assert templates.Templates([("c", "odd")]).expand("c") == ""


def test_pages_keep_stray_and_open_templates(spark):
    t = templates.Templates()
    assert t.page("a {{cite x|{{main|y}}}}{{portal|P}} {{zzz}} b}} {{open") == "a  P,   b}} {{open"
    assert t.page(None) == ""
    df = spark.createDataFrame([(1, "x {{main|A}}"), (2, "plain"), (3, None)], "i int, h string")
    assert {r.i: r.h for r in df.withColumn("h", templates.expand_templates(F.col("h"))).collect()} == {1: 'x  <a href="http://en.wikipedia.org/wiki/A">A</a> ', 2: "plain", 3: None}
    assert [tuple(r) for r in templates.unknown_templates(spark.createDataFrame([("{{Q|1}} {{q}}",)], "h string"), "h").collect()] == [("q", 2)]


def test_renderer():
    html = render("'''Bold''' [[A b|label]] [[C#d e]] [[File:x.png|thumb|cap]] [[Category:Z]] [http://x.org site]<ref>gone</ref>\n== Head ==\n* item\n\n{|\n! h\n|-\n| a || b\n|}")
    assert '<a href="/A_b">label</a>' in html and '<a href="/C#d_e">C#d e</a>' in html and "cap" in html and "Category" not in html and "gone" not in html
    assert '<a href="http://x.org">site</a>' in html and "<h2>Head</h2>" in html and "<li>item</li>" in html and "<td>b</td>" in html
    assert render(None) == ""


def test_markup_to_terms(spark):
    df = spark.createDataFrame([("T", "Go to [[Big Town|the town]] now {{main|Other}} [[De:X]]")], "article_name string, article_text string")
    got = [(r.term, r.article_ref, r.term_distance) for r in link_terms.terms_of_markup(df, 3).collect()]
    assert got == [("t", "Big_Town", -3), ("go", "Big_Town", -2), ("to", "Big_Town", -1), ("the town", "Big_Town", 0), ("now", "Big_Town", 1), ("other", "Big_Town", 2)]


TARGETS = {
    ' href="/Schindler\'s_List"': "Schindler's_List", " href='/A\"B'": 'A"B', " href=/Bare_Name class=x": "Bare_Name", ' class="c" HREF = "/Up"': "Up", ' href="/O&#x27;Brien"': "O'Brien", ' href="/R&amp;D#x"': "R&D", ' href="/AT%26T"': "AT&T",
    ' data-href="/no"': None, ' href="x"': None, ' href="/a:b"': None, ' href="/%zz"': None, "": None, ' title="t"href="/Close"': "Close", ' href="/S&#39;x"': "S'x", ' href="/Q&quot;"': 'Q"',
}


def test_link_targets(spark):
    import duckdb

    from anchorwise.plans import queries

    df = spark.createDataFrame([(a,) for a in TARGETS], "a string")
    assert {r.a: r.t for r in df.select("a", T.link_target(F.col("a")).alias("t")).collect()} == TARGETS
    con = duckdb.connect()
    for a, want in TARGETS.items():
        if "%zz" not in a:
            assert con.execute(f"SELECT {queries.ref_sql('a')} FROM (SELECT $1::VARCHAR AS a)", [a]).fetchone()[0] == want, a


def test_titles_with_quotes_reach_the_terms(spark):
    df = spark.createDataFrame([("T", "See [[Schindler's List]] and [[O'Brien|him]] or [[R&D]]")], "article_name string, article_text string")
    assert [r.article_ref for r in link_terms.terms_of_markup(df, 1).select("article_ref").distinct().orderBy("article_ref").collect()] == ["O'Brien", "R&D", "Schindler's_List"]


def test_markup_is_read_and_rendered_once(spark, tmp_path):
    from anchorwise.plans import jobs
    from anchorwise.sources import readers

    (tmp_path / "a").write_text("T\tYSB7e21haW58WH19IFtbWV1d\n")
    plan = jobs.explained(link_terms.terms_of_markup(readers.articles(spark, str(tmp_path)), 5)).partition("\n\n\n")[0]
    assert plan.count("Scan text") == 1 and plan.count("ArrowEvalPython") == 1


def test_element_paths():
    p = ElementPath()
    assert p.at("/") and p.within("/") and not p.at("one") and not p.within("/one")
    with pytest.raises(IndexError):
        p.pop()
    p.push("one")
    assert all(p.at(x) and p.within(x) for x in ("/one", "/one/", "one", "one/")) and not p.at("/one/two") and not p.at("/")
    p.push("two")
    assert p.at("two") and p.at("/one/two") and p.within("one") and p.within("/one") and not p.within("/two") and not p.at("one")
    for bad in ("", "xxx//yyy", "//yyy"):
        with pytest.raises(ValueError):
            p.at(bad)
    assert p.pop() == "two" and p.at("/one")


def test_words_of_the_jdk_cut_to_the_pattern(spark):
    """Signs behind numbers, points within, marks, underscores and scripts without blanks; with the JDK's words alone some differ."""
    rng = random.Random(7)
    signs = "ab Z é1 2._&%$,'-\"#@°¢‰²–·\u00ad\u0301\u200d\u093fか漢カก한𝒜"
    texts = ['token = "f0d1804254bb97126dbab880713c87f56cf3d527& b', "a5% b2.5 c1,000", *("".join(rng.choice(signs) for _ in range(rng.randrange(1, 15))) for _ in range(4000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *(T.words(F.col("t"), k).alias(k) for k in ("cut", "pattern", "break")))
    rows = df.collect()
    assert [r.t for r in rows if r.cut != r.pattern] == [] and rows[0]["break"] != rows[0].pattern == ["token", "f0d1804254bb97126dbab880713c87f56cf3d527", "b"]


def test_native_rules_look_names_up_and_keep_their_order(spark):
    rules = [("x .+", "text"), ("a", "constant:1"), ("x y", "constant:2"), ("a", "constant:3"), ("see", "alias:a"), ("no", "alias:none"), ("z.", "articles"), ("zz", "text")]
    t = templates.Templates(rules)
    texts = ["x y|p", "a|q", "A", " see |q", "no", "zz|A b", "zz", "none", "", "|", "x", "a:b|c", None]
    column = templates.expand_template(F.col("t"), rules)
    got = {r.t: r.e for r in spark.createDataFrame([(x,) for x in [*texts, "a\n"]], "t string").select("t", column.alias("e")).collect()}
    assert got == {x: None if x is None else t.expand(x) for x in texts} | {"a\n": "1"}
    plan = spark.range(1).selectExpr("string(id) AS t").select(templates.expand_template(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") < 79 and plan.count("split_part") < 10  # once for all rules
    assert spark.range(1).select(templates.expand_template(F.lit("a"), []).alias("e")).first().e is None


def test_documents_travel_instead_of_their_words(spark):
    from anchorwise.plans import queries as q

    plan = q.whitespace_tokens(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("Generate")
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 1), ("b", "y", 4), (None, "y", 9)], "doc string, term string, weight int").repartition(3, "doc")
    counts = tfidf.counts_by_document(rows)
    assert sorted(tuple(r) for r in counts.collect()) == [("a", "x", 3, 4), ("a", "y", 1, 4), ("b", "y", 4, 4)]
    assert sorted(tfidf.scores_of(counts).collect()) == sorted(tfidf.scores(rows).collect())
