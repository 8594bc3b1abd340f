"""The lenient parser, and that it and the native path agree."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anchorwise.functions import html_parser
from anchorwise.operators import link_terms

# html: pieces (text with blanks at its ends cut, href, label)
PAGES = {
    "": [("", None, None)],
    "a<b>b</b> c": [("ab c", None, None)],
    "<a href=/X>open": [("", "/X", "open"), ("", None, None)],
    "x <a href=/X>one <a href=/Y>two</a> z": [("x", "/X", "one "), ("", "/Y", "two"), ("z", None, None)],
    "<a href=/X>in<p>out</p></a> after": [("", "/X", "in"), ("out after", None, None)],
    "<p><a href=/X>in</p>out</a>": [("", "/X", "in"), ("out", None, None)],
    "<b><a href=/X>in</b>out</a>": [("", "/X", "in"), ("out", None, None)],
    "<a href=/X>a<i>b</i><br>c</a>d": [("", "/X", "abc"), ("d", None, None)],
    "<a href=/X />t": [("", "/X", ""), ("t", None, None)],
    "<a>no href</a>": [("", None, "no href"), ("", None, None)],
    "<a href='/X>never closed</a> b": [("", "/X", "never closed"), ("b", None, None)],
    '<a title="1 > 0" href="/X">t</a>': [("", "/X", "t"), ("", None, None)],
    "<a href=/X href=/Y class>t</a>": [("", "/X", "t"), ("", None, None)],
    '<A HREF = "/R&amp;D&#x27;s" =x>t</A >': [("", "/R&D's", "t"), ("", None, None)],
    "<script>if (a<b) '<a href=/X>no</a>' &amp; </scrip></script>w": [("if (a<b) '<a href=/X>no</a>' &amp; </scrip>w", None, None)],
    "<style>p</style><title>A &lt; <b>B</b></title>c": [("", None, "A < <b>B</b>"), ("c", None, None)],
    "lost <title>T</title>kept": [("", None, "T"), ("kept", None, None)],
    "<title>no end <p>text": [("", None, "no end "), ("text", None, None)],
    "1 < 2 <3 <> </> <!x> <?y?> z": [("1 < 2 <3 <>    z", None, None)],
    "a<!-- <a href=/X>t</a> -->b<!-- open": [("ab", None, None)],
    "<li>a<li>b</ul></li></b>c": [("a bc", None, None)],
    "&copy;&eacute;&#233;&#xe9;&#0;&nosuch;&amp &ampx;": [("©ééé�&nosuch;& &ampx;", None, None)],
    "<td>a<td>b<tr>c": [("a b c", None, None)],
    "cut <a href": [("cut", None, None)],
}


@pytest.mark.parametrize("html", PAGES)
def test_pieces(html):
    assert [(t.strip(), h, x) for t, h, x in link_terms.pieces_of(html)] == PAGES[html]


def test_every_start_has_its_end():
    rng = random.Random(3)
    parts = ["<a href=/X>", "</a>", "<p>", "</p>", "<b>", "</b>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<li>", "</ul>", "<title>", "</title>", "<script>", "</script>", "<br>", "x", " y ", "<", "&amp;", "<body>", "</html>", "<head>", "<!--", "-->", "<div/>", "<i", "'", '"', ">"]
    for _ in range(3000):
        open_, seen = [], 0
        for kind, name, _ in html_parser.parse("".join(rng.choice(parts) for _ in range(rng.randrange(40)))):
            if kind == "start":
                assert name != "a" or "a" not in open_
                assert name != "p" or "p" not in open_ or "table" in open_[open_.index("p") :]
                open_.append(name)
            elif kind == "end":
                assert open_.pop() == name
            else:
                seen += bool(name) and not open_ and not name.isspace()
        assert not open_ and not seen


def test_long_pages_take_linear_time():
    import time

    def spent(n):
        begin = time.perf_counter()
        link_terms.pieces_of("<div><b><a href=/X>t<p>u<li>" * n + "<<" * n + "&" * n)
        return time.perf_counter() - begin

    spent(1000)
    assert spent(40_000) < 25 * max(spent(4000), 0.01)


def test_terms_of_torn_pages(spark):
    html = "<title>New York City</title>See <a href=/New_York>New York<a href=/Big_Apple>the Apple</a> soon"
    rows = spark.createDataFrame([("p", html), ("q", None)], "article_name string, html string")
    for parse in ("auto", "lenient"):
        got = {r.article_name: r for r in link_terms.page_terms(rows, parse=parse).collect()}
        assert got["p"].terms == ["new york city", "see", "new york", "the apple", "soon"] and [(x.ref, x.pos) for x in got["p"].links] == [("New_York", 2), ("Big_Apple", 3)]
        assert got["q"].terms == [] == got["q"].links
    assert [r.article_ref for r in link_terms.link_refs(rows).collect()] == ["New_York", "Big_Apple"]
    with pytest.raises(ValueError, match="parse must be"):
        link_terms.page_terms(rows, parse="soup")


def test_pages_that_fail_have_no_pieces(monkeypatch):
    def fails(html):
        if "bad" in html:
            raise RecursionError
        return [("t", None, None)]

    monkeypatch.setattr(link_terms, "pieces_of", fails)
    assert link_terms._parsed(pa.array(["bad", None, "x"])).to_pylist() == [None, None, [{"text": "t", "href": None, "label": None}]]


def agree(spark, rows):
    """How many of the pages are plain, and those whose pieces differ; blanks and the `<` of scripts don't matter."""
    rows = rows.withColumn("plain", link_terms.is_plain(F.col("html")))
    native, lenient = (link_terms.with_pieces(rows, parse=p).withColumnRenamed("pieces", p) for p in ("native", "lenient"))
    words = lambda p: F.struct(F.regexp_replace(F.trim(F.replace(p.text, F.lit("<"), F.lit(" "))), r"\s+", " ").alias("t"), F.when(p.href != "", p.href).alias("h"), p.label.alias("l"))
    both = native.join(lenient, ["k", "plain"]).filter("plain")
    return both.count(), both.filter(F.transform("native", words) != F.transform("lenient", words)).select("k").collect()


def test_native_pieces_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(F.col("page_id").alias("k"), "html")
    n, differ = agree(spark, pages)
    assert n > 0.95 * pages.count() and not differ


def test_native_pieces_of_made_up_pages(spark):
    rng = random.Random(8)
    parts = ["<a href='/X'>", "<a href=\"/Y&amp;Z\" class=c>", "</a>", "<p>", "</p>", "<b>", "</b>", "<br>", "word ", "two words", " ", "&amp;", "&lt;", "&eacute;", "<title>T x</title>", "<script>v='</p>'</script>", "<!-- c -->", "<li>", "<div class='d'>", "</div>", "<", "<td>", "<img src=a>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    pages += ["".join(rng.choice([f"<a href='/X'>{rng.choice(['t', '<b>t</b>u', ''])}</a>", "w ", "<p>", "</p>", "&amp;"]) for _ in range(rng.randrange(1, 14))) for _ in range(500)]
    n, differ = agree(spark, spark.createDataFrame([*enumerate(pages), (-1, None)], "k long, html string"))
    assert n > 1000 and [pages[r.k] for r in differ] == []


def test_table_function_of_sql(spark):
    from anchorwise.operators import link_terms_sql

    html = "<title> Big City, </title>One (two) <a href=/New_York>New  York<a href='/b%zz'>x</a><a href='/a+b#c'>\u3000Y\u2028</a> <a href=/c:d>9</a> 𝒳 rock'n'roll"
    rows = spark.createDataFrame([("p", html), ("q", None), ("r", "")], "article_name string, html string")
    link_terms_sql.register(spark)
    got = spark.sql("SELECT article_name, t.* FROM {rows}, LATERAL link_terms(html, 3) AS t", rows=rows)
    want = link_terms.terms_of_html(rows, 3, tokenizer="pattern")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 5
    assert [r.article_ref for r in want.select("article_ref").distinct().orderBy("article_ref").collect()] == ["New_York", "a b"]
    with pytest.raises(Exception, match="distance must be"):
        spark.sql("SELECT t.* FROM {rows}, LATERAL link_terms(html, -1) AS t", rows=rows).collect()
