import pytest
from pyspark.sql import functions as F

from anchorwise.functions import wikitext as W
from anchorwise.operators import dump

REDIRECTS = {
    "#REDIRECT [[Quince tart]]": "Quince_tart",
    "#redirect [[Quince tart]]": "Quince_tart",
    "#REDIRECT:[[The mill (part 2)]]": "The_mill_(part_2)",
    "#REDIRECT: [[North gate]]": "North_gate",
    "#REDIRECT\n\n[[Old bridge]]": "Old_bridge",
    "\n\n#REDIRECT: [[Ünal F.Ş.]]": "Ünal_F.Ş.",
    "#redirect : [[Who Saw My Cat]]": "Who_Saw_My_Cat",
    "#redirect [[Pond# Fish]]": "Pond",
    "no directive": None,
}
# Names that must count as disambiguation.
NAMES = "disambiguation Disambiguation disambig Dab DAB Disamb Numberdis Letter-NumberCombDisambig Hndis Hndis-cleanup Geodis Disambig-Rivers Mil-unit-dis".split()
DISAMBIGUATION = [*(f"{{{{{n}}}}}" for n in NAMES), *(f"see {{{{ {n} |x|y}}}} too" for n in NAMES), "{{Disambiguation cleanup}}", "{{River disambiguation}}"]
OTHER = ["{{disambiguation wanted|since=1999}}", "disambiguation", "{{disambiguation|a\nb}}", ""]


def test_redirect_targets(spark):
    df = spark.createDataFrame([(k,) for k in REDIRECTS], "t string").select("t", W.redirect_target(F.col("t")).alias("r"))
    assert {r.t: r.r for r in df.collect()} == REDIRECTS


def test_parents_are_distinct_and_without_sort_keys(spark):
    text = "[[Category:Old stone bridges]]\t[[category:Water mills|x]] [[Category:Water mills]]"
    got = spark.createDataFrame([(text,), ("",)], "t string").select(W.parent_categories(F.col("t"))).collect()
    assert [r[0] for r in got] == [["Old_stone_bridges", "Water_mills"], []]


def test_disambiguation(spark):
    df = spark.createDataFrame([(t,) for t in DISAMBIGUATION + OTHER], "t string").select("t", W.is_disambiguation(F.col("t")).alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert all(got[t] for t in DISAMBIGUATION) and not any(got[t] for t in OTHER)


def test_article_line_is_one_line_and_comes_back(spark):
    body = "long body, " * 40 + "ü\n\t|"
    df = spark.createDataFrame([("a\tb\nc", body), ("d", "")], "t string, b string").select(W.article_line(F.col("t"), F.col("b")).alias("line"))
    lines = [r.line for r in df.collect()]
    assert all("\n" not in x and "\r" not in x for x in lines)
    from anchorwise.sources.readers import parse_articles

    assert [tuple(r) for r in parse_articles(df).collect()] == [("a b c", body), ("d", "")]
    with pytest.raises(Exception, match="not two fields"):
        parse_articles(df, strict=True).collect()


PAGES = [
    ("Category:A b", 14, False, "[[Category:Top]]", "category"), ("Category:Bare", 14, False, "", "category"), ("A", 14, False, "[[Category:Top]]", "category-invalid"), ("File:x", 6, False, "", "file"),
    ("Template:x", 10, True, "", "template"), ("Project:x", 4, False, "", "project"), ("Module:x", 828, False, "", "module"), ("User:x", 2, False, "", "unknown"), ("null space", None, False, "", "unknown"),
    ("From", 0, True, "#REDIRECT [[To it]]", "redirect"), ("Bad", 0, True, "nothing", "redirect-invalid"), ("M (disambiguation)", 0, False, "", "disambiguation"), ("N", 0, False, "{{hndis}}", "disambiguation"), ("Plain", 0, False, "text", "main"), ("Empty", 0, False, "", "main"),
]


def pages(spark, rows=PAGES):
    return dump.routed(spark.createDataFrame([(*r[:4], i) for i, r in enumerate(rows)], "title string, ns int, is_redirect boolean, text string, ordinal long"))


def test_router_takes_the_first_type_that_applies(spark):
    assert [r.page_type for r in pages(spark).orderBy("ordinal").collect()] == [r[4] for r in PAGES]
    counts = {r.counter: r.value for r in dump.page_counters(pages(spark)).collect()}
    assert counts["main-page"] == 2 and counts["category-valid-page"] == 2 and counts["other-page"] == 0 and len(counts) == 13 and counts["disambiguation-page"] == 2


def test_side_tables(spark):
    p = pages(spark, [*PAGES, ("From", 0, True, "#redirect [[Later]]", ""), ("Category:A b", 14, False, "[[Category:New]]", "")])
    assert [tuple(r) for r in dump.redirects(p).collect()] == [("From", "Later")]
    assert [tuple(r) for r in dump.categories(p).collect()] == [("A_b", ["New"])]
    assert {r.title for r in dump.disambiguations(p).collect()} == {"M_(disambiguation)", "N"}


def test_first_redirect_counts_in_the_map(spark):
    rows = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "z", 3)], "from_title string, to_title string, ordinal long")
    m = dump.redirect_map(rows)
    assert {tuple(r) for r in m.collect()} == {("a", "y"), ("b", "z")}
    terms = spark.createDataFrame([("t", "a"), ("t", "q")], "term string, article_ref string")
    assert {tuple(r) for r in dump.resolve(terms, m).collect()} == {("t", "y"), ("t", "q")}


@pytest.mark.parametrize("limit", [0, 1, 3, 100])
def test_page_limit_is_a_prefix(spark, limit):
    kinds = [i % 3 == 0 for i in range(40)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "ordinal long, k boolean").repartition(3)
    want, n = [], 0
    for i, k in enumerate(kinds):
        if n >= limit:
            break
        want.append(i)
        n += k
    assert sorted(r.ordinal for r in dump.page_limit(df, limit, F.col("k")).collect()) == want


def test_hash_sample(spark):
    df = spark.range(10_000).withColumn("k", F.col("id").cast("string"))
    a = {r.k for r in dump.hash_sample(df, 0.2, "k").collect()}
    assert a == {r.k for r in dump.hash_sample(df.repartition(7), 0.2, "k").collect()} and 1800 < len(a) < 2200
    assert dump.hash_sample(df, 1, "k").count() == 10_000 and dump.hash_sample(df, 0, "k").count() == 0
