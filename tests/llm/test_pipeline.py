import random

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline

D = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op7_exact_dedup", "op4_warc"])
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, D)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want))


def test_stages_drop_what_is_planted_and_keep_the_rest(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    clean = [text(120) for _ in range(30)]
    base = clean[0].split()
    near = " ".join([*base[:60], "changed", *base[61:]])
    docs = [(i, t) for i, t in enumerate(clean)] + [(100, clean[1].upper()), (101, near), (102, f"{text(50)} {passage} {text(50)}"), (103, f"{text(40)} {passage} {text(60)}"), (104, f"you idiot moron scum {text(20)} idiot"), (105, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = at.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == columns
        at.write.parquet(str(tmp_path / name.replace(" ", "_")))
        at = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        seen[name] = {r.doc_id: r.text for r in at.collect()}
    every = {i for i, _ in docs}
    assert set(seen["toxicity"]) == every - {104}
    assert set(seen["exact dedup"]) == every - {104, 1}
    assert set(seen["minhash near-dedup"]) == every - {104, 1, 101}
    last = seen["suffix-array dedup"]
    assert set(last) == every - {104, 1, 101} and passage not in last[102] and passage not in last[103] and all(last[i] == clean[i] for i in range(2, 30)) and last[105] == ""
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(last)


def test_near_dedup_stage_links_from_a_similarity_of_four_fifths(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(4, 9)))
    sets = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    docs, likeness = [], {}
    for k in range(20):
        base = [word() for _ in range(200)]
        edits = 4 if k % 2 == 0 else 5  # similarities of 0.815 and 0.774
        other = [word() if i % 30 == 20 and i < 20 + 30 * edits else w for i, w in enumerate(base)]
        docs += [(10 * k, base), (10 * k + edits, other)]
        a, b = sets(base), sets(other)
        likeness[10 * k + edits] = len(a & b) / len(a | b)
    rows = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, rows, "").collect()}
    assert {0.8 <= j < 0.85 for i, j in likeness.items() if i % 10 == 4} == {True} and {j < 0.8 for i, j in likeness.items() if i % 10 == 5} == {True}
    assert left == {i for i, _ in docs} - {i for i, j in likeness.items() if j >= 0.8}


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
