import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorwise.llm import common, exact_dedup, minhash

ROWS = [(1, "Same Text"), (7, "same text"), (3, "SAME TEXT"), (3, "SAME TEXT"), (4, None), (5, ""), (None, "É x"), (9, "é x"), (None, "lone"), (2, "x" * 50_000)]


def exact(spark, df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=str)


def test_exact_copies(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    want = [(1, 7, 4, False), (7, 7, 4, True), (3, 7, 4, False), (3, 7, 4, False), (4, 5, 2, False), (5, 5, 2, True), (None, None, 1, True), (9, 9, 1, True), (None, None, 1, True), (2, 2, 1, True)]
    assert exact(spark, df) == sorted(want, key=str) == exact(spark, df.withColumn("uid", F.lit("x")).withColumn("digest", F.lit(1)))
    twice = spark.createDataFrame([(1, "a"), (1, "a")], "doc_id long, text string")
    assert [r[3] for r in exact(spark, twice)].count(True) == 1
    assert exact(spark, df.limit(0)) == []
    left = exact_dedup.drop_copies(df.withColumn("uid", F.lit(1)).withColumn("_UID", F.lit(2)))
    assert left.columns == ["doc_id", "text", "uid", "_UID"] and [(r[2], r[3]) for r in left.collect()] == [(1, 2)] * 6


def test_history_and_new_rows(spark):
    old = exact_dedup.digests(spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string"))
    new = exact_dedup.digests(spark.createDataFrame([(10, "a"), (11, "c"), (12, "C")], "doc_id long, text string"))
    got = {r.doc_id: (r.member, r.keep_id, r.group_size) for r in exact_dedup.deduplicate(new, exact_dedup.history(old)).collect()}
    assert got == {10: (True, 2, 2), 11: (False, 12, 2), 12: (False, 12, 2)}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = common.mixed(np.arange(n, dtype=np.uint64))
    mph = exact_dedup.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(n))
    assert sum(len(b) for b in mph.bits) <= 5 * n + 64 * 48
    other = mph.slots(common.mixed(np.arange(10**9, 10**9 + 100, dtype=np.uint64)))
    assert ((other >= -1) & (other < max(n, 1))).all()
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(np.zeros(2, np.uint64))


def test_shards_and_salts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LOOKUP_ROWS", 20)
    rows = [(i, f"t{i % 37 if i % 3 else 0}") for i in range(300)]
    got = exact(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert got == sorted(((i, max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows), key=str)


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    comp = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        n = len(sets[a][1] & sets[b][1])
        if n and 100 * n >= 85 * len(sets[a][1] | sets[b][1]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    least = {c: min(sets[k][0] for k in range(len(sets)) if comp[k] == c) for c in comp}
    return sorted((i, len(s), least[comp[k]], i == least[comp[k]]) for k, (i, s) in enumerate(sets))


def near(df, **options):
    return sorted(tuple(r) for r in minhash.near_duplicates(df, **options).select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("block", [2048, 7])
def test_components_against_brute_force(spark, block):
    rng = random.Random(block)
    base = [[f"w{rng.randint(0, 10**6)}" for _ in range(60)] for _ in range(3)]
    rows = [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  B"), (1004, " "), (1005, "one two three four five"), (1006, "ONE two\tthree\nfour five"), (1007, "word " * 5000)]
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 30)}"
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("rep", F.lit("clash"))
    assert near(df, block=block) == brute(rows)


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, ""), (3, "solo")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 1), (None, None), (3, 3)], key=str)
    left = minhash.drop_near_copies(df.withColumn("uid", F.lit("u")))
    assert left.columns == ["doc_id", "text", "uid"] and [r.uid for r in left.collect()] == ["u"] * 3
    assert near(df.limit(0)) == [] and minhash.drop_near_copies(df.limit(0)).count() == 0


def test_very_long_texts(spark):
    text = " ".join(f"w{i}" for i in range(3_000_000))  # over 20 MB
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, "lone words only here now")], "doc_id long, text string").repartition(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {1: (2_999_996, 1), 2: (2_999_997, 1), 3: (1, 3)}
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(df.union(df.filter("doc_id = 2").selectExpr("9L", "upper(text)"))).select("doc_id").collect()) == [1, 3, 9]


def test_long_chains_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (5, 5)], "a long, b long")
    got = {(r.node, r.comp) for r in minhash.components(links).collect()}
    assert got == {(i, 0) for i in range(101)} | {(200, 200), (201, 200)}
