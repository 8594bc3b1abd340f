"""Operators 11 to 13: filter audit, quality rules, hard negatives, against plain versions and SQL."""

import collections
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorwise.llm import filter_audit, hard_negatives, quality, queries

D = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
OPS = ["op11_filter_audit", "op12_quality_rules", "op13_hard_negatives"]


def rows(df):
    return collections.Counter(df[sorted(df.columns)].astype(str).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", OPS)
def test_query_and_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    got, want = queries.queries()[name](spark, D).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) and rows(got) == rows(want)


# ---- 11 ----


def audited(docs, labels):
    """The contract, one document after the other."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failed = []
    for i, text, lang in docs:
        text = text or ""
        words = WORDS.findall(text)
        own = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and least[text] < i}
        failed.append((lang or "", {k for k, v in own.items() if v}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in failed}:
        mine, total = [f[1:] for f in failed if f[0] == part], collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for k, x in enumerate(order):
                gone = [f for f in left if x in f[0]]
                left = [f for f in left if x not in f[0]]
                fails = sum(x in f[0] for f in mine)
                out[part, order, k + 1] = [len(left), len(gone), fails - len(gone), sum(f[0] == {x} for f in mine), sum(f[1] for f in gone), sum(f[2] for f in gone)]
                total[x] += len(gone)
        for key in out:
            if key[0] == part:
                out[key].append(total[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


LONG = " ".join(f"word{i % 90}" for i in range(300_000))
TEXTS = [None, "", " \t\n", "a b c", "THE END", "50 % off", " ".join(f"w{i}" for i in range(250)), " ".join("same" for _ in range(300)), "a b ÄÖÜ", LONG]


def audit_rows(seed):
    rng = random.Random(seed)
    ids = [*range(1, 60), 7, 7, None, None]  # repeated and missing
    return [(i, rng.choice(TEXTS), rng.choice([None, "", "de", "en"])) for i in ids] + [(7, "a b c", "de"), (7, "a b c", "en"), (7, "a b c", "en")]


@pytest.mark.parametrize("seed", range(3))
def test_audit_against_one_by_one(spark, seed):
    docs, rng = audit_rows(seed), random.Random(seed + 9)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 50), 3, 3, 3, None]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("mask", "digest", "n", "id", "part", "cells")})
    got = filter_audit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit("x")))
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in got.collect()} == audited(docs, labels)
    assert got.count() == 600 * len({d[2] or "" for d in docs}) and dict(got.dtypes)["step"] == "int"


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(1, None, None)], docs.schema), labels).filter("step = 1 and filter = 'A'").first()
    assert (one.part, one.removed, one.kept, one.unique_fails, one.shapley) == ("", 1, 0, 1, 120)


# ---- 12 ----


def measured(text):
    text = text or ""
    words, lines = WORDS.findall(text), [x for x in text.split("\n") if WORDS.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def quality_texts():
    rng = random.Random(5)
    words = ["der", "Hund", "läuft", "x#", "|", "OK", "𝒳y", "9"]
    out = [None, "", " ", "\n\n", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "a " * 40, "\x0b\x0ca b\r\n a b\r\n", " x", "x ", "q\nq\n q\nq"]
    for _ in range(150):
        piece = [rng.choice(words[: rng.randrange(2, 9)]) for _ in range(rng.randrange(1, 60))]
        out.append(rng.choice(["", " ", "\n"]) + rng.choice([" ", "\n", "\t \n"]).join(piece + piece[: rng.randrange(0, 20)]) + rng.choice(["", " "]))
    return [*out, LONG]


def test_measurements_one_by_one(spark):
    texts = quality_texts()
    frame = spark.createDataFrame([*enumerate(texts), (0, texts[6]), (None, texts[6])], "doc_id long, text string").withColumns({"N_WORDS": F.lit(-1), "fail_bits": F.lit("x"), "mine": F.lit(2)})
    out = quality.ledger(frame)
    assert sorted(out.columns) == sorted(["doc_id", "mine", "fail_bits", *quality.MEASURED])
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == collections.Counter((i, *measured(t)) for i, t in [*enumerate(texts), (0, texts[6]), (None, texts[6])])
    base = {r.doc_id for r in out.filter(quality.rejected(1)).collect()}
    assert {i for i, t in enumerate(texts) if (m := measured(t))[0] < 20 or 100 * m[4] > 30 * m[0]} | {None} == base
    assert not out.filter(quality.rejected(1) & ~quality.rejected(3)).count()


def test_policies_and_ablations(spark):
    rng = random.Random(1)
    bits = [(i, rng.choice("ab"), rng.randrange(1 << len(quality.RULES))) for i in range(500)]
    frame = spark.createDataFrame(bits, "doc_id long, source string, fail_bits long")
    for version, rules in quality.POLICIES.items():
        full = quality.mask(version)
        assert bin(full).count("1") == len(rules) and quality.mask(1) & full == quality.mask(1)
        assert frame.filter(quality.rejected(version)).count() == sum(b & full != 0 for *_, b in bits)
        for r in quality.ablations(frame, version, "source").collect():
            mine, own = [b & full for _, s, b in bits if s == r.part], quality.bit(r.rule)
            assert (r.fails, r.alone, r.rejected, r.rejected_without) == (sum(b & own > 0 for b in mine), sum(b == own for b in mine), sum(b > 0 for b in mine), sum(b & ~own > 0 for b in mine))
    assert {(r.rejected_old, r.rejected_new): r.n for r in quality.compare(frame, 1, 3).collect()} == collections.Counter((b & quality.mask(1) > 0, b & quality.mask(3) > 0) for *_, b in bits)
    assert quality.ablations(frame.limit(0)).count() == 0


def test_ledger_is_native_and_fits_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ledger = quality.ledger(docs)
    plan = ledger._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    judged = ledger.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("n_words >= 20").groupBy("quality").agg(F.avg(quality.rejected().cast("int")).alias("gone")).collect()
    gone = {r.quality: r.gone for r in judged}
    assert gone[1] < 0.01 and gone[0] > 0.95


# ---- 13 ----


def mined(points, anchor, k=5):
    """All pairs, by hand."""
    pts = sorted({(i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, y in points if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a in pts:
        if not anchor(a[0]):
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], p[2])), p[0], p[1]) for p in pts if p[0] != a[0]]  # zip: shorter ones end in zeros
        for s, i, _ in sorted(p for p in scored if p[2] == a[1])[:k]:
            near = sorted(p for p in scored if p[2] != a[1] and 80 * -s <= 100 * -p[0] <= 100 * -s)[:k]
            out += [(a[0], i, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(near)]
    return collections.Counter(out)


def vectors(kind, n, rng):
    if kind == "clusters":
        centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
        return [[c + rng.gauss(0, 0.15) for c in rng.choice(centers)] for _ in range(n)]
    if kind == "copies":
        return [rng.choice([[0.5, 0.5, 0.0, 0.1], [0.5, 0.4, 0.0, 0.1], [rng.random() for _ in range(4)]]) for _ in range(n)]
    return [[rng.gauss(0, 0.3) for _ in range(rng.choice([0, 3, 8]))] for _ in range(n)]


@pytest.mark.parametrize("kind", ["clusters", "copies", "lengths"])
def test_negatives_against_all_pairs(spark, kind):
    rng = random.Random(len(kind))
    points = [(i, v, rng.randrange(3)) for i, v in enumerate(vectors(kind, 700, rng))]
    points += [points[3], (20, points[3][1], 1), (None, [1.0, 1.0], 1), (701, None, 1), (702, [1.0, None], 1), (703, [float("nan"), 1.0], 0), (704, [float("inf")], 0), (705, [0.5, 0.5], None)]
    frame = spark.createDataFrame(points, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("v", "norm2", "shard", "anchor_id", "twin")})
    got = hard_negatives.mine(frame, F.col("label"), F.col("vec_id") % 20 == 0, shard=60, leaf=8)
    assert collections.Counter(tuple(r) for r in got.collect()) == mined(points, lambda i: i % 20 == 0)


def test_negatives_of_little(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty, F.col("label"), F.col("vec_id") % 2 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0] * 5000, 0), (1, [1.0] * 5000, 0), (2, [0.9] * 5000, 1), (4, [], 1)], empty.schema)  # very long ones
    assert [tuple(r) for r in hard_negatives.mine(two, F.col("label"), F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2, 5000 * 256 * 256, 5000 * 256 * 230)]
    huge = spark.createDataFrame([(0, [1e30], 0)], empty.schema)
    with pytest.raises(ValueError, match="too large"):
        hard_negatives.mine(huge, F.col("label"), F.col("vec_id") == 0)


def test_walk_leaves_out_what_is_too_far():
    """With clusters, most leaves are never looked at."""
    rng = np.random.default_rng(0)
    v = np.floor(256 * np.concatenate([rng.normal(c, 0.02, (500, 16)) for c in rng.normal(0, 1, (20, 16))]))
    most2 = float((v * v).sum(1).max())
    tree = hard_negatives.Tree(hard_negatives.augmented(v, most2), 64)
    low, high = hard_negatives.leaf_bounds(*tree.arrays(), len(tree.leaves), hard_negatives.augmented_anchors(v[:40]), most2)
    d = np.sqrt((v[:40] ** 2).sum(1)[:, None] + most2 - 2 * v[:40] @ v.T)
    for leaf, members in enumerate(tree.leaves):
        assert (low[:, leaf] <= d[:, members].min(1)).all() and (high[:, leaf] >= d[:, members].max(1)).all()
    nearest = np.sort(d, 1)[:, 10]
    assert (low <= nearest[:, None]).mean() < 0.5 and sorted(np.concatenate(tree.leaves)) == list(range(len(v)))


def test_search_sends_no_side_through_the_driver(spark):
    """Whatever size the optimizer takes shards and blocks for."""
    shards, asked = spark.createDataFrame([], hard_negatives.SHARD_ROW), spark.range(1).selectExpr("id AS shard", "CAST('x' AS binary) AS anchors")
    for same in (True, False):
        plan = hard_negatives.search(shards.union(spark.range(1).selectExpr("id", "binary('')", "binary('')", "binary('')", "binary('')", "binary('')", "1")), asked, 1.0, 5, same)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
