import collections
import hashlib
import random

import numpy as np
import pytest

from anchorwise.llm import common, exact_dedup, minhash, suffix_dedup
from anchorwise.llm.suffix_array import permuted_lcp, suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 255])
def test_suffix_array_and_common_prefixes(letters):
    rng = random.Random(letters)
    for _ in range(150):
        s = bytes(rng.randint(0, letters - 1 if letters < 255 else 255) for _ in range(rng.randint(0, 60))) * rng.randint(1, 3)
        t = np.frombuffer(s, np.uint8)
        sa = suffix_array(t)
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert sa.tolist() == want
        size, phi = permuted_lcp(t, sa)
        for a, b in zip(want, want[1:]):
            n = 0
            while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert size[b] == n and phi[b] == a


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(hash(b[i : i + length]) for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passage = [" ".join(word() for _ in range(30)) for _ in range(3)]
    texts = [None, "", "short", "ab" * 150, "z" * 300, " ".join(word() for _ in range(3000))]
    for _ in range(40):
        texts.append(" ".join([" ".join(word() for _ in range(rng.randint(0, 60))), rng.choice(passage), word(), rng.choice(passage)[rng.randint(0, 20) :]]))
    return texts + texts[6:9]


@pytest.mark.parametrize(("hot", "shard"), [(20_000, 2_000_000), (2, 2_000_000), (20_000, 500)])
def test_removed_bytes_against_brute_force(spark, hot, shard):
    texts = corpus(7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=80, hot=hot, shard_bytes=shard).collect()
    assert sorted((r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == brute(texts, 80)
    assert all(sum(s.past - s.first for s in r.spans) == r.n_removed for r in got)


def test_periodic_and_very_long_texts_against_brute_force(spark):
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    part = noise(700)
    texts = ["x" * 900, "y" * 401, "y" * 400, "ab" * 500, "ba" * 450 + noise(50), part * 3, noise(300) + part, "q" * 700 + part[:399], " " * 500 + noise(10) + " " * 450]
    texts += [noise(1_100_000) + part + noise(1_500_000), noise(2_200_000) + " " * 1000 + part]  # stretches of their own
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == brute(texts, 400)


def test_a_long_run_of_one_byte_takes_seconds():
    t = np.full(5_000_000, 32, np.uint8)
    assert suffix_array(t)[:3].tolist() == [4_999_999, 4_999_998, 4_999_997]
    two = np.concatenate([t, [33], t[:-1], [31]]).astype(np.uint8)
    size, _ = permuted_lcp(two, suffix_array(two))
    assert size.max() == 4_999_999


def test_query_against_brute_force_over_a_whole_table(spark):
    from anchorwise.llm.queries import op1_suffix_array_dedup

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    got = op1_suffix_array_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted((n, m, hashlib.sha256(x).hexdigest()) for n, m, x in brute([d.text for d in docs], 400))
    assert {r.doc_id: r.n_bytes for r in got} == {d.doc_id: len((d.text or "").encode()) for d in docs}


def test_clean_documents_keep_their_columns(spark):
    rows = [(1, "é" * 100, "a", 100, 5), (2, "é" * 100, None, 100, 6), (None, None, "b", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid string, n_chars long, kept long")
    got = suffix_dedup.without_repeats(docs, length=120)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "", "a", 0, 5), (2, "", None, 0, 6), (None, "", "b", 0, 7)], key=str)
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("files", [1, 3])
def test_row_keys_do_not_follow_splits(spark, tmp_path, files):
    at, setting = str(tmp_path / "rows"), "spark.sql.files.minPartitionNum"
    spark.range(4000).selectExpr("id as doc_id", "concat(id, ' ', sha2(string(id), 512)) as text").coalesce(1).repartition(files).write.option("parquet.block.size", 4096).parquet(at)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        seen, splits = [], []
        df = common.with_uid(spark.read.parquet(at).filter("doc_id <> 7"))
        for n in ("6", "4"):
            spark.conf.set(setting, n)
            again = df.select("*")
            splits.append(again.rdd.getNumPartitions())
            seen.append({r.doc_id: r.uid for r in again.collect()})
        assert splits[0] != splits[1]
        assert seen[0] == seen[1] and len(set(seen[0].values())) == 3999
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_row_keys_where_paths_clash_and_of_other_input(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS doc_id", "cast(id % 7 AS string) AS text", "id AS path").repartition(5).write.parquet(at)
    rows = spark.read.parquet(at)
    monkeypatch.setattr(common, "_file_salt", lambda df, place: None)  # as if all salts clashed
    keys = lambda df: {r.doc_id: r.uid for r in common.with_uid(df).collect()}
    first = keys(rows)
    assert len(set(first.values())) == 100 and first == keys(rows.filter("doc_id >= 0")) and common.with_uid(rows).columns == ["doc_id", "text", "path", "uid"]
    assert exact_dedup.drop_copies(rows).count() == 7
    # Rows that come out of a shuffle: numbered once, so that both passes mean the same ones.
    shuffled = rows.repartition(3).select("doc_id", "text")
    once = common.settled(shuffled)
    assert keys(once) == keys(once) and common.settled(rows) is rows
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(shuffled).collect()) == list(range(93, 100))
    assert sorted(r.doc_id for r in minhash.drop_near_copies(shuffled).collect()) == list(range(7))


def test_planted_passages_of_400_bytes_go_and_shorter_ones_stay(spark):
    rng = random.Random(40)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    plant = {size: [words(200)[:size] for _ in range(6)] for size in (300, 399, 400, 401, 700)}
    docs, holds = [], {}
    for size, passages in plant.items():
        for passage in passages:
            for mark in "ABCD"[: rng.randrange(2, 5)]:  # another letter on both sides of each copy, so that no more than the passage is shared
                holds[len(docs)] = size
                docs.append((len(docs), f"{words(rng.randrange(40, 90))}{mark}{passage}{mark}{words(rng.randrange(40, 90))}"))
    docs += [(len(docs) + i, words(200)) for i in range(20)]  # clean ones
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs:
        size = holds.get(i, 0)
        removed = size if size >= 400 else 0
        assert (got[i].n_removed, len(got[i].spans), got[i].n_bytes) == (removed, int(removed > 0), len(text.encode()))
