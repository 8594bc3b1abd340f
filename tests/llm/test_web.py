import collections
import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorwise.llm import common, quotes, url_filter, warc
from anchorwise.llm.queries import RULES

URLS = {
    "http://A.Example.NET/en/x": ("a.example.net", "/en/x", "example.net/en/", "allow"), "https://example.net/fr/": ("example.net", "/fr/", "net/", "block"), "https://badexample.com/de/": ("badexample.com", "/de/", None, None),
    "https://x.example.com/de/1?q=/de/": ("x.example.com", "/de/1", "example.com/de/", "block"), "http://w.org/fr/a#b": ("w.org", "/fr/a", "org/fr/", "allow"), "http://w.net?x": ("w.net", "", None, None), "no scheme": ("", "", None, None), "a://b://c/d": ("b:", "//c/d", None, None), "": ("", "", None, None),
}


def test_rules_come_before_the_model(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(50, None), (None, "http://w.org/fr/")], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge(df, RULES).collect()}
    for i, want in enumerate(URLS.values()):
        assert (got[i].host, got[i].path, got[i].rule) == want[:3]
        assert got[i].verdict == (want[3] or ("block" if got[i].score >= 0.5 else "allow"))
    assert got[50].host == "" and got[None].verdict == "allow" and url_filter.judge(df.limit(0), RULES).count() == 0


def test_model_parts_the_labelled_table_and_new_urls():
    m = url_filter.Model.train()
    assert all((s >= 0.5) == bool(y) for s, (_, y) in zip(m.scores([x for x, _ in url_filter.LABELLED]), url_filter.LABELLED))
    s = m.scores(["www.cheap-casino-pills.example.com/buy", "library.example.org/en/books/12", ""])
    assert s[0] > 0.5 > s[1] and 0.1 < s[2] < 0.5  # without n-grams: the share of unwanted rows, so null urls are allowed


def word_of(url):
    name = url.partition("/")[0].split(".example.")[0].split(".")[-1]
    return name.removeprefix("my-").removesuffix("-online").removesuffix("-page")


def test_model_judges_words_that_it_has_not_seen(spark):
    import re

    tokens = lambda words: {t for w in words for t in re.split("[-.]", w)}
    known = tokens([*url_filter.UNWANTED, *url_filter.WANTED])
    for sf in ("sf0.001", "sf0.01", "sf0.1"):  # no word of a host is in the table
        hosts = {url_filter.split(r.url)[0] for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("url").distinct().collect()}
        assert len(hosts) > 5 and not known & tokens({h.split(".example.")[0] for h in hosts})
    words = sorted({word_of(x) for x, _ in url_filter.LABELLED})
    random.Random(1).shuffle(words)
    fold, scored = {w: i % 8 for i, w in enumerate(words)}, []
    for k in range(8):
        m = url_filter.Model.train([r for r in url_filter.LABELLED if fold[word_of(r[0])] != k])
        rest = [r for r in url_filter.LABELLED if fold[word_of(r[0])] == k]
        scored += [(s, y) for s, (_, y) in zip(m.scores([x for x, _ in rest]), rest)]
    good = sorted(s for s, y in scored if not y)
    recall = lambda least: sum(s >= least for s, y in scored if y) / sum(y for _, y in scored)
    assert recall(0.5) >= 0.7 and sum(s >= 0.5 for s in good) < 0.12 * len(good)
    assert recall(good[int(0.95 * len(good))]) >= 0.5  # at false alarms of a twentieth
    assert all(re.fullmatch(r"[a-z0-9.-]+/[a-z0-9./]*", x) for x, _ in url_filter.LABELLED)


def test_scores_against_a_slow_model():
    m = url_filter.Model.train()
    for name in ("www.pills-shop.example.com/en/1", "é.example.org/", "a", ""):
        raw = f"^{name}$".encode()
        grams = []
        for n in url_filter.SIZES:
            for i in range(len(raw) - n + 1):
                h = n
                for x in raw[i : i + n]:
                    h = (h * 257 + x) % (1 << 64)
                grams.append(int(common.mixed(np.array([h], np.uint64))[0]) >> (64 - url_filter.BITS))
        z = sum(float(m.weights[g]) for g in grams) / max(1, len(grams)) ** 0.5 + m.bias
        assert abs(m.scores([name])[0] - 1 / (1 + math.exp(-z))) < 1e-6


def test_archives_come_back(spark, tmp_path):
    big, small = "<p>é</p>" * 30, "tiny"
    rows = [(3, "http://h.org/x?y#z", big), (1, "http://h.org/b", big), (2, None, big), (4, "http://s.org", small), (5, "http://s.org/\r\nEvil: 1", small), (6, "u", None), (7, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9), (None, "n", "null id"), (4, "http://s.org", small)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("uid", F.lit("clash")).repartition(3)
    warc.write(df, str(tmp_path / "w"), per_file=2)
    records = warc.read(spark, str(tmp_path / "w"))
    assert records.count() == 3 * len(rows)
    got = warc.assemble(records).withColumn("page", F.regexp_extract("metadata.fields", r"page-id: (-?\d*)", 1)).collect()
    assert len(got) == len(rows)
    by_id = {r.capture_id: r for r in got}
    kinds = collections.Counter((r.page, r.response.kind) for r in got)
    assert kinds == {("1", "response"): 1, ("2", "revisit"): 1, ("3", "revisit"): 1, ("4", "response"): 2, ("5", "response"): 1, ("6", "response"): 1, ("7", "response"): 1, ("", "response"): 1}
    for r in got:
        assert r.request.record_id != r.metadata.record_id and r.request.fields.startswith("GET ")
        html = next(h or "" for i, _, h in rows if str(i or "") == r.page)
        assert r.response.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        if r.response.kind == "revisit":
            assert by_id[r.response.refers_to].page == "1" and r.response.payload is None
        else:
            assert bytes(r.response.payload) == html.encode() and r.response.payload_bytes == len(html.encode())
    warc.write(df.limit(0), str(tmp_path / "e"))
    assert warc.assemble(warc.read(spark, str(tmp_path / "e"))).count() == 0


RECORD = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"


def test_damaged_archives_fail():
    assert [b for _, b in warc.records(RECORD * 2)] == [b"ab", b"ab"] and list(warc.records(b"")) == []
    for bad in (RECORD[:-5], RECORD + b"WARC", RECORD.replace(b": 2", b": 3"), gzip.compress(RECORD)[:-9]):
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_all_members_of_an_archive_are_read(spark, tmp_path):
    big = RECORD.replace(b": 2", b": 6000000").replace(b"ab", b"a " * 3_000_000)
    assert [len(b) for _, b in warc.records(gzip.compress(RECORD) * 3 + b"\0\0" + gzip.compress(big + RECORD))] == [2, 2, 2, 6_000_000, 2]
    rows = [f"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: {i}\r\nContent-Length: {len(str(i))}\r\n\r\n{i}\r\n\r\n".encode() for i in range(300)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, rows)))
    (tmp_path / "b.warc").write_bytes(b"".join(rows))
    assert sorted(int(r.fields) for r in warc.read(spark, str(tmp_path)).collect()) == sorted([*range(300)] * 2)


def test_files_are_bounded_by_bytes(spark, tmp_path):
    df = spark.createDataFrame([(i, "http://h.org/", chr(97 + i % 26) * 5000 + str(i)) for i in range(60)] + [(99, "u", "long page " * 500_000)], "page_id long, url string, html string").coalesce(1)
    warc.write(df, str(tmp_path / "w"), file_bytes=400_000)
    assert len(list((tmp_path / "w").glob("part-*"))) > 10
    got = warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(got) == 61 and max(r.response.payload_bytes for r in got) == 5_000_000


TALK = [
    (1, 0, "Hello there\nHow are  you?"), (1, 1, "On Monday u wrote:\n> hello THERE\n> How are you?\nFine."), (1, 2, "> > Hello there\n> Fine.\nGood"), (1, 3, "other"), (1, 4, "> Good\nyes"), (2, 0, "> Fine.\nstolen"), (2, 1, None),
    (None, 0, "> other\nz"), (1, 3, "other"), (3, 0, ">"), (4, 0, "a\n\nb c"), (4, 1, "> unknown words\nx"), (4, 2, ">b  C\ny"),
]
LINKED = [
    (None, 0, "z", None, (0, 0, 0)), (1, 0, "Hello there\nHow are  you?", None, (0, 0, 0)), (1, 1, "Fine.", 0, (0, 1, 1)), (1, 2, "Good", 1, (0, 2, 2)), (1, 4, "yes", 2, (0, 3, 3)), (1, 3, "other", None, (3, 0, 0)), (1, 3, "other", None, (3, 0, 0)),
    (2, 0, "stolen", None, (0, 0, 0)), (2, 1, "", None, (1, 0, 0)), (3, 0, "", None, (0, 0, 0)), (4, 0, "a\n\nb c", None, (0, 0, 0)), (4, 2, "y", 0, (0, 1, 1)), (4, 1, "x", None, (1, 0, 0)),
]


def test_quotations_are_linked_and_ordered(spark):
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in TALK], "conv_id long, turn long, role string, text string").withColumn("body", F.lit("clash"))
    got = quotes.link_quotations(df).collect()
    assert [(r.conv_id, r.turn, r.body, r.parent_turn, (r.root_turn, r.place, r.depth)) for r in got] == LINKED
    by = {(r.conv_id, r.turn): r.quotes for r in got}
    assert [tuple(q) for q in by[1, 2]] == [(2, "Hello there", 1, 0), (1, "Fine.", 1, 1)] and [tuple(q) for q in by[4, 1]] == [(1, "unknown words", None, None)] and by[2, 0][0].conv_id == 1
    assert quotes.link_quotations(df.limit(0)).count() == 0


def test_quotations_of_other_conversations(spark):
    rng = random.Random(3)
    lines = ["Thanks all", "yes", "no idea", "see you"]
    rows = [(1, 0, "> Thanks all"), (1, 1, "Thanks all"), (2, 0, "Thanks all")]
    rows += [(c, t, rng.choice(["> ", ""]) + rng.choice(lines) + f" {k}") for k in range(12) for c, t in rng.sample([(c, t) for c in range(10 * k + 10, 10 * k + 15) for t in range(4)], 9)]
    rows += [(None, 0, "> yes 3"), (None, 1, "no idea 4")]
    got = quotes.link_quotations(spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, x in rows:
        if x.startswith("> "):
            same = sorted((a, b) for a, b, y in rows if y == x[2:] and a is not None)
            want.append((c, t, *next(iter([s for s in same if s[0] == c and s[1] < t] + [s for s in same if s[0] != c]), (None, None))))
    found = [(r.conv_id, r.turn, q.conv_id, q.turn) for r in got for q in r.quotes]
    assert (1, 0, 2, 0) in found and sorted(map(str, found)) == sorted(map(str, want))


def test_quotations_against_sql(spark, tmp_path):
    import duckdb

    from anchorwise.llm import queries

    rows = [(c, t, "user", x) for c, t, x in [*TALK, (5, 0, "> Thanks all"), (5, 1, "Thanks all"), (6, 0, "Thanks all"), *((8, i, "root" if not i else f"> root\nm{i}" if i % 3 else f"> m{i - 1}\nm{i}") for i in range(9)), *((9, i, (f"> m{i - 1} text\n" if i else "") + f"m{i} text\nOn it wrote:") for i in range(12))]]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = queries.op8_quotation_linking(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()['op8_quotation_linking']})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_plan_is_native(spark):
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in TALK], "conv_id long, turn long, role string, text string")
    from anchorwise.plans.jobs import explained

    plan = explained(quotes.link_quotations(df))
    assert not any(x in plan for x in ("EvalPython", "MapInArrow", "MapInPandas", "InPandas", "FlatMapGroups"))


def test_long_reply_chains(spark):
    rows = [(1, i, "u", (f"> m{i - 1} text\n" if i else "") + f"m{i} text") for i in range(40)]
    got = quotes.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.turn, r.root_turn, r.place, r.depth) for r in got] == [(i, 0, i, i) for i in range(40)]


def test_a_line_that_many_quote(spark):
    rows = [(1, 0, "u", "Ok"), *((c, t, "u", "> ok\nm") for c in (1, 2) for t in range(1, 2000)), (3, 0, "u", "rare"), (3, 1, "u", "> rare\nx")]
    got = quotes.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    found = [(r.conv_id, r.turn, q.conv_id, q.turn) for r in got for q in r.quotes]
    assert sorted(found) == [*((1, t, 1, 0) for t in range(1, 2000)), *((2, t, 1, 0) for t in range(1, 2000)), (3, 1, 3, 0)]
    assert sorted((r.turn, r.root_turn, r.place, r.depth) for r in got if r.conv_id == 1) == [(t, 0, t, min(t, 1)) for t in range(2000)]


def test_threads_against_a_plain_walk(spark):
    rng = random.Random(8)
    parents = [(c, t, rng.randrange(max(0, t - 1 - c), t)) for c in range(6) for t in range(1, 60) if rng.random() < 0.8]
    parents += [(7, t, 0) for t in range(1, 400)]  # one message with all replies
    got = {(r.conv_id, r.turn): (r.root_turn, r.place, r.depth) for r in quotes.threads(spark.createDataFrame(parents, "conv_id long, turn long, parent long")).collect()}
    above, below, want = {(c, t): p for c, t, p in parents}, {}, {}
    for c, t, p in sorted(parents):
        below.setdefault((c, p), []).append(t)
    for c, root in sorted(k for k in below if k not in above):
        stack, n = [(root, 0)], 0
        while stack:
            t, depth = stack.pop()
            want[c, t] = (root, n, depth)
            n += 1
            stack += [(x, depth + 1) for x in reversed(below.get((c, t), []))]
    assert got == want


def test_helpers():
    assert common.spans(common.np.array([0, 5, 5, 20, 21]), 6) == [(0, 2), (2, 3), (3, 4)]
