import random

import pandas as pd
import pytest

from anchorwise.operators import graph


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "child string, parent string")


def nodes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def names(df):
    return {r[0] for r in df.collect()}


def test_heads_and_tails(spark):
    e, n = edges(spark, [("cat3", "cat2")]), nodes(spark, ["cat1", "cat2", "cat3"])
    assert names(graph.heads(n, e)) == {"cat1", "cat2"} and names(graph.tails(n, e)) == {"cat1", "cat3"}
    e = edges(spark, [("0", "3"), ("1", "2"), ("2", "3"), ("2", "4")])
    assert names(graph.tails(graph.with_implicit_nodes(e), e)) == {"0", "1"}


def test_circle_of_two(spark):
    e = edges(spark, [("cat1", "cat2"), ("cat2", "cat1")])
    assert graph.has_cycles(e) and graph.has_cycles(e, strict=True) and not names(graph.tails(graph.with_implicit_nodes(e), e))
    assert graph.broken_edges(e).count() == 1 and not graph.has_cycles(graph.break_cycles(e))


def test_diamond(spark):
    e = edges(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")])
    assert graph.has_cycles(e) and not graph.has_cycles(e, strict=True)
    assert [tuple(r) for r in graph.broken_edges(e).collect()] == [("c", "d")]


def test_tree(spark):
    tree = [(f"cat-{i}", f"cat-{p}") for i in range(7) for p in (2 * i + 1, 2 * i + 2)]
    assert not graph.has_cycles(edges(spark, tree))
    e = edges(spark, [*tree, ("cat-14", "cat-0")])
    assert graph.has_cycles(e, strict=True) and graph.broken_edges(e).count() == 1 and not graph.has_cycles(graph.break_cycles(e))


@pytest.mark.parametrize("seed", range(1))
def test_against_depth_first_search(spark, seed):
    rng = random.Random(seed)
    pairs = sorted({(str(rng.randrange(6)), str(rng.randrange(6))) for _ in range(rng.randrange(1, 8))})
    out = {}
    for a, b in pairs:
        out.setdefault(a, []).append(b)

    def twice(node, seen):
        if node in seen:
            return True
        seen.add(node)
        return any(twice(p, seen) for p in out.get(node, ()))

    e = edges(spark, pairs)
    assert graph.has_cycles(e) == any(twice(n, set()) for n in out)
    assert not graph.has_cycles(graph.break_cycles(e))
    reach = set(pairs)
    while more := {(a, d) for a, b in reach for c, d in pairs if b == c} - reach:
        reach |= more
    assert {tuple(r) for r in graph.closure(e).collect()} == reach
    assert graph.has_cycles(e, strict=True) == any(a == b for a, b in reach)


def many_graphs(n, nodes, seed, more=0):
    """n small graphs in one table, apart by their names."""
    rng = random.Random(seed)
    out = []
    for g in range(n):
        size = rng.randrange(1, nodes)
        out.append(sorted({(f"{g:05}-{rng.randrange(size)}", f"{g:05}-{rng.randrange(size)}") for _ in range(rng.randrange(1, size + 2 + more))}))
    return out


def test_breaking_equals_a_plain_search_on_many_graphs(spark):
    graphs = many_graphs(1000, 14, 1)
    for g in range(300):  # trees with few further edges, so that most is trimmed
        rng, size = random.Random(g), 20
        names_ = [f"t{g:05}-{i:02}" for i in rng.sample(range(size), size)]
        tree = [(names_[i], names_[rng.randrange(max(0, i - 3), i)]) for i in range(1, size)]
        graphs.append([e if rng.random() < 0.7 else e[::-1] for e in tree] + [(rng.choice(names_), rng.choice(names_)) for _ in range(rng.randrange(3))])
    every = [e for g in graphs for e in set(g)]
    want = {tuple(r) for g in graphs for r in graph._broken(pd.DataFrame(sorted(set(g)), columns=["child", "parent"])).itertuples(index=False)}
    e = edges(spark, every)
    assert {tuple(r) for r in graph.broken_edges(e).collect()} == want and len(want) > 1000
    assert graph.trimmed(e).count() < 0.9 * len(every) and graph.trimmed(e, 1).count() > graph.trimmed(e).count()
    assert graph.largest_search(e) < 60


def test_cycles_of_many_graphs(spark):
    """Each graph by itself, in a plain form; the tables hold the graphs that have none, and then one that has."""
    graphs = many_graphs(3000, 7, 2)

    def twice(pairs):
        out = {}
        for a, b in pairs:
            out.setdefault(a, []).append(b)

        def again(node, seen):
            if node in seen:
                return True
            seen.add(node)
            return any([again(p, seen) for p in out.get(node, ())])

        return any(again(n, set()) for n in out)

    def circle(pairs):
        left = set(pairs)
        while left and (fewer := {(a, b) for a, b in left if b in {x for x, _ in left}}) != left:
            left = fewer
        return bool(left)

    for plain, strict in ((twice, False), (circle, True)):
        without = [e for g in graphs if not plain(g) for e in g]
        assert len(without) > 1000 and not graph.has_cycles(edges(spark, without), strict=strict)
        for g in [g for g in graphs if plain(g)][:1]:
            assert graph.has_cycles(edges(spark, without + g), strict=strict)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    made = []
    real = graph.table
    monkeypatch.setattr(graph, "table", lambda df, *a: made.append(1) or real(df, *a))
    chain = [(f"{i:05}", f"{i + 1:05}") for i in range(300)]
    e = edges(spark, chain)
    far = graph.distances(e)
    assert far.count() == 300 * 301 // 2 and far.agg({"length": "max"}).first()[0] == 300 and len(made) <= 12
    assert far.filter("cast(node as int) - cast(start as int) != length").isEmpty()
    made.clear()
    assert not graph.has_cycles(e) and len(made) <= 13
    made.clear()
    assert not graph.has_cycles(e, strict=True) and len(made) <= 40
    assert graph.has_cycles(edges(spark, [*chain, ("00300", "00000")]), strict=True)


def test_distances_on_circles(spark):
    pairs = many_graphs(1, 40, 5, more=50)[0]
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    want = {}
    for s in out:
        level, d = out[s], 1
        while level:
            want |= {(s, n): d for n in level}
            level, d = {m for n in level for m in out.get(n, ()) if (s, m) not in want}, d + 1
    assert {(r.start, r.node): r.length for r in graph.distances(edges(spark, pairs)).collect()} == want


def test_build_display_and_lookup(spark):
    rows = spark.createDataFrame([("a", []), ("b", ["y", "x"])], "name string, parents array<string>")
    built = graph.build(rows)
    assert {(r.name, tuple(r.parents)) for r in built.collect()} == {("a", ()), ("b", ("x", "y")), ("x", ()), ("y", ())}
    assert [r.shown for r in graph.display(built).collect()] == ["a: []", "b: [x, y]", "x: []", "y: []"]
    assert graph.size(built) == 4 and rows.select(graph.make_set("a", "a", "b")).first()[0] == ["a", "b"]
    assert graph.find(built, "b").count() == 1 and graph.find(built, "q").count() == 0
    assert graph.same_graph(rows, spark.createDataFrame([("b", ["x", "y"]), ("a", [])], "name string, parents array<string>")) and not graph.same_graph(rows, built)
    with pytest.raises(Exception, match="occurs twice"):
        graph.require_unique(rows.union(rows)).collect()


def test_small_components_are_searched_in_one_pass(spark):
    """No call of a function for each, also where their rows come in many batches."""
    edges = [(f"{k}-{a}", f"{k}-{b}") for k in range(400) for a, b in ((0, 1), (1, 2), (2, 0), (0, 2))]
    e = spark.createDataFrame(edges, "child string, parent string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = graph.broken_edges(e)
        assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
        want = {tuple(r) for k in range(400) for r in graph._broken(pd.DataFrame(edges[4 * k : 4 * k + 4], columns=["child", "parent"])).itertuples(index=False)}
        assert sorted(tuple(r) for r in found.collect()) == sorted(want) and len(want) >= 400
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
