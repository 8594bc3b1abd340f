"""The category graph: nodes with their parents, as tables.

Edges are (child, parent). Fixpoints run as joins with a table a round, which is written once. Paths double in length each round, so a chain of n edges takes log2(n) rounds. The one sequential
operation, breaking cycles, never leaves a weakly connected component; it is cut to what lies on circles of undirected edges before, and runs for each component of
the rest by itself."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import release, table


def edges_of(categories: DataFrame) -> DataFrame:
    """(name, parents) to distinct edges."""
    return categories.select(F.col("name").alias("child"), F.explode("parents").alias("parent")).distinct()


def with_implicit_nodes(edges: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(name) of all nodes: those given, and each end of an edge."""
    nodes = edges.select(F.explode(F.array("child", "parent")).alias("name"))
    return (nodes if names is None else nodes.union(names.select("name"))).distinct()


def require_unique(categories: DataFrame) -> DataFrame:
    """Fails if a name occurs twice."""
    twice = categories.groupBy("name").agg(F.count("*").alias("n"), F.first("parents").alias("parents"))
    return twice.select("name", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("category occurs twice: "), "name")).cast("array<string>")).otherwise(F.col("parents")).alias("parents"))


def resolve_parents(categories: DataFrame) -> DataFrame:
    """Drops parents that aren't nodes themselves."""
    kept = edges_of(categories).join(categories.select(F.col("name").alias("parent")), "parent", "left_semi").groupBy(F.col("child").alias("name")).agg(F.array_sort(F.collect_list("parent")).alias("parents"))
    return categories.select("name").join(kept, "name", "left").select("name", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))


def heads(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without parents."""
    return nodes.join(edges.select(F.col("child").alias("name")), "name", "left_anti")


def tails(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that are nobody's parent."""
    return nodes.join(edges.select(F.col("parent").alias("name")), "name", "left_anti")


def size(nodes: DataFrame) -> int:
    return nodes.count()


def make_set(*names: str) -> Column:
    """Distinct names as an array."""
    return F.array_distinct(F.array(*map(F.lit, names)))


def find(categories: DataFrame, name: str) -> DataFrame:
    return categories.filter(F.col("name") == name)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for df in tables[1:]:
        out = out.union(df)
    return out


def _longer(rounds: list[DataFrame]) -> DataFrame:
    """Paths of rounds[0] (one edge) up to the last (up to r = 2^k edges), continued by paths of r edges. Each path is continued once: r of its edges are the last ones. (start, node, length)"""
    r = 1 << (len(rounds) - 1)
    last = rounds[-1].filter(F.col("length") == r).select(F.col("start").alias("node"), F.col("node").alias("to"))
    return _union(rounds).join(last, "node").select("start", F.col("to").alias("node"), (F.col("length") + r).alias("length"))


def distances(edges: DataFrame) -> DataFrame:
    """(start, node, length): all nodes on a path of one edge or more from start, with the fewest edges. A part of a shortest path is a shortest path, so pairs at distance r continue all shorter
    ones to distances up to 2r. Round k finds the pairs at distances from 2^(k-1) + 1 to 2^k and writes them alone."""
    rounds = [table(edges.select(F.col("child").alias("start"), F.col("parent").alias("node"), F.lit(1).alias("length")).distinct())]
    while True:
        new = table(_longer(rounds).groupBy("start", "node").agg(F.min("length").alias("length")).join(_union(rounds), ["start", "node"], "left_anti"))
        if new.isEmpty():
            release(new)
            return _union(rounds)
        rounds.append(new)


def closure(edges: DataFrame) -> DataFrame:
    """(start, node): all nodes on a path of one edge or more from start."""
    return distances(edges).select("start", "node")


def has_cycles(edges: DataFrame, strict: bool = False) -> bool:
    """True if some start reaches a node twice, as over a diamond; with `strict` only if a node reaches itself.

    Paths double in length each round, from all starts, and the first pair of nodes with two paths ends it; as long as there is none, pairs are as many as paths, and each is
    written once."""
    steps = table(edges.select("child", "parent").distinct())
    if strict:
        return _has_circle(steps)
    rounds = [table(steps.select(F.col("child").alias("start"), F.col("parent").alias("node"), F.lit(1).alias("length")))]
    release(steps)
    try:
        if not rounds[0].filter("start = node").isEmpty():
            return True
        while True:
            new = table(_longer(rounds))
            rounds.append(new)
            if new.isEmpty():
                return False
            twice = new.groupBy("start", "node").agg(F.count("*").alias("n")).filter("n > 1 or start = node")
            if not twice.isEmpty() or not new.join(_union(rounds[:-1]), ["start", "node"], "left_semi").isEmpty():
                return True
    finally:
        release(*rounds)


def _has_circle(edges: DataFrame) -> bool:
    """If a path comes back to its start. Edges from or to nodes that no circle can pass are taken away, and of nodes with one edge in and one out, those whose hash is less than
    their neighbours' are bridged over, so that chains lose a third of their edges a round; when nothing is taken away any more, what is left has a circle. Deletes its input."""
    k = 0
    while True:
        if not edges.filter("child = parent").isEmpty():
            release(edges)
            return True
        have = edges.count()
        once = lambda c, o: edges.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n"), F.min(o).alias(o)).filter("n = 1").select("name", o)  # noqa: B023, E731
        inner = once("parent", "child").join(once("child", "parent"), "name")
        h = lambda c: F.xxhash64(F.col(c), F.lit(k))  # noqa: B023, E731
        over = table(inner.filter((h("name") < h("child")) & (h("name") < h("parent"))))
        bridged = over.select("child", "parent")
        gone = over.select("name")
        rest = edges.join(gone.toDF("child"), "child", "left_anti").join(gone.toDF("parent"), "parent", "left_anti").select("child", "parent")
        bridged = rest.union(bridged).distinct()
        ends = bridged.join(bridged.select(F.col("child").alias("parent")), "parent", "left_semi").join(bridged.select(F.col("parent").alias("child")), "child", "left_semi")
        left = table(ends.select("child", "parent"))
        n, over_n = left.count(), over.count()
        release(edges, over)
        edges, k = left, k + 1
        if n == 0 or n == have and not over_n:
            release(edges)
            return n > 0


def weak_components(edges: DataFrame) -> DataFrame:
    """(name, component): the least name that is connected with each."""
    both = edges.select(F.col("child").alias("a"), F.col("parent").alias("b")).union(edges.select("parent", "child").toDF("a", "b")).distinct()
    state = table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "name"))
    written = state
    while True:
        near = both.join(state.toDF("b", "other"), "b").groupBy(F.col("a").alias("name")).agg(F.min("other").alias("other"))
        # Also the label of one's label: halves the way to the least name.
        jump = state.toDF("component", "beyond")
        moved = state.join(near, "name").join(jump, "component", "left").select("name", F.least("component", "other", "beyond").alias("next"), "component")
        moved = table(moved)
        if moved.filter("next != component").isEmpty():
            return state
        written, last = moved, written
        release(last)
        state = moved.select("name", F.col("next").alias("component"))


#: Rounds in which the ends of trees are taken off before cycles are broken. What longer chains leave is searched with the rest.
TRIM_ROUNDS = 12


def trimmed(edges: DataFrame, rounds: int = TRIM_ROUNDS) -> DataFrame:
    """(child, parent, first): the edges that can be part of an undirected circle, and others at ends of chains of more than `rounds` edges. An edge to or from a node without further edges
    never is a second way to a node. A search that starts at such a node goes on from its one parent, so the parent takes its place among the starts if that is earlier: `first`
    is the earliest name that a search from `child` stands for."""
    edges = table(edges.select("child", "parent").distinct().withColumn("first", F.col("child")))
    for _ in range(rounds):
        ends = edges.select(F.explode(F.array("child", "parent")).alias("name")).groupBy("name").agg(F.count("*").alias("n")).filter("n = 1").select("name")
        if ends.isEmpty():
            break
        below = edges.join(ends.withColumnRenamed("name", "child"), "child", "left_semi")
        earlier = below.groupBy(F.col("parent").alias("child")).agg(F.min("first").alias("earlier"))
        kept = edges.join(ends.withColumnRenamed("name", "child"), "child", "left_anti").join(ends.withColumnRenamed("name", "parent"), "parent", "left_anti")
        last, edges = edges, table(kept.join(earlier, "child", "left").select("child", "parent", F.least("first", "earlier").alias("first")))
        release(last)
    return edges


def _removed(edges: Iterable[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """Of (child, parent, first): the edges by which a search comes to a node once more."""
    parents: dict[str, list[str]] = {}
    starts: dict[str, str] = {}
    for child, parent, first in sorted(edges):
        parents.setdefault(child, []).append(parent)
        starts[child] = first
    removed = []
    for start in sorted(parents, key=starts.get):
        marked, stack = {start}, [(start, iter(list(parents.get(start, ()))))]
        while stack:  # depth first, parents by name
            node, left = stack[-1]
            parent = next(left, None)
            if parent is None:
                stack.pop()
            elif parent in marked:
                parents[node].remove(parent)
                removed.append((node, parent))
            else:
                marked.add(parent)
                stack.append((parent, iter(list(parents.get(parent, ())))))
    return removed


def _broken(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(_removed(zip(pdf.child, pdf.parent, pdf["first"] if "first" in pdf else pdf.child, strict=True)), columns=["child", "parent"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searches component by component; the rows of each follow one another. A task takes very many small ones, so none is a call of its own."""
    rows = (row for b in batches for row in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("component", "child", "parent", "first")), strict=True))
    removed: list[tuple[str, str]] = []
    for _, component in groupby(rows, key=itemgetter(0)):
        removed += _removed(row[1:] for row in component)
        if len(removed) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*removed, strict=True)], ["child", "parent"])
            removed = []
    if removed:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*removed, strict=True)], ["child", "parent"])


def broken_edges(edges: DataFrame) -> DataFrame:
    """Edges to remove so that no start reaches a node twice: starts and parents go by name."""
    core = trimmed(edges)
    parts = core.join(weak_components(core).withColumnRenamed("name", "child"), "child")
    return parts.repartition("component").sortWithinPartitions("component").mapInArrow(_searched, "child string, parent string")


def largest_search(edges: DataFrame) -> int:
    """The edges of the largest component that one task searches when cycles are broken."""
    core = trimmed(edges)
    parts = core.join(weak_components(core).withColumnRenamed("name", "child"), "child")
    return parts.groupBy("component").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def break_cycles(edges: DataFrame) -> DataFrame:
    """The edges that stay."""
    return edges.distinct().join(broken_edges(edges), ["child", "parent"], "left_anti")


def build(categories: DataFrame) -> DataFrame:
    """(name, parents) with unique names to a graph (name, parents) with all nodes and without cycles."""
    categories = require_unique(categories)
    edges = edges_of(categories)
    nodes = with_implicit_nodes(edges, categories)
    if has_cycles(edges):
        edges = break_cycles(edges)
    parents = edges.groupBy(F.col("child").alias("name")).agg(F.array_sort(F.collect_list("parent")).alias("parents"))
    return nodes.join(parents, "name", "left").select("name", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))


def display(categories: DataFrame) -> DataFrame:
    """name: [first, second], by name."""
    return categories.select("name", F.format_string("%s: [%s]", "name", F.array_join("parents", ", ")).alias("shown")).orderBy("name")


def same_graph(a: DataFrame, b: DataFrame) -> bool:
    """Equal names with equal sets of parents."""
    norm = lambda df: df.select("name", F.array_sort(F.array_distinct("parents")).alias("parents"))
    x, y = norm(a), norm(b)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
