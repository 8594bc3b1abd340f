"""Hard-negative mining (operator 13): rows of another label that score nearly as high as a positive, found in vantage-point trees over norm-augmented vectors.

A vector x gets one more component, sqrt(M^2 - |x|^2), with M the largest norm of all; an anchor q gets 0. The squared distance between the two is then |q|^2 + M^2 - 2 q.x, so the order by
score is the order by distance, and a window of scores is an annulus around the anchor.

Rows are dealt to shards by a coarse tree, which is fitted on a bounded sample (SAMPLE rows) and has a bounded number of cells; a cell of many rows, such as copies of one
vector, is split further by a hash of the row, so every shard has about SHARD rows whatever the data. Each shard is a vantage-point tree of its own, kept as a row of a table in the shared
folder, so a lost executor costs the tasks that it ran. Anchors are searched in blocks against the shards that the coarse tree can't rule out: first the nearest rows of the
anchor's own label, then the rows of other labels within the annuli of all its positives, in one walk. The walk takes leaves by their least possible distance and
ends when no leaf can hold a nearer row than those found, so it is exact; bounds are widened by SLACK against rounding, and scores are whole numbers.

Rows with a null vec_id, label or vector, or with a component that is null or not finite, take no part. Components are floor(scale * x); a shorter vector counts as padded with zeros. The largest squared norm
must be below 2^52 (an error otherwise), so that sums are exact. Rows equal in all three columns count once; rows that share a vec_id alone are rows of their own, but none is a
positive or negative of its own vec_id. Ties go by vec_id. An anchor without positives, or a positive without rows in its window (as all with a negative score), gives no rows. Very long vectors are taken
whole. An empty table gives no rows. Further columns don't matter, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, mapped, release, table

#: Rows that the coarse tree is fitted on, and its cells at most.
SAMPLE, CELLS = 2048, 256
#: Rows of a shard and of a leaf of its tree; anchors of a block.
SHARD, LEAF, BLOCK = 8192, 512, 1024
#: By how much bounds of distances are widened, as a share of the largest norm.
SLACK = 1e-6
SHARD_ROW = "shard long, ids binary, labels binary, vectors binary, leaves binary, inner binary, dims int"
BLOCK_ROW = "shard long, anchors binary"


def quantized(embedding: Column, scale: int) -> Column:
    """Components as whole numbers; null if any is null or not finite."""
    x = F.transform(embedding, lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.when(sound, F.transform(x, lambda c: F.floor(c * scale).cast("double")))


def points(rows: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, label, v, norm2) of the rows that take part."""
    out = rows.select(F.col(vec_id).alias("vec_id"), label.cast("long").alias("label"), quantized(F.col(embedding), scale).alias("v")).filter("vec_id is not null and label is not null and v is not null").distinct()
    return out.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))


def augmented(v: np.ndarray, most2: float) -> np.ndarray:
    """With the component that makes all norms equal."""
    return np.column_stack([v, np.sqrt(np.maximum(most2 - (v * v).sum(1), 0))])


def distances(points_: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points_ - to) ** 2).sum(1), 0))


def stacked(lists: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix, padded with zeros."""
    n, lengths = len(lists), np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if n and (lengths == dims).all():
        return flat.reshape(n, dims)
    out = np.zeros((n, dims))
    out[np.repeat(np.arange(n), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Tree:
    """A vantage-point tree as flat arrays: inner nodes in order, each with its vantage point, two children (a node, or -1 - leaf) and the range of distances in each."""

    def __init__(self, vectors: np.ndarray, leaf: int, leaves: int | None = None) -> None:
        self.vantage, self.children, self.ranges, self.leaves = [], [], [], []
        todo: list = [(np.arange(len(vectors)), None, 0)]
        waiting = 1
        while todo:
            rows, above, side = todo.pop(0)
            if len(rows) <= leaf or (leaves is not None and len(self.leaves) + waiting >= leaves):
                number = -1 - len(self.leaves)
                self.leaves.append(rows)
                waiting -= 1
            else:
                number = len(self.vantage)
                far = distances(vectors[rows], vectors[rows[0]])  # a point at the edge of the set tells most
                vantage = vectors[rows[int(far.argmax())]]
                d = distances(vectors[rows], vantage)
                order = np.argsort(d, kind="stable")
                half = len(rows) // 2
                self.vantage.append(vantage)
                self.children.append([0, 0])
                self.ranges.append([d[order[0]], d[order[half - 1]], d[order[half]], d[order[-1]]])
                todo += [(rows[order[:half]], number, 0), (rows[order[half:]], number, 1)]
                waiting += 1
            if above is not None:
                self.children[above][side] = number

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.vantage:
            return np.zeros((0, 0)), np.zeros((0, 2), np.int64), np.zeros((0, 4))
        return np.array(self.vantage), np.array(self.children, np.int64), np.array(self.ranges)


def slack(most2: float) -> float:
    return SLACK * (1 + np.sqrt(most2))


def leaf_bounds(vantage: np.ndarray, children: np.ndarray, ranges: np.ndarray, leaves: int, anchors: np.ndarray, most2: float) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and leaf, the least and the largest distance that a row of the leaf can have."""
    low, high = np.zeros((len(anchors), leaves)), np.full((len(anchors), leaves), np.inf)
    if not len(vantage):
        return low, high
    d = np.sqrt(np.maximum((anchors * anchors).sum(1)[:, None] + (vantage * vantage).sum(1)[None] - 2 * anchors @ vantage.T, 0))
    todo = [(0, np.zeros(len(anchors)), np.full(len(anchors), np.inf))]
    while todo:
        node, least, most = todo.pop()
        for side in (0, 1):
            near, far = ranges[node, 2 * side], ranges[node, 2 * side + 1]
            a, b = np.maximum(least, np.maximum(d[:, node] - far, near - d[:, node]) - slack(most2)), np.minimum(most, d[:, node] + far + slack(most2))
            child = children[node, side]
            if child < 0:
                low[:, -1 - child], high[:, -1 - child] = a, b
            else:
                todo.append((child, a, b))
    return low, high


class Router:
    """The coarse tree: cells of rows, and the shards of each."""

    def __init__(self, sample: np.ndarray, most2: float, cells: int) -> None:
        tree = Tree(augmented(sample, most2), 1, max(1, min(CELLS, len(sample) // 8, cells)))
        self.most2, self.dims = most2, sample.shape[1]
        self.vantage, self.children, self.ranges = tree.arrays()
        self.cells = len(tree.leaves)
        self.shards = np.ones(self.cells, np.int64)
        self.splits = (self.ranges[:, 1] + self.ranges[:, 2]) / 2

    def cell(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row, and its distance from each vantage point on its way (others are nan)."""
        v, at = augmented(vectors, self.most2), np.zeros(len(vectors), np.int64)
        seen = np.full((len(vectors), len(self.vantage)), np.nan)
        if not len(self.vantage):
            return at, seen
        where = np.zeros(len(vectors), np.int64)
        while (inner := where >= 0).any():
            for node in np.unique(where[inner]):
                rows = np.flatnonzero(where == node)
                seen[rows, node] = d = distances(v[rows], self.vantage[node])
                where[rows] = self.children[node][(d > self.splits[node]).astype(int)]
        return -1 - where, seen

    def first(self) -> np.ndarray:
        """The number of each cell's first shard."""
        return np.concatenate([[0], np.cumsum(self.shards)])


def router(pts: DataFrame, n: int, most2: float, dims: int, shard: int) -> Router:
    """Fits the coarse tree on SAMPLE rows, those with the least hashes, then counts all rows by cell and finds the true ranges of distances."""
    sample = pts.select("v").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).toArrow().combine_chunks()["v"]
    out = Router(stacked(sample.chunk(0), dims) if sample.num_chunks else np.zeros((0, dims)), most2, n // shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, near, far = np.zeros(out.cells, np.int64), np.full((len(out.vantage), 2), np.inf), np.full((len(out.vantage), 2), -np.inf)
        for batch in batches:
            cell, seen = out.cell(stacked(column(batch, "v"), dims))
            counts += np.bincount(cell, minlength=out.cells)
            for node in range(len(out.vantage)):
                right = seen[:, node] > out.splits[node]
                for side, d in ((0, seen[~right, node]), (1, seen[right, node])):
                    if len(d := d[~np.isnan(d)]):
                        near[node, side], far[node, side] = min(near[node, side], d.min()), max(far[node, side], d.max())
        have = np.flatnonzero(counts)
        node, side = np.nonzero(near <= far)
        kind = np.concatenate([np.zeros(len(have)), np.ones(len(node))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([have, 2 * node + side])), pa.array(np.concatenate([counts[have], np.zeros(len(node), np.int64)])), *(pa.array(np.concatenate([np.zeros(len(have)), x[node, side]])) for x in (near, far))], ["kind", "at", "n", "near", "far"])

    counted = mapped(pts.select("v"), run, "kind int, at long, n long, near double, far double").groupBy("kind", "at").agg(F.sum("n").alias("n"), F.min("near").alias("near"), F.max("far").alias("far"))
    out.ranges = np.column_stack([np.full(len(out.vantage), np.inf), np.full(len(out.vantage), -np.inf)] * 2)  # an empty side is out of reach
    for r in counted.collect():  # CELLS cells and ranges at most
        if r.kind == 0:
            out.shards[r["at"]] = -(-r.n // shard)
        else:
            out.ranges[r["at"] // 2, 2 * (r["at"] % 2) : 2 * (r["at"] % 2) + 2] = r.near, r.far
    return out


def index(pts: DataFrame, route: Router, leaf: int) -> DataFrame:
    """A row for each shard: its rows in the order of the leaves of its tree, and the tree."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = route.first()
        for batch in batches:
            v = stacked(column(batch, "v"), route.dims)
            cell, _ = route.cell(v)
            salt = column(batch, "salt").to_numpy().view(np.uint64)
            shard = first[cell] + (salt % route.shards[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), column(batch, "vec_id"), column(batch, "label"), pa.array([x.tobytes() for x in v], pa.binary())], ["shard", "vec_id", "label", "v"])

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        v = np.frombuffer(b"".join(rows["v"].to_pylist()), np.float64).reshape(-1, route.dims)
        tree = Tree(augmented(v, route.most2), leaf)
        order = np.concatenate(tree.leaves)
        vantage, children, ranges = tree.arrays()
        blobs = [rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order], v[order], np.array([len(x) for x in tree.leaves]), np.column_stack([vantage, children, ranges]) if len(vantage) else np.zeros((0, route.dims + 7))]
        return pa.table([rows["shard"][:1], *([x.tobytes()] for x in blobs), pa.array([route.dims], pa.int32())], names=["shard", "ids", "labels", "vectors", "leaves", "inner", "dims"])

    dealt = mapped(pts.select("vec_id", "label", "v", F.xxhash64("vec_id", "label", "v").alias("salt")), deal, "shard long, vec_id long, label long, v binary")
    return dealt.groupBy("shard").applyInArrow(build, SHARD_ROW)


def blocks(anchors: DataFrame, route: Router) -> DataFrame:
    """Blocks of anchors for the shards that they must search. Rows of anchors: (anchor_id, twin, label, v, wanted), wanted being pairs of the least and largest score
    of each window, one behind the other (empty: any score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = route.first()
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                v = stacked(column(part, "v"), route.dims)
                wanted = column(part, "wanted").to_pylist()
                low, high = leaf_bounds(route.vantage, route.children, route.ranges, route.cells, augmented_anchors(v), route.most2)
                near, far = annulus((v * v).sum(1), route.most2, wanted)
                hit = (low <= far[:, None]) & (high >= near[:, None])
                for cell in np.flatnonzero(hit.any(0)):
                    blob = packed(part.filter(pa.array(hit[:, cell])))
                    shards = np.arange(first[cell], first[cell + 1])
                    yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array([blob] * len(shards), pa.binary())], ["shard", "anchors"])

    return mapped(anchors, run, BLOCK_ROW)


def augmented_anchors(v: np.ndarray) -> np.ndarray:
    return np.column_stack([v, np.zeros(len(v))])


def annulus(norm2: np.ndarray, most2: float, wanted: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest distance of rows that any window of each anchor lets in, widened."""
    top = np.array([max(w[1::2], default=np.inf) for w in wanted])
    low = np.array([min(w[0::2], default=-np.inf) for w in wanted])
    near, far = (np.sqrt(np.maximum(norm2 + most2 - 2 * s, 0)) for s in (top, low))
    return near - slack(most2), far + slack(most2)


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def walk(low: np.ndarray, ends: np.ndarray, near: float, far: float, high: np.ndarray, score, fits, windows: list[tuple[float, float]], k: int, distance) -> list[list[tuple[int, int]]]:  # noqa: ANN001
    """Of one anchor: the first k rows of each window, nearest first, as (-score, place). Leaves come by their least distance; the walk ends when no window can get a nearer row."""
    found: list[list] = [[] for _ in windows]
    for leaf in np.argsort(low, kind="stable"):
        open_until = max((far if len(f) < k else min(far, distance(-f[-1][0]))) for f in found)
        if low[leaf] > open_until:
            break
        if high[leaf] < near:
            continue
        begin, end = ends[leaf], ends[leaf + 1]
        places, s, ids = fits(begin, end, score(begin, end))
        for f, (least, most) in zip(found, windows, strict=True):
            inside = np.flatnonzero((s >= least) & (s <= most))
            if len(inside) > k:
                inside = inside[np.lexsort((ids[inside], -s[inside]))[:k]]
            if len(inside):
                f += [(-int(s[i]), int(ids[i]), int(places[i])) for i in inside]
                f.sort()
                del f[k:]
    return found


def search(shards: DataFrame, asked: DataFrame, most2: float, k: int, same_label: bool) -> DataFrame:
    """(anchor_id, twin, window, other_id, score): the first k rows of each shard for each window of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield one(row)

    def one(row: dict) -> pa.RecordBatch:
        dims = row["dims"]
        ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dims)
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["leaves"], np.int64))])
        inner = np.frombuffer(row["inner"], np.float64).reshape(-1, dims + 7)
        with pa.ipc.open_stream(row["anchors"]) as read:
            anchors = read.read_all().combine_chunks()
        v = stacked(anchors["v"].chunk(0) if anchors["v"].num_chunks else pa.array([], pa.list_(pa.float64())), dims)
        wanted, norm2 = anchors["wanted"].to_pylist(), (v * v).sum(1)
        low, high = leaf_bounds(inner[:, : dims + 1], inner[:, dims + 1 : dims + 3].astype(np.int64), inner[:, dims + 3 :], len(ends) - 1, augmented_anchors(v), most2)
        near, far = annulus(norm2, most2, wanted)
        out: list[tuple[int, int, int, int, int]] = []
        for i, (anchor, twin, label) in enumerate(zip(*(anchors[c].to_pylist() for c in ("anchor_id", "twin", "label")), strict=True)):

            def fits(a: int, b: int, s: np.ndarray, anchor=anchor, label=label) -> tuple:  # noqa: ANN001
                keep = np.flatnonzero(((labels[a:b] == label) == same_label) & (ids[a:b] != anchor))
                return keep + a, s[keep], ids[a:b][keep]

            windows = [*zip(wanted[i][0::2], wanted[i][1::2], strict=True)] or [(-np.inf, np.inf)]
            distance = lambda s, i=i: np.sqrt(max(norm2[i] + most2 - 2 * s, 0)) + slack(most2)
            found = walk(low[i], ends, near[i], far[i], high[i], lambda a, b, i=i: vectors[a:b] @ v[i], fits, windows, k, distance)
            out += [(anchor, twin, w, other, -minus) for w, f in enumerate(found) for minus, other, _ in f]
        return pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(5)], ["anchor_id", "twin", "window", "other_id", "score"])

    # A sort-merge join by hint: the optimizer knows neither how far a block is copied to shards nor how well vectors were compressed, and would send either side through the driver.
    pairs = shards.join(asked.hint("merge"), "shard")
    return mapped(pairs, run, "anchor_id long, twin long, window long, other_id long, score long")


def first_of(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each key, with their rank from 1."""
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, label: Column, is_anchor: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", positives: int = 5, negatives: int = 5, least_percent: int = 80, scale: int = 256, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Positives are an anchor's best rows of the same label, negatives the best rows of other labels that score
    between least_percent hundredths of the positive's score and that score. is_anchor is a condition on vec_id."""
    pts = table(points(rows, label, vec_id, embedding, scale))
    n, most2, dims = pts.agg(F.count("*"), F.coalesce(F.max("norm2"), F.lit(0.0)), F.coalesce(F.greatest(F.max(F.size("v")), F.lit(1)), F.lit(1))).first()
    if most2 >= 2.0**52:
        raise ValueError("components are too large for exact scores: the largest squared norm must be below 2^52")
    route = router(pts, n, most2, dims, shard)
    shards = table(index(pts, route, leaf))
    anchors = pts.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("twin"), "label", "v")  # the twin tells rows of one vec_id apart
    parts, own = -(-anchors.count() // BLOCK) or 1, ["anchor_id", "twin"]
    asked = blocks(anchors.repartition(parts).withColumn("wanted", F.array().cast("array<long>")), route)
    near = table(first_of(search(shards, asked, most2, positives, same_label=True), own, positives))
    # All windows of an anchor are searched in one walk: pairs of the least and largest score, by the rank of the positive.
    least = F.when(F.col("score") < 0, F.col("score") + 1).otherwise(F.expr(f"({least_percent} * score + 99) div 100"))
    windows = near.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("rank", least.alias("least"), "score"))).alias("w"))
    wanted = windows.select(*own, F.flatten(F.transform("w", lambda w: F.array(w.least, w.score))).alias("wanted"))
    found = first_of(search(shards, blocks(anchors.join(wanted, own).repartition(parts), route), most2, negatives, same_label=False), [*own, "window"], negatives)
    found = found.select(*own, (F.col("window") + 1).alias("place"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    out = found.join(near.select(*own, F.col("rank").cast("long").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), [*own, "place"])
    out = table(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    release(pts, shards, near)
    return out
