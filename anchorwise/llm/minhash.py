"""Near-duplicates (operator 5): MinHash with banding, verification, and components by large-star and small-star.

A document's set holds the hashes (64 bits) of its distinct 5-word shingles; the words are split at ASCII blanks after lower-casing A-Z. With
fewer words the whole sequence is its one shingle; without words the set is empty and linked with nothing.

1. One pass gives each row the digest of its set, `bands` * `rows` universal-hash minima folded to a hash for each band, and one
   byte of each minimum. Rows of equal sets form a class; from here on one row stands for each class.
2. Candidates are classes that share a band. The smallest class of a bucket is its star; each class is judged against the
   star with which it shares the most bands, so there is one candidate a class. Candidates whose minima agree far too seldom are dropped (`slack` is five standard errors); the others are confirmed on full sets.
3. Links that this doesn't see join a bucket's classes that are still in different components. Buckets of that kind with a class in common make a
   cluster. Its cross pairs are compared, in tasks of two blocks of about `block` classes and BLOCK_SHINGLES shingles at most, by the bytes of their minima and then on full
   sets; a task gives a forest of links, not all of them. Pairs within a component need no comparison, as they can't change it.
4. Components come from alternating large-star and small-star rounds until the edges stay the same.

Tables that a hot key is joined to (minima of a node, members of a bucket, ids of a component) are written to the shared folder first, so each side of such a join
is a shuffle of its own, whose large partitions Spark splits. These tables are deleted once nothing reads them.

A pair at the threshold 0.85 shares no band with probability (1 - 0.85 ** rows) ** bands, 8e-8 here (1.5e-5 at 0.8, the pipeline's threshold).
Null text counts as empty; rows with a null id, repeated rows and ties are rows of their own; component_id is the smallest doc_id
(null if all are null). A very long text is read whole, by one task, and compared by the hashes of all its shingles. Further columns don't matter here and pass drop_near_copies(), whatever their
names. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, BANDS, ROWS, SLACK, BLOCK, BLOCK_SHINGLES, PART = 5, 28, 5, 0.16, 2048, 1 << 20, 256
SIGNED = "uid long, doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, minima binary"
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(raw: np.ndarray, at: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, not distinct yet, and offsets."""
    n = len(at) - 1
    x = _LOWER[raw]
    blank = np.append(_BLANK[x], True)
    start_of_text = np.zeros(len(x) + 1, bool)
    start_of_text[at[:-1]] = True
    word = ~blank
    begins = np.flatnonzero(word & np.concatenate([[True], blank[:-1]]) | word & start_of_text)
    ends_mask = np.zeros(len(x) + 1, bool)
    ends_mask[1:] = word[:-1] & (blank[1:] | start_of_text[1:])
    ends = np.flatnonzero(ends_mask)
    hashed = common.range_hash(x, begins, ends, 5)
    per = np.diff(np.searchsorted(begins, at))
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    count = np.where(per >= size, per - size + 1, (per > 0).astype(np.int64))
    place = common.gathered(first, count)
    have = np.repeat(np.minimum(per, size), count)
    out = np.zeros(len(place), np.uint64)
    factor = common.random_words(size, 6) | np.uint64(1)
    for k in range(size):
        inside = have > k
        if inside.all():
            out += hashed[place + k] * factor[k]
        else:
            out[inside] += hashed[place[inside] + k] * factor[k]
    out += have.astype(np.uint64)
    return common.mixed(out), np.concatenate([[0], np.cumsum(count)])


def distinct(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and offsets."""
    n = len(at) - 1
    own = np.repeat(np.arange(n), np.diff(at))
    order = np.argsort(h)
    order = order[np.argsort(own[order], kind="stable")]
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], np.searchsorted(own[new], np.arange(n + 1))


def signed(bands: int, rows: int, size: int):  # noqa: ANN201
    """(uid, doc_id, text) to signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = common.random_words(bands * rows, 7) | np.uint64(1), common.random_words(bands * rows, 8)
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            uid, ids = common.column(batch, "uid"), common.column(batch, "doc_id")
            for a, b in common.spans(at, 1 << 18):
                h, off = distinct(*shingles(raw[at[a] : at[b]], at[a : b + 1] - at[a], size))
                n = np.diff(off)
                full = np.flatnonzero(n)
                d = np.zeros((b - a, 2), np.uint64)
                minima = np.zeros((b - a, bands * rows), np.uint64)
                if len(full):
                    for k, seed in enumerate((9, 10)):
                        d[full, k] = np.add.reduceat(common.mixed(h ^ common.random_words(1, seed)), off[full])
                    buffer = np.empty_like(h)
                    for k in range(bands * rows):
                        np.multiply(h, factor[k], out=buffer)
                        np.add(buffer, shift[k], out=buffer)
                        minima[full, k] = np.minimum.reduceat(buffer, off[full])
                minima = common.mixed(minima)
                by_band = minima.reshape(b - a, bands, rows)
                folded = np.zeros((b - a, bands), np.uint64)
                for k in range(rows):
                    folded = common.mixed(folded * np.uint64(31) + by_band[:, :, k])
                folded ^= common.random_words(bands, 13)
                yield pa.RecordBatch.from_arrays([
                    uid.slice(a, b - a), ids.slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(d[:, 0].view(np.int64)), pa.array(d[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array((np.arange(b - a + 1) * bands).astype(np.int32)), pa.array(folded.view(np.int64).ravel())),
                    pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((np.arange(b - a + 1) * bands * rows).astype(np.int32)), pa.py_buffer((minima & np.uint64(255)).astype(np.uint8).ravel())]),
                ], ["uid", "doc_id", "n_shingles", "d1", "d2", "bands", "minima"])

    return run


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return common.utf8(column)[0].reshape(-1, width)


def _alike(width: int, least: int):  # noqa: ANN201
    """Candidate pairs whose minima agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_matrix(common.column(batch, x), width) for x in ("ma", "mb"))
            stay = (a == b).sum(1) >= least
            yield pa.RecordBatch.from_arrays([common.column(batch, x).filter(pa.array(stay)) for x in ("a", "b")], ["a", "b"])

    return run


def _blocks(width: int, least: int, percent: int, size: int):  # noqa: ANN201
    """Two blocks of a cluster (or one with itself): links that join different components, a forest of them at most."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, comp, side = (table[x].to_numpy() for x in ("rep", "comp", "side"))
        m = _matrix(table["minima"], width)
        h, off = distinct(*shingles(*common.utf8(table["text"]), size))
        _, ids = np.unique(h, return_inverse=True)  # places in the blocks' own dictionary
        n = np.diff(off)
        mark = np.zeros(len(h) + 1, np.int64)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        right = right if len(right) else left
        comp = comp.copy()
        found: list[tuple[int, int]] = []
        for i in left:
            hit = right[(comp[right] != comp[i]) & (100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))]
            hit = hit[(m[hit] == m[i]).sum(1) >= least]
            if not len(hit):
                continue
            own = ids[off[i] : off[i + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids[common.gathered(off[hit], n[hit])]], np.cumsum(n[hit]) - n[hit])
            mark[own] = 0
            for j in hit[100 * both >= percent * (n[hit] + n[i] - both)]:
                if comp[j] != comp[i]:
                    found.append((rep[i], rep[j]))
                    comp[comp == comp[j]] = comp[i]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


def _confirmed(percent: int, size: int):  # noqa: ANN201
    """Rows in order of (a, part, centre first): links between a and the members whose sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, key = np.zeros(0, np.uint64), None
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            a, part, b = (common.column(batch, x).to_numpy() for x in ("a", "part", "b"))
            hits = []
            for lo, hi in common.spans(at, 1 << 20):
                h, off = distinct(*shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], size))
                for i in range(lo, hi):
                    own = h[off[i - lo] : off[i - lo + 1]]
                    if b[i] == a[i]:
                        centre, key = own, (a[i], part[i])
                        continue
                    if key != (a[i], part[i]):
                        raise ValueError("a centre is missing")
                    if min(len(own), len(centre)) * 100 < percent * max(len(own), len(centre)):
                        continue
                    place = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                    both = int((centre[place] == own).sum())
                    if both and 100 * both >= percent * (len(own) + len(centre) - both):
                        hits.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a[hits]), pa.array(b[hits])], ["a", "b"])

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """pairs (a, b), distinct, to those alike enough. A centre with many members is dealt in parts of about PART members."""
    many = common.table(pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    salted = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts").cast("int"))
    centres = many.select(F.col("a").alias("uid"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = salted.select(F.col("b").alias("uid"), "a", "part").union(centres).join(texts, "uid").select("a", "part", F.col("uid").alias("b"), (F.col("a") != F.col("uid")).alias("member"), "text")
    found = common.table(rows.repartition(common.parts(pairs.sparkSession), "a", "part").sortWithinPartitions("a", "part", "member").transform(common.mapped, _confirmed(percent, size), "a long, b long"))
    common.release(many)
    return found


def components(links: DataFrame, *, most_rounds: int = 50) -> DataFrame:
    """(a, b) to (node, comp): the smallest node that each linked node can reach, itself included."""
    edges = common.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    state = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    mark = state()
    for _ in range(most_rounds):
        written = [edges]

        def kept(df: DataFrame) -> DataFrame:
            """In about as many files as the edges need; no step makes more than twice their number."""
            written.append(common.table(df, mark[0]))
            return written[-1]

        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = kept(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v"))
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        common.release(*written[:-1])
        now = state()
        if now == mark:  # settled
            break
        mark = now
    else:
        raise RuntimeError("components have not settled")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _residual(shared: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame, least: int, width: int, percent: int, size: int, block: int) -> DataFrame:
    """Links (a, b) between classes that share a bucket, or a cluster of buckets, but not a component: a forest of them at least, as far as sets are alike enough."""
    member = common.table(shared.select("band", F.col("b").alias("rep")).join(comps.toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")))
    split = common.table(member.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("rep").alias("a")).filter("low != high").select("band", "a"))
    cross = common.table(member.join(split, "band").select("a", "rep", "comp").distinct())
    common.release(member, split)
    clusters = components(cross.select("a", F.col("rep").alias("b")))
    pairs = cross
    cross = common.table(pairs.select("rep", "comp").distinct().join(clusters.toDF("rep", "cluster"), "rep").join(reps.select("rep", "n_shingles", "minima"), "rep"))
    common.release(pairs)
    by_comp = cross.groupBy("cluster", "comp").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
    sizes = by_comp.groupBy("cluster").agg(F.sum("m").alias("n"), F.sum("s").alias("all"), F.max(F.struct("m", "s", "comp")).alias("top"))
    blocks = lambda rows, shingles: F.greatest(F.ceil(rows / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    sizes = common.table(sizes.select("cluster", F.col("top.comp").alias("main"), blocks(F.col("top.m"), F.col("top.s")).alias("mains"), blocks(F.col("n") - F.col("top.m"), F.col("all") - F.col("top.s")).alias("others")))
    dealt = cross.join(sizes, "cluster").withColumn("is_main", F.col("comp") == F.col("main"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))
    # A task for each pair of blocks: (other i, main j) as (i, -1 - j), (other i, other j >= i) as (i, j).
    task = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    as_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: task(i, -1 - F.col("own"), F.lit(1)))
    as_other = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: task(F.col("own"), -1 - j, F.lit(0))),
        F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda j: task(F.least("own", j), F.greatest("own", j), F.when(F.col("own") <= j, 0).otherwise(1))),
    )
    dealt = dealt.select("cluster", "rep", "comp", "minima", F.explode(F.when(F.col("is_main"), as_main).otherwise(as_other)).alias("t"))
    dealt = dealt.join(texts.withColumnRenamed("uid", "rep"), "rep").select("cluster", "rep", "comp", "minima", "text", "t.*")
    more = common.table(dealt.groupBy("cluster", "i", "j").applyInArrow(_blocks(width, least, percent, size), "a long, b long"))
    common.release(cross, sizes)
    return more


def near_duplicates(docs: DataFrame, *, percent: int = 85, size: int = WORDS, bands: int = BANDS, rows: int = ROWS, slack: float = SLACK, block: int = BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): uid, doc_id, n_shingles, component_id, kept (one row of each component)."""
    texts = common.with_uid(docs.select("doc_id", "text"))
    width = bands * rows
    least = max(0, int(width * (percent / 100 - slack)))
    sign = common.table(texts.transform(common.mapped, signed(bands, rows, size), SIGNED))
    classes = common.table(sign.filter("n_shingles > 0").groupBy("d1", "d2").agg(F.min("uid").alias("rep"), F.min("doc_id").alias("least_id")))
    reps = common.table(sign.join(classes.select(F.col("rep").alias("uid")), "uid").select(F.col("uid").alias("rep"), "n_shingles", "bands", "minima"))
    minima = reps.select("rep", "minima")
    banded = reps.select("rep", F.explode("bands").alias("band"))
    buckets = common.table(banded.groupBy("band").agg(F.min("rep").alias("a"), F.count("*").alias("n")).filter("n > 1").select("band", "a"))
    shared = common.table(banded.join(buckets, "band").select("band", "a", F.col("rep").alias("b")))
    common.release(buckets)
    often = shared.filter("a != b").groupBy("b", "a").agg(F.count("*").alias("n"))
    pairs = often.groupBy("b").agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("top")).select((-F.col("top.a")).alias("a"), "b")
    pairs = pairs.join(minima.toDF("a", "ma"), "a").join(minima.toDF("b", "mb"), "b").transform(common.mapped, _alike(width, least), "a long, b long")
    pairs = common.table(pairs)
    # Texts that any confirmation can ask for: those in a bucket with another class.
    asked = shared.select(F.col("b").alias("uid")).distinct()
    texts = common.table(texts.select("uid", "text").join(asked, "uid"))
    links = confirm(pairs, texts, percent, size)
    comps = components(links)
    more = _residual(shared, comps, reps, texts, least, width, percent, size, block)
    ends = components(comps.toDF("a", "b").union(more))
    common.release(pairs, texts, links, shared, reps, more)
    named = common.table(classes.join(ends.toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")))
    ids = common.table(named.groupBy("comp").agg(F.min("least_id").alias("component_id")))
    of = common.table(named.join(ids, "comp").select("d1", "d2", "component_id"))
    common.release(classes, named, ids)
    rows_out = sign.select("uid", "doc_id", "n_shingles", "d1", "d2")
    linked = rows_out.filter("n_shingles > 0").join(of, ["d1", "d2"]).select("uid", "doc_id", "n_shingles", "component_id")
    alone = rows_out.filter("n_shingles = 0").select("uid", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """docs with one row of each component of sets whose similarity is `percent` hundredths or more. Any names of other columns pass."""
    docs, key = common.settled(docs), common.free(docs, "uid")
    found = near_duplicates(docs, percent=percent).filter("kept")
    stay = found.groupBy("component_id", F.when(F.col("component_id").isNull() | (F.col("n_shingles") == 0), F.col("uid")).alias("own")).agg(F.min("uid").alias(key)).select(key)
    return common.with_uid(docs, key).join(stay, key, "left_semi").drop(key)
