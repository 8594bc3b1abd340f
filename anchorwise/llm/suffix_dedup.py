"""Removal of long repeated byte strings (operator 1), by sharded suffix arrays.

A window is `length` bytes of one text. Its key is the hash of that of its 32-byte pieces which has the smallest mixed hash, so equal windows have
equal keys; neighbouring windows mostly share theirs. A segment is the bytes of a run of windows with one key. Each window
lies in exactly one segment, and equal windows lie in segments of one key, so segments dealt by key can be judged apart. A segment can repeat within itself
only if it holds the piece that gave its key twice. If it is periodic, all its windows do, and its first period stands for it.

1. Segments' keys and digests (no text) are dealt by digest. Segments whose digest occurs again are repeated throughout. Keys with
   a single text are settled by a count of texts with partial sums, unless that text may repeat within itself. Of other keys, one segment of each text goes on.
2. Those segments' bytes are fetched and dealt by key; each task joins them to shard texts of a few MB, sorts the suffixes
   by induced sorting, and takes windows whose permuted common prefix with a neighbour in the array is `length` or more.
3. A key with over `hot` different texts goes past the arrays: its windows are compared by their own 128-bit BLAKE2 digests, the measure of equality of step 1, in a
   group-by with partial aggregation, so that no task gathers them.

Texts are judged as UTF-8; null is empty; repeated rows and rows with a null id count as documents of their own, so that
all of a repeated long text is removed. Texts under `length` bytes stay whole. Long texts are read in stretches of CHUNK windows. An empty table gives no rows.
Columns named like the operator's own pass through without_repeats() unchanged."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .suffix_array import permuted_lcp, suffix_array

LENGTH, PIECE, SHARD_BYTES, HOT, CHUNK = 400, 32, 2_000_000, 8_000, 1 << 20
PLACE = np.uint64((1 << 24) - 1)  # more places than a stretch has
RUN = "uid long, start int, windows int, key long, d1 long, d2 long, self boolean, several boolean, deal long, whole boolean"
FOUND = "uid long, start int, windows int, key long, self boolean, several boolean, whole boolean"


def _minima(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return np.minimum(h[: len(h) - (width - k)], h[width - k :]) if width > k else h


def _keys(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the window at each place: its key, and the first and the last place in it of the piece that gave the key."""
    h = common.random_words(256, 11)[x]
    k, step = 1, 0
    while k < PIECE:
        h = h[:-k] * common.random_words(8, 12)[step : step + 1].__or__(np.uint64(1)) + h[k:]
        k, step = 2 * k, step + 1
    whole = common.mixed(h)
    h = whole & ~PLACE
    at = np.arange(len(h), dtype=np.uint64) & PLACE
    first = _minima(h | at, length - PIECE + 1)
    last = _minima(h | (PLACE - at), length - PIECE + 1)
    first = first & PLACE
    return whole[first.astype(np.int64)], first, PLACE - (last & PLACE)


def _stretches(at: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Runs of rows [a, b) with their bytes [first, past) and, for a stretch of one long text, its place in the text."""
    for a, b in common.spans(at, CHUNK):
        n = int(at[b] - at[a])
        if n < 2 * CHUNK:
            yield a, b, int(at[a]), int(at[b]), 0
            continue
        for place in range(0, n - length + 1, CHUNK):  # a single row
            yield a, b, int(at[a]) + place, min(int(at[b]), int(at[a]) + place + CHUNK + length - 1), place


def _period(x: np.ndarray, p: int, q: int, length: int, left: np.ndarray) -> int:
    """The period of the segment of windows [p, q), if it has one that makes every window repeat within it; else 0."""
    first = int(left[p])
    if first + 1 >= q:
        return 0
    period = int(left[first + 1]) - first
    past = q + length - 1
    return period if q - p >= 2 * period and np.array_equal(x[p + period : past], x[p : past - period]) else 0


def segments(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(uid, text) to one row for each segment. Where a batch holds a digest more than once, all but one of its segments are known to be repeated; these are
    dealt by chance, and the one is marked, so that a hot text gets a row a batch at most. A periodic segment becomes its first period, marked, and the rest of it."""

    def cut(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple:
        """Of the windows [begin, end) of each text: text, start, stop, key, digest, whether it may repeat within itself, whether it is known to be repeated, whether nothing else of it matters."""
        keys, left, right = _keys(x, length)
        place = np.union1d(np.flatnonzero(keys[1:] != keys[:-1]) + 1, begin)
        own = np.searchsorted(begin, place, "right") - 1
        inside = (own >= 0) & (place < end[np.maximum(own, 0)])
        place, own = place[inside], own[inside]
        stop = np.minimum(np.append(place[1:], len(x)), end[own])
        twice = left[place] != right[stop - 1]
        known, rest = np.zeros(len(place), bool), np.zeros(len(place), bool)
        more = []
        for i in np.flatnonzero(twice & (stop - place > length - PIECE + 1)).tolist():
            if period := _period(x, int(place[i]), int(stop[i]), length, left):
                more.append((own[i], place[i] + period, stop[i], keys[place[i]]))
                stop[i], twice[i], known[i] = place[i] + period, False, True
        view = memoryview(x)
        digest = b"".join([hashlib.blake2b(view[p:q], digest_size=16).digest() for p, q in zip(place.tolist(), (stop + length - 1).tolist(), strict=True)])
        two = np.frombuffer(digest, np.int64).reshape(-1, 2)
        columns = [own, place, stop, keys[place], two[:, 0], two[:, 1], twice, known, rest]
        if more:
            n = len(more)
            rows = [np.array(c) for c in zip(*more, strict=True)]
            columns = [np.concatenate([c, m.astype(c.dtype)]) for c, m in zip(columns, [*rows, np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n), np.ones(n)], strict=True)]
        return tuple(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            uid = common.column(batch, "uid").to_numpy()
            rows: list[tuple] = []
            for a, b, first, past, shift in _stretches(at, length):
                x = raw[first:past]
                if len(x) < length:
                    continue
                begin, end = np.maximum(at[a:b] - first, 0), np.minimum(at[a + 1 : b + 1] - first, len(x)) - length + 1  # of each text's windows
                doc = np.flatnonzero(end > begin)
                if not len(doc):
                    continue
                own, place, stop, key, d1, d2, twice, known, rest = cut(x, begin[doc], end[doc])
                rows.append((uid[a + doc[own]], (place - begin[doc][own] + shift).astype(np.int32), (stop - place).astype(np.int32), key.view(np.int64), d1, d2, twice, known, rest))
            if rows:
                *columns, known, rest = (np.concatenate(c) for c in zip(*rows, strict=True))
                d1, d2 = columns[4], columns[5]
                order = np.lexsort((d2, d1, rest))
                new = np.ones(len(order), bool)
                new[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
                whole = np.zeros(len(order), bool)
                whole[order] = ~new
                several = whole | known
                several[order] |= np.append(~new[1:], False)
                whole |= rest
                chance = common.mixed(columns[0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + columns[1].astype(np.uint64)).view(np.int64)
                columns += [several, np.where(whole, chance, d1), whole]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["uid", "start", "windows", "key", "d1", "d2", "self", "several", "deal", "whole"])

    return run


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order of digest (within whole and other rows) to those that are repeated as a whole, and one segment of each text. Holds a batch and one row."""
    names = ["uid", "start", "windows", "key", "self", "several", "whole"]
    held: list[np.ndarray] | None = None
    before: tuple | None = None  # the digest of the row before the held one

    def out(rows: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, before
        uid, start, windows, key, d1, d2, own, known = rows
        n = len(uid)
        m = n if last else n - 1  # the last row waits for the next one
        new = np.concatenate([[before != (d1[0], d2[0])], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])])
        ends = np.append(new[1:], True)
        again = ~new | ~ends | known
        for kind, chosen in ((True, again), (False, ends)):
            pick = np.flatnonzero(chosen[:m])
            if len(pick):
                yield pa.RecordBatch.from_arrays([pa.array(y) for y in (uid[pick], start[pick], windows[pick], key[pick], own[pick], again[pick], np.full(len(pick), kind))], names)
        if m:
            before = (d1[m - 1], d2[m - 1])
        held = None if last else [y[m:] for y in rows]

    for batch in batches:
        rows = [common.column(batch, x).to_numpy(zero_copy_only=False) for x in ("uid", "start", "windows", "key", "d1", "d2", "self", "several", "whole")]
        whole = rows.pop()
        if whole.any():  # settled before
            uid, start, windows, key, _, _, own, several = (y[whole] for y in rows)
            yield pa.RecordBatch.from_arrays([pa.array(y) for y in (uid, start, windows, key, own, several, whole[whole])], names)
            rows = [y[~whole] for y in rows]
        if len(rows[0]):
            yield from out([np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)] if held else rows, False)
    if held:
        yield from out(held, True)


def pieces(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(uid, text, wanted) to the bytes of each wanted segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            lists = common.column(batch, "wanted")
            flat, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
            start, windows, key, several, hot = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            uid = np.repeat(common.column(batch, "uid").to_numpy(), per)
            base = np.repeat(at[:-1], per) + start
            size = windows.astype(np.int64) + length - 1
            for a, b in common.spans(np.concatenate([[0], np.cumsum(size)]), 2 << 20):
                data = raw[common.gathered(base[a:b], size[a:b])]
                text = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size[a:b])]).astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([pa.array(key[a:b]), pa.array(uid[a:b]), pa.array(start[a:b]), pa.array(several[a:b]), pa.array(hot[a:b]), text], ["key", "uid", "start", "several", "hot", "bytes"])

    return run


def _shard(data: np.ndarray, at: np.ndarray, uid: np.ndarray, start: np.ndarray, several: np.ndarray, length: int) -> pa.RecordBatch:
    """The repeated windows of one shard's segments, as runs."""
    n, sizes = len(uid), np.diff(at)
    begin = at[:-1] + np.arange(n)  # one byte that UTF-8 never has stands between segments
    t = np.full(len(data) + n, 0xFF, np.uint8)
    t[common.gathered(begin, sizes)] = data
    sa = suffix_array(t)
    size, _ = permuted_lcp(t, sa)
    repeated = size >= length
    repeated[sa[:-1]] |= size[sa[1:]] >= length
    own = np.zeros(len(t) + 1, bool)  # windows that lie in their segment and are not known to be repeated
    single = np.flatnonzero(~several)
    own[common.gathered(begin[single], sizes[single] - length + 1)] = True
    repeated &= own[:-1]
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    seg = np.searchsorted(begin, first, "right") - 1
    return pa.RecordBatch.from_arrays([pa.array(uid[seg]), pa.array((start[seg] + first - begin[seg]).astype(np.int32)), pa.array((start[seg] + past - begin[seg] + length - 1).astype(np.int32))], ["uid", "first", "past"])


def shards(length: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments in order of key to runs of repeated bytes; a shard is closed at the first change of key past `shard_bytes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal kept, total
            parts, kept, total = kept, [], 0
            at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
            return _shard(np.concatenate([p[0] for p in parts]), at, *(np.concatenate([p[i] for p in parts]) for i in (2, 3, 4)), length)

        last = None
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "bytes"))
            key = common.column(batch, "key").to_numpy()
            uid, start = (common.column(batch, x).to_numpy() for x in ("uid", "start"))
            several = common.column(batch, "several").to_numpy(zero_copy_only=False)
            cuts = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)) if len(key) else []
            a = 0
            for i, b in enumerate(cuts):
                if total >= shard_bytes and key[a] != last:
                    yield close()
                if i < len(cuts) - 1 and total + at[b] - at[a] < shard_bytes and at[cuts[i + 1]] - at[a] + total < shard_bytes:
                    continue  # more keys fit
                kept.append((raw[at[a] : at[b]], at[a : b + 1], uid[a:b], start[a:b], several[a:b]))
                total, last, a = total + int(at[b] - at[a]), key[b - 1], b
        if kept:
            yield close()

    return run


def windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments of hot keys to one row for each window, with the digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "bytes"))
            uid, start = (common.column(batch, x).to_numpy() for x in ("uid", "start"))
            several = common.column(batch, "several").to_numpy(zero_copy_only=False)
            for a, b in common.spans(at, 1 << 18):
                n = np.diff(at[a : b + 1]) - length + 1
                seg = np.repeat(np.arange(a, b), n)
                place = common.gathered(at[a:b], n)
                view = memoryview(raw)
                digest = b"".join([hashlib.blake2b(view[p : p + length], digest_size=16).digest() for p in place.tolist()])
                two = np.frombuffer(digest, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(y)) for y in (two[:, 0], two[:, 1], uid[seg], (start[seg] + place - at[seg]).astype(np.int32), several[seg])], ["h1", "h2", "uid", "first", "several"])

    return run


def kept_bytes(as_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, text, found) to what stays of each text, with the removed spans. As text, without what a cut leaves of a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            found = common.column(batch, "found")
            ids = common.column(batch, "doc_id")
            for a, b in common.spans(at, 4 << 20):
                x = raw[at[a] : at[b]]
                edge = np.zeros(len(x) + 1, np.int32)
                part = found.slice(a, b - a)
                per = np.diff(part.offsets.to_numpy())
                flat = part.flatten()
                base = np.repeat(at[a:b] - at[a], per)
                np.add.at(edge, base + flat.field(0).to_numpy(), 1)
                np.add.at(edge, base + flat.field(1).to_numpy(), -1)
                gone = np.cumsum(edge)[:-1] > 0
                begin = at[a:b] - at[a]
                n = np.diff(at[a : b + 1])
                before = np.concatenate([[False], gone[:-1]])
                before[begin[n > 0]] = False
                opens = np.flatnonzero(gone & ~before)
                after = np.append(gone[1:], False)
                after[(begin + n - 1)[n > 0]] = False
                closes = np.flatnonzero(gone & ~after) + 1
                doc = np.searchsorted(begin, opens, "right") - 1
                spans_at = np.searchsorted(doc, np.arange(b - a + 1))
                spans = pa.ListArray.from_arrays(pa.array(spans_at.astype(np.int32)), pa.StructArray.from_arrays([pa.array((y - begin[doc]).astype(np.int64)) for y in (opens, closes)], ["first", "past"]))
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[begin + n] - total[begin]
                text = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(n - removed)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[~gone]))])
                if as_text:
                    text = pa.array([x.decode(errors="ignore") for x in text.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64)), spans, text, *(batch.column(i).slice(a, b - a) for i in range(3, batch.num_columns))], ["doc_id", "n_bytes", "n_removed", "spans", "kept", *batch.schema.names[3:]])

    return run


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, keep: list[str] | None = None, shard_bytes: int = SHARD_BYTES, hot: int = HOT, as_text: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text, others): doc_id, n_bytes, n_removed, spans (removed, first byte and the one past the last),
    kept (the bytes left, or with `as_text` the text), and the columns named in `keep`. A byte is removed if a `length`-byte string over it starts anywhere else too."""
    spark, keep = docs.sparkSession, keep or []
    docs = common.with_uid(docs.select("doc_id", "text", *keep))
    texts = docs.select("uid", "text")
    dealt = texts.transform(common.mapped, segments(length), RUN).repartition(common.parts(spark), "deal").sortWithinPartitions("d1", "d2")
    rows = dealt.transform(common.mapped, judged, FOUND)
    each = rows.filter("not whole")
    shared = each.groupBy("key").agg(F.count("*").alias("n"), F.max("self").alias("own")).filter("n > 1 or own").select("key", (F.col("n") > hot).alias("hot"))
    single = each.join(shared, "key").select("uid", "start", "windows", "key", "several", "whole", "hot")
    found = common.cut(rows.filter("whole").select("uid", "start", "windows", "key", "several", "whole", F.lit(False).alias("hot")).union(single))
    single = found.filter("not whole").select("uid", "start", "windows", "key", "several", "hot")
    is_hot = not single.filter("hot").isEmpty()
    wanted = single.groupBy("uid").agg(F.collect_list(F.struct("start", "windows", "key", "several", "hot")).alias("wanted"))
    dealt = docs.repartition(common.parts(spark), "uid")  # both joins by uid read this one exchange
    bits = dealt.select("uid", "text").join(wanted, "uid").transform(common.mapped, pieces(length), "key long, uid long, start int, several boolean, hot boolean, bytes binary")
    runs = bits.filter("not hot").repartition(common.parts(spark), "key").sortWithinPartitions("key").transform(common.mapped, shards(length, shard_bytes), "uid long, first int, past int")
    if is_hot:
        each = common.cut(bits.filter("hot").transform(common.mapped, windows(length), "h1 long, h2 long, uid long, first int, several boolean"))
        again = each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("several").alias("s")).filter("n > 1 or s").select("h1", "h2")
        runs = runs.union(each.filter("not several").join(again, ["h1", "h2"]).select("uid", "first", (F.col("first") + length).alias("past")))
    runs = runs.union(found.filter("whole").select("uid", F.col("start").alias("first"), (F.col("start") + F.col("windows") + length - 1).alias("past")))
    per = runs.groupBy("uid").agg(F.collect_list(F.struct("first", "past")).alias("found"))
    joined = dealt.join(per, "uid", "left").select("doc_id", "text", F.coalesce("found", F.array().cast("array<struct<first:int,past:int>>")).alias("found"), *keep)
    kinds = dict(docs.dtypes)
    return joined.transform(common.mapped, kept_bytes(as_text), ", ".join([f"doc_id {kinds['doc_id']}, n_bytes long, n_removed long, spans array<struct<first:long,past:long>>, kept {'string' if as_text else 'binary'}", *(f"`{c}` {kinds[c]}" for c in keep)]))


def without_repeats(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """docs with their repeated strings cut out of `text`, and n_chars, where there is one, counted anew. Bytes of a character that a cut
    leaves incomplete go too. Null texts become empty. No row goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = {c: f"c{i}" for i, c in enumerate(others)}  # whatever their names
    out = remove_repeats(docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(n) for c, n in names.items())), length=length, keep=list(names.values()), as_text=True)
    cell = lambda c: F.char_length("kept").cast(dict(docs.dtypes)["n_chars"]) if c == "n_chars" else F.col("kept") if c == "text" else F.col(names.get(c, c))
    return out.select(*(cell(c).alias(c) for c in docs.columns))
