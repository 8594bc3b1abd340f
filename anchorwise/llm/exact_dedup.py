"""Exact dedup (operator 7): a minimal perfect hash over historical digests.

Texts are equal when they are identical after lower-casing A-Z; the digest is the SHA-256 of those bytes. The history is a
table of distinct digests, each with the locator of its winner (doc_id, and uid among repeated rows) and a count. It is dealt
to shards by digest. Each shard gets a minimal perfect hash of several levels of bits: a key lies at the first level where
it is alone on its bit, and the number of bits set before is its slot. A slot holds the full digest and the locator, so that
a lookup is confirmed byte by byte. Rows whose digest is not in the history are grouped among themselves.

Null text counts as empty. A null doc_id is smaller than any other. Of repeated rows with the winning doc_id one stays.
A very long text is hashed whole, by the task that reads it; only its digest travels. Further columns don't matter here and pass drop_copies(), whatever their names.
An empty table gives no rows; an empty history leaves all rows to the second grouping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Distinct digests in a shard, rows in one lookup, bits a key at each level.
SHARD_KEYS, LOOKUP_ROWS, GAMMA, LEVELS = 8192, 32768, 2, 48
#: Rows of two numbers that are broadcast at most.
SMALL = 1_000_000
INDEX = "shard int, n int, levels array<binary>, digests binary, winners array<long>, uids binary, sizes binary"
LOOKED = "doc_id long, uid long, digest binary, keep_id long, keep_uid long, group_size long, member boolean"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = common.utf8(common.column(batch, "text"))
        view, at = raw.tobytes(), at.tolist()
        found = [hashlib.sha256(view[a:b].lower()).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([common.column(batch, "uid"), common.column(batch, "doc_id"), pa.array(found, pa.binary())], ["uid", "doc_id", "digest"])


def digests(docs: DataFrame) -> DataFrame:
    """uid, doc_id, digest of each row."""
    return common.with_uid(docs.select("doc_id", "text")).transform(common.mapped, _digest, "uid long, doc_id long, digest binary")


def history(rows: DataFrame, least: int = 1) -> DataFrame:
    """Distinct digests of digests()' rows that occur `least` times or more, with winner and count."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "uid")).alias("w"), F.count("*").alias("size")).filter(F.col("size") >= least).select("digest", F.col("w.doc_id").alias("winner"), F.col("w.uid").alias("winner_uid"), "size")


def _shard(shards: int) -> F.Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def _words(column: pa.Array) -> np.ndarray:
    """Digests as rows of four 64-bit words."""
    raw, _ = common.utf8(column)
    return np.frombuffer(raw.tobytes(), np.uint64).reshape(-1, 4)


def _bit(key: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (common.mixed(key + seed) >> np.uint64(11)) % np.uint64(size)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys; for other keys any slot or none."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.bits = levels
        before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.rank = [b + np.cumsum(x) - x for b, x in zip(before[:-1], levels, strict=True)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) >= LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, GAMMA * len(left))
            at = _bit(left, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """-1 for keys that no level knows."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.bits, self.rank, strict=True)):
            at = _bit(keys[todo], level, len(bits)).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        return out


def _build(table: pa.Table) -> pa.Table:
    words = _words(table["digest"])
    # Two words make the key: equal first words of different digests stay apart.
    key = words[:, 0] ^ (words[:, 1] * np.uint64(0xD6E8FEB86659FD93))
    mph = PerfectHash.build(key)
    slot = mph.slots(key)
    order = np.empty(len(slot), np.int64)
    order[slot] = np.arange(len(slot))
    levels = [np.packbits(x).tobytes() + len(x).to_bytes(8, "little") for x in mph.bits]
    winners = table["winner"].combine_chunks().take(pa.array(order))
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "n": pa.array([len(slot)], pa.int32()), "levels": pa.array([levels], pa.list_(pa.binary())), "digests": pa.array([words[order].tobytes()], pa.binary()),
        "winners": pa.array([winners.to_pylist()], pa.list_(pa.int64())), "uids": pa.array([table["winner_uid"].to_numpy()[order].tobytes()], pa.binary()), "sizes": pa.array([table["size"].to_numpy()[order].tobytes()], pa.binary()),
    })


def _look(rows: pa.Table, index: pa.Table) -> pa.Table:
    words = _words(rows["digest"])
    n = len(words)
    member, keep, keep_uid, size = np.zeros(n, bool), [None] * n, np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n and index.num_rows:
        levels = [np.unpackbits(np.frombuffer(x[:-8], np.uint8), count=int.from_bytes(x[-8:], "little")).astype(bool) for x in index["levels"][0].as_py()]
        stored = np.frombuffer(index["digests"][0].as_py(), np.uint64).reshape(-1, 4)
        slot = PerfectHash(levels).slots(words[:, 0] ^ (words[:, 1] * np.uint64(0xD6E8FEB86659FD93)))
        member = slot >= 0
        member[member] = (stored[slot[member]] == words[member]).all(1)
        at = slot[member]
        keep_uid[member] = np.frombuffer(index["uids"][0].as_py(), np.int64)[at]
        size[member] = np.frombuffer(index["sizes"][0].as_py(), np.int64)[at]
        winners = index["winners"].combine_chunks().flatten()
        keep = winners.take(pa.array(np.where(member, slot, 0))) if len(winners) else keep
    keep = keep if isinstance(keep, pa.Array) else pa.nulls(n, pa.int64())
    return pa.table({"doc_id": rows["doc_id"], "uid": rows["uid"], "digest": rows["digest"], "keep_id": keep, "keep_uid": pa.array(keep_uid), "group_size": pa.array(size), "member": pa.array(member)})


def deduplicate(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows: digests(); known: history(). Per row: doc_id, uid, digest, keep_id, keep_uid, group_size, kept, member.
    Members of the history get its winner and count; nonmembers those of their own group."""
    known = common.cut(known)
    n, keys = rows.count(), known.count()
    shards = max(1, -(-keys // SHARD_KEYS), -(-n // LOOKUP_ROWS))
    known, rows = known.withColumn("shard", _shard(shards)), rows.withColumn("shard", _shard(shards))
    # A shard of a hot digest is looked up in several parts. At most n / LOOKUP_ROWS shards have more than one.
    salts = known.groupBy("shard").agg(F.ceil(F.sum("size") / LOOKUP_ROWS).cast("int").alias("salts")).filter("salts > 1")
    if n // LOOKUP_ROWS <= SMALL:
        salts = F.broadcast(salts)
    index = known.groupBy("shard").applyInArrow(_build, INDEX)
    index = index.join(salts, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    rows = rows.join(salts, "shard", "left").withColumn("salt", F.pmod(F.xxhash64("uid"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    looked = common.cut(rows.groupBy("shard", "salt").cogroup(index.groupBy("shard", "salt")).applyInArrow(_look, LOOKED))
    rest = looked.filter("not member").select("doc_id", "uid", "digest")
    own = rest.groupBy("digest").agg(F.max(F.struct("doc_id", "uid")).alias("w"), F.count("*").alias("group_size"))
    rest = rest.join(common.cut(own), "digest").select("doc_id", "uid", "digest", F.col("w.doc_id").alias("keep_id"), F.col("w.uid").alias("keep_uid"), "group_size", F.lit(False).alias("member"))
    out = looked.filter("member").select(rest.columns).union(rest)
    return out.withColumn("kept", F.col("uid") == F.col("keep_uid"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The table against its own history: a first pass finds the digests that it repeats, the second looks all rows up."""
    rows = common.cut(digests(docs))
    return deduplicate(rows, history(rows, 2))


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs without the rows that exact_dedup() does not keep. Any names of other columns pass."""
    docs, key = common.settled(docs), common.free(docs, "uid")
    stay = exact_dedup(docs).filter("kept").select(F.col("uid").alias(key))
    return common.with_uid(docs, key).join(stay, key, "left_semi").drop(key)
