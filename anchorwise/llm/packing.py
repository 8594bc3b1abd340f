"""Packing into token sequences (operator 6): hierarchical, with several lengths.

Each input task packs its own rows, so nothing is shuffled and a lost task is made again alike. A document's ids end with `end`. Whole windows of
the longest tier are cut off first. The rest goes to the smallest tier that holds it. A piece of the longest tier opens a window, whose gap is
filled with the largest pieces of shorter tiers that fit, then by a cut of one more. What is left of shorter tiers is packed the same way into
windows of its own tier. At a task's end the last open window is cut into powers of two, so no sequence needs padding.
Sequences of each tier are dealt to step groups of equal token counts.

Null or empty texts have the end id alone. Very long texts are encoded as one; their whole windows go out at once. Columns but doc_id and text are not read. Rows with a null id and repeated rows are documents of their own. Empty tables give no rows."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common

LONGEST, TIERS, END, STEP_TOKENS, HELD, WORDS = 2048, (2048, 1024, 512, 256), 1, 65536, 1 << 19, 600_000
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_group long"


def _apart(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets a blank between a Latin letter and a last full stop or comma, where the tokenizer splits anyway, so that fewer words differ."""
    if len(raw) < 4:
        return raw, at
    mark = (raw == 46) | (raw == 44)
    mark[1:] &= ((raw[:-1] | 32) >= 97) & ((raw[:-1] | 32) <= 122) | np.concatenate([[False], (raw[:-2] == 0xC3) & (raw[1:-1] >= 0x80) & (raw[1:-1] <= 0xBF) & (raw[1:-1] != 0x97) & (raw[1:-1] != 0xB7)])
    mark[:-1] &= (raw[1:] == 32) | (raw[1:] == 10)
    mark[0] = mark[-1] = False
    mark[at[:-1][at[:-1] < len(raw)]] = False  # never across texts
    place = np.flatnonzero(mark)
    return np.insert(raw, place, 32), at + np.searchsorted(place, at)


_BETWEEN = b"\xff"  # stands behind each text; no byte of UTF-8


class Encoder:
    """Ids of whole texts. White space never reaches the ids, so a text is encoded by words (at ASCII blanks), each distinct one once."""

    def __init__(self, path: str, end: int = END) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.clear()
        # Words are encoded in lower case and apart from their punctuation and white space; a tokenizer for which that differs is refused.
        probe = "The Quick, brown\nfox. JUMPS over\tÉTÉ, naïve  Straße. x,y 3.14 (A.B) İ ΑΣ Ω don't"
        raw, at = common.utf8(pa.array([probe]))
        if self.encode(raw, at)[0].tolist() != [*self.tokenizer.encode(probe, add_special_tokens=False).ids, end]:
            raise ValueError(f"{path}: this tokenizer's ids depend on case, white space or neighbouring words")
        self.clear()

    def clear(self) -> None:
        self.known = common.Numbers(_BETWEEN)
        self.flat, self.at, self.size = np.array([self.end], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """words: those with the numbers behind the last known one."""
        texts = [w.decode(errors="replace") for w in words]
        ids, size = [], []
        for a in range(0, len(texts), 64):  # several in one call; a token belongs to the word in which it begins
            some = texts[a : a + 64]
            found = self.tokenizer.encode("\n".join(some), add_special_tokens=False)
            ids += found.ids
            past = np.cumsum([len(w) + 1 for w in some])
            size.append(np.diff(np.searchsorted([x[0] for x in found.offsets], past), prepend=0) if len(found.ids) else np.zeros(len(some), np.int64))
        size = np.concatenate(size)
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and offsets."""
        if len(self.known) > WORDS:
            self.clear()
        raw, at = _apart(raw, at)
        view = np.insert(raw, np.repeat(at[1:], 3), np.tile(np.frombuffer(b" %s " % _BETWEEN, np.uint8), len(at) - 1)).tobytes()
        if b"<|" not in view:  # else names of special tokens could arise
            view = view.lower()
        words = view.split()
        kinds = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        size = self.size[kinds]
        return self.flat[common.gathered(self.at[kinds], size)], np.concatenate([[0], np.cumsum(size)[kinds == 0]])


@functools.lru_cache(2)
def _encoder(path: str, end: int) -> Encoder:
    """Words stay known from task to task of a worker."""
    return Encoder(path, end)


class Packer:
    """Rows out of documents of ids. Holds about HELD ids of pieces at most."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers, self.task, self.sequences, self.held = tiers, task, 0, 0
        self.pools: list[list[tuple]] = [[] for _ in tiers]
        self.filled = dict.fromkeys(tiers, 0)  # tokens of each tier so far
        self.rows: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n, top = len(ids), self.tiers[0]
        for a in range(0, n - top + 1, top):
            self.window([(doc, n, a, ids[a : a + top])], top)
        if rest := n % top:
            self.pool((doc, n, n - rest, ids[n - rest :].copy()))
        if self.held > HELD:
            self.pack(0)
            if self.held > HELD // 2:
                self.pack(len(self.tiers) - 1)

    def pool(self, piece: tuple) -> None:
        k = max(i for i, t in enumerate(self.tiers) if t >= len(piece[3]))
        self.pools[k].append(piece)
        self.held += len(piece[3])

    def take(self, k: int) -> tuple:
        piece = self.pools[k].pop()
        self.held -= len(piece[3])
        return piece

    def window(self, pieces: list[tuple], length: int) -> None:
        """One sequence of `length` ids; shorter only at the end of all, in powers of two."""
        offset, number = 0, (self.task << 32) + self.sequences
        self.sequences += 1
        # A step group takes STEP_TOKENS of one tier; those at the end of a task may be smaller.
        group = (self.task << 32) + (self.filled.get(length, 0) // STEP_TOKENS) * 16 + length.bit_length()
        self.filled[length] = self.filled.get(length, 0) + length
        for doc, n, start, ids in pieces:
            self.rows.append((doc, start, len(ids), ids.astype("<u4", copy=False).tobytes(), n, number, offset, length, group))
            offset += len(ids)

    def pack(self, last: int, final: bool = False) -> None:
        """Packs tiers 0 to `last` into windows of their own lengths."""
        for k in range(last + 1):
            size = self.tiers[k]
            while any(self.pools[k:]) and (self.pools[k] or k == len(self.tiers) - 1):
                pieces, gap = [], size
                if self.pools[k]:
                    pieces.append(self.take(k))
                    gap -= len(pieces[0][3])
                while gap:
                    j = next((j for j in range(k + 1, len(self.tiers)) if self.pools[j] and len(self.pools[j][-1][3]) <= gap), None)
                    if j is None:  # none fits: cut one, from the shortest tier that has any
                        j = next((j for j in range(len(self.tiers) - 1, k - 1, -1) if self.pools[j]), None)
                    if j is None:
                        break
                    doc, n, start, ids = self.take(j)
                    pieces.append((doc, n, start, ids[:gap]))
                    if len(ids) > gap:
                        self.pool((doc, n, start + gap, ids[gap:]))
                    gap -= len(pieces[-1][3])
                if not gap:
                    self.window(pieces, size)
                elif final:
                    self.powers(pieces)
                else:  # nothing is left to fill it with now
                    for p in pieces:
                        self.pool(p)
                    return

    def powers(self, pieces: list[tuple]) -> None:
        left = sum(len(p[3]) for p in pieces)
        while left:
            length = 1 << (left.bit_length() - 1)
            own, need = [], length
            while need:
                doc, n, start, ids = pieces[0]
                own.append((doc, n, start, ids[:need]))
                if len(ids) > need:
                    pieces[0] = (doc, n, start + need, ids[need:])
                else:
                    pieces.pop(0)
                need -= len(own[-1][3])
            self.window(own, length)
            left -= length

    def finish(self) -> None:
        self.pack(len(self.tiers) - 1, True)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 9
        self.rows = []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(docs: DataFrame, path: str, *, tiers: tuple[int, ...] = TIERS, end: int = END) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset, sequence_tokens, step_group.
    `path`: a tokenizers file whose ids don't depend on white space. Tiers fall by powers of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(path, end), Packer(TaskContext.get().partitionId(), tiers)
        for batch in batches:
            raw, at = common.utf8(common.column(batch, "text"))
            names = common.column(batch, "doc_id").to_pylist()
            for a, b in common.spans(at, 1 << 20):
                ids, off = encoder.encode(raw[at[a] : at[b]], at[a : b + 1] - at[a])
                for i in range(a, b):
                    packer.add(names[i], ids[off[i - a] : off[i - a + 1]])
                yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select("doc_id", "text").transform(common.mapped, run, PIECE)
