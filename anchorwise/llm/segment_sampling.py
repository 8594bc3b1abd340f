"""SentencePiece encoding and decoding with sampled segmentations (operator 2): Gumbel top-k without replacement.

A text (blanks as U+2581, one in front) is a chain of words, as no piece goes on behind a non-blank with a blank. The lattice of a word has a node for
each place and an edge for each piece of the vocabulary, weighted by the model's score: alpha times the logarithm of a probability, or, where scores are the ranks of merges
(0, -1, -2 and so on), -alpha * ln(rank + 2), so pieces that the model scores out of reach weigh next to nothing; characters without a piece have one edge
of byte pieces. Backward sums turn weights into probabilities of edges, so a segmentation's probability is the product of its edges'.

The search is A-star over perturbed values, top down. The root's value is a Gumbel draw for log-probability 0, the best leaf below it is found by a plain walk
and has that value. The rest of the tree falls into one subtree for each token: all paths that leave the leaf's path there. A subtree's value is
a Gumbel draw at its log-probability, truncated at the value of the leaf it leaves. The greatest value on the queue is the next sample, which is walked
and splits its own subtree likewise. After k samples the next value is the threshold kappa; a sample of log-probability p has the inclusion score
1 - exp(-exp(p - kappa)), 1 if there is no further segmentation; long texts' scores are tiny, so their logarithms are given.

Draws are hashes of (doc_id, sample, place), so a row's samples don't depend on its partition; rows with equal doc_id and text
have equal samples, null ids count as 0. Null text is empty; an empty text has one sample without pieces. U+2581 in a text decodes
as a blank. Memory is bounded by the known words (`WORDS`) and one text's paths; a very long text is cut at blanks, but a very long word takes a step for each of its characters. Further columns don't matter, whatever their
names. An empty table gives no rows."""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

SAMPLES, ALPHA, WORDS = 2, 1.0, 300_000
BLANK, BYTES, FIRST = "▁", 3, 259  # ids of byte pieces begin at 3, those of other pieces at 259
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_FACTOR = 0xD6E8FEB86659FD93
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROUND = np.uint64(0xC2B2AE3D27D4EB4F)
OUT = "rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def words(text: str | None) -> list[str]:
    """The words of a text, each with its blanks in front."""
    if not text:
        return []
    if BLANK in text or "  " in text or text[-1] == " " or text[0] == " ":
        return _WORD.findall(BLANK + text.replace(" ", BLANK))
    return (BLANK + text.replace(" ", f" {BLANK}")).split(" ")


class _Rows:
    """Arrays that grow together."""

    def __init__(self, **kinds: type) -> None:
        self.n, self.data = 0, {k: np.zeros(1 << 14, t) for k, t in kinds.items()}

    def add(self, **more: np.ndarray) -> None:
        m = len(next(iter(more.values())))
        for k, x in more.items():
            have = self.data[k]
            if self.n + m > len(have):
                have = self.data[k] = np.concatenate([have[: self.n], np.zeros(max(len(have), m), have.dtype)])
            have[self.n : self.n + m] = x
        self.n += m

    def __getattr__(self, name: str) -> np.ndarray:
        return self.data[name]


class Lattices:
    """Lattices of words under one model, learned when first seen."""

    def __init__(self, path: str, alpha: float = ALPHA) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        raw = [bytes([i - BYTES]) if sp.is_byte(i) else b"" if i < BYTES else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.size = np.array([len(x) for x in raw], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        usable = [i for i in range(n) if raw[i] and not sp.is_byte(i) and not sp.is_unused(i) and not sp.is_control(i)]
        score = np.array([sp.get_score(i) for i in range(n)])
        own = score[usable]
        ranks = (own <= 0).all() and (own == np.round(own)).all()  # of merges; else logarithms of probabilities
        self.weight = alpha * (-np.log(2.0 - np.minimum(score, 0)) if ranks else score)
        self.byte_weight = -alpha * np.log(2.0 + n) if ranks else alpha * (own.min() - 10)
        self.weight[BYTES : BYTES + 256] = self.byte_weight
        self.longest = max(map(len, (pieces[i] for i in usable)), default=1)
        # An open table of pieces and of their beginnings (id -1) by the hash of their characters.
        self.table, self.ids = np.zeros(1 << 18, np.uint64), np.full(1 << 18, -2, np.int32)
        self.probes = 1
        slots: dict[int, int] = {}
        used: set[int] = set()
        for i in usable:
            h = 0
            for c in pieces[i]:
                h = (h ^ h >> 29 ^ (ord(c) + 1)) * _FACTOR % (1 << 64)  # _next() of one character
                if h not in slots:
                    slot, k = h >> 46, 1
                    while slot in used:
                        slot, k = (slot + 1) & ((1 << 18) - 1), k + 1
                    used.add(slot)
                    slots[h] = slot
                    self.table[slot], self.ids[slot] = h, -1
                    self.probes = max(self.probes, k)
            self.ids[slots[h]] = i
        self.words = _Rows(base=np.int64, end=np.int64)
        self.nodes = _Rows(first=np.int64, last=np.int64)
        self.edges = _Rows(src=np.int32, step=np.int16, id=np.int32, log=np.float64, cum=np.float64)
        self.clear()

    @staticmethod
    def _next(h: np.ndarray, chars: np.ndarray) -> np.ndarray:
        return (h ^ h >> np.uint64(29) ^ (chars.astype(np.uint64) + np.uint64(1))) * np.uint64(_FACTOR)

    def _look(self, h: np.ndarray) -> np.ndarray:
        """Ids of pieces; -1 for other beginnings of pieces, -2 for what begins none."""
        slot = (h >> np.uint64(46)).astype(np.int64)
        found, todo = np.full(len(h), -2, np.int32), np.arange(len(h))
        for _ in range(self.probes):
            at = self.table[slot[todo]]
            hit = at == h[todo]
            found[todo[hit]] = self.ids[slot[todo[hit]]]
            todo = todo[~hit & (at != 0)]
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << 18) - 1)
        return found

    def clear(self) -> None:
        """Forgets all words; the arrays' memory is used again."""
        self.known = common.Numbers()
        self.words.n = self.nodes.n = self.edges.n = 0

    def learn(self, words: list[str]) -> None:
        """words: those with the numbers behind the last known one."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), size)
        end = np.cumsum(size)[word]  # of each place's word, in places
        node = np.arange(len(chars)) + word  # each word has a node more than places
        src, step, ids = [], [], []
        h, place = np.zeros(len(chars), np.uint64), np.arange(len(chars))
        for k in range(1, self.longest + 1):
            inside = place + k <= end[place]
            place, h = place[inside], h[inside]
            if not len(place):
                break
            h = self._next(h, chars[place + k - 1])
            found = self._look(h)
            at, got = place, found
            if k == 1:
                c = chars[place].astype(np.int64)
                got = np.where(found >= 0, found, np.where(c < 0x80, BYTES + c, -2 - c))
            else:
                at, got = place[found >= 0], found[found >= 0]
            src.append(node[at])
            step.append(np.full(len(at), k))
            ids.append(got)
            place, h = place[found != -2], h[found != -2]
        # Long pieces first, so that walks find likely edges soon.
        src, step, ids = (np.concatenate(x[::-1]) for x in (src, step, ids))
        order = np.argsort(src, kind="stable")
        src, step, ids = src[order], step[order], ids[order]
        char = -2 - ids
        width = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
        weight = np.where(ids >= 0, self.weight[np.maximum(ids, 0)], self.byte_weight * width)
        total = np.zeros(len(chars) + len(words))
        ahead = end - np.arange(len(chars))
        order = np.argsort(ahead.astype(np.uint16) if int(ahead.max()) < 65536 else ahead, kind="stable")
        many = np.bincount(src, minlength=len(total))
        begin = np.cumsum(many) - many
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(ahead[order]) != 0, [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):  # from the words' ends on
            at = node[order[a:b]]
            own = common.gathered(begin[at], many[at])
            total[at] = np.logaddexp.reduceat(weight[own] + total[src[own] + step[own]], np.cumsum(many[at]) - many[at])
        log = weight + total[src + step] - total[src]
        first, last = begin, begin + many - 1
        # Sums within each node alone, so that draws don't depend on what else is learned.
        cum, head = np.exp(log), begin[many > 0]
        deep = many[many > 0]
        for k in range(1, int(deep.max(initial=0))):
            head, deep = head[deep > k], deep[deep > k]
            cum[head + k] += cum[head + k - 1]
        e, v, base = self.edges.n, self.nodes.n, np.cumsum(size + 1) - (size + 1)
        self.edges.add(src=src + v, step=step, id=ids, log=np.minimum(log, 0.0), cum=cum)
        self.nodes.add(first=first + e, last=last + e)
        self.words.add(base=base + v, end=base + size + v)

    def index(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, and where each text's begin and end."""
        if len(self.known) > WORDS:
            self.clear()
        size = [len(ws) for ws in texts]
        found = np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), np.int64, sum(size))
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        return found, np.concatenate([[0], np.cumsum(size)]).astype(np.int64)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each run of ids and their offsets, without the blank in front."""
        raw = self.raw[common.gathered(self.at[ids], self.size[ids])]
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[at]
        keep = np.ones(len(raw), bool)
        begins = ends[:-1][np.diff(ends) > 0]
        keep[begins[raw[begins] == 32]] = False
        gone = np.concatenate([[0], np.cumsum(~keep)])
        return raw[keep], ends - gone[ends]


@functools.lru_cache(2)
def lattices(path: str, alpha: float) -> Lattices:
    return Lattices(path, alpha)


def _uniform(seed: np.ndarray, kind: int, place: np.ndarray) -> np.ndarray:
    h = common.mixed((seed + np.uint64(kind * int(_ROUND) % (1 << 64))) ^ (place.astype(np.uint64) + np.uint64(1)) * _STEP)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _walk(lat: Lattices, node: np.ndarray, end: np.ndarray, seed: np.ndarray, shift: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Random paths from node to end for many words. Edges word by word, and their numbers."""
    first, last, cum, step = lat.nodes.first, lat.nodes.last, lat.edges.cum, lat.edges.step
    count = np.zeros(len(node), np.int64)
    who, found = [], []
    live = np.flatnonzero(node < end)
    node = node.copy()
    while len(live):
        at = node[live]
        u = _uniform(seed[live], kind, at + shift[live])
        e, stop = first[at], last[at]
        turn = np.flatnonzero((u >= cum[e]) & (e < stop))
        while len(turn):
            e[turn] += 1
            turn = turn[(u[turn] >= cum[e[turn]]) & (e[turn] < stop[turn])]
        who.append(live)
        found.append(e)
        count[live] += 1
        node[live] = at + step[e]
        live = live[node[live] < end[live]]
    out = np.empty(int(count.sum()), np.int64)
    at = np.cumsum(count) - count
    for w, e in zip(who, found, strict=True):
        out[at[w]] = e
        at[w] += 1
    return out, count


def sample_chunk(lat: Lattices, texts: list[list[str]], seeds: np.ndarray, k: int) -> list[list[tuple]]:
    """For each text of words: (edges, log-probability, perturbed value, logarithm of the inclusion score), the best first."""
    found, at = lat.index(texts)
    n = len(texts)
    logs = lat.edges.log
    base, end = lat.words.base[found], lat.words.end[found]
    # Draws go by a place in the text; shift turns a node into one.
    places = np.concatenate([[0], np.cumsum(end - base)])
    shift = places[:-1] - np.repeat(places[at[:-1]], np.diff(at)) - base
    words, bases, ends, shifts = ([x[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)] for x in (found, base, end, shift))
    queue: list[list] = [[] for _ in range(n)]
    leaves: list[list[tuple]] = [[] for _ in range(n)]  # (edges, word of each, value)
    kappa = np.full(n, -np.inf)
    start = [(0, None, 0.0, frozenset()) for _ in range(n)]  # token, leaf left, value, edges left at the token
    value = -np.log(-np.log(_uniform(seeds, 1, np.zeros(n, np.int64))))
    going = [d for d in range(n) if len(words[d])]
    for r in range(k):
        # Where each walk begins: a word in the middle, and all words behind it.
        heads, parts = {}, []
        for d in going:
            t, leaf, _, left = start[d]
            if leaf is None:
                parts.append((bases[d], ends[d], np.arange(len(words[d]))))
                continue
            edges, word = leaves[d][leaf][:2]
            node, w = int(lat.edges.src[edges[t]]), int(word[t])
            e, stop = int(lat.nodes.first[node]), int(lat.nodes.last[node])
            rest = [x for x in range(e, stop + 1) if x not in left]
            p = np.exp(logs[rest])
            c = np.cumsum(p)
            pick = rest[min(int(np.searchsorted(c, float(_uniform(seeds[d : d + 1], 500 + r, np.array([t]))[0]) * c[-1], "right")), len(rest) - 1)]
            gone = 1.0 - p.sum() + float(np.exp(logs[pick]))
            heads[d] = (edges[:t], word[:t], pick, w, left | {pick}, 1.0 - gone if len(rest) > 1 else 0.0)
            inside = node + int(lat.edges.step[pick])
            parts.append((np.concatenate([[inside], bases[d][w + 1 :]]), ends[d][w:], np.arange(w, len(words[d]))))
        if not parts:
            break
        size = [len(p[0]) for p in parts]
        who = np.repeat(going, size)
        found, count = _walk(lat, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), seeds[who], np.concatenate([shifts[d][p[2]] for d, p in zip(going, parts, strict=True)]), 2 + r)
        cut = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(size)])]
        token_word = np.repeat(np.concatenate([p[2] for p in parts]), count)
        # Subtrees that leave the new part of each path, valued all at once.
        new_log = logs[found]
        with np.errstate(divide="ignore", over="ignore"):
            beside = np.log(-np.expm1(new_log))
            noise = np.log(-np.log(_uniform(seeds[np.repeat(going, np.diff(cut))], 1000 + r, np.arange(len(found)) - np.repeat(cut[:-1], np.diff(cut)))))
        tops = []
        for i, d in enumerate(going):
            a, b = int(cut[i]), int(cut[i + 1])
            head = heads.get(d)
            edges, word, prefix, t0 = found[a:b], token_word[a:b], 0.0, 0
            if head:
                t0 = len(head[0])
                prefix = float(logs[head[0]].sum())
                edges = np.concatenate([head[0], [head[2]], edges])
                word = np.concatenate([head[1], [head[3]], word])
            leaf, m = len(leaves[d]), value[d]
            leaves[d].append((edges, word, m, prefix + (float(logs[head[2]]) if head else 0.0) + float(new_log[a:b].sum())))
            behind = prefix + (float(logs[head[2]]) if head else 0.0)
            if b > a:
                with np.errstate(invalid="ignore"):
                    phi = behind + np.cumsum(new_log[a:b]) - new_log[a:b] + beside[a:b]
                    v = -np.logaddexp(-m, noise[a:b] - phi)
                v[~np.isfinite(beside[a:b])] = -np.inf
                best = np.argpartition(v, -min(k, len(v)))[-min(k, len(v)) :] if len(v) > k else np.arange(len(v))
                for j in best.tolist():
                    if v[j] > -np.inf:
                        heapq.heappush(queue[d], (-float(v[j]), leaf, t0 + (1 if head else 0) + j, frozenset([int(found[a + j])])))
            if head and head[5] > 0:
                phi = prefix + float(np.log(head[5]))
                u = float(_uniform(seeds[d : d + 1], 2000 + r, np.array([t0]))[0])
                v = -float(np.logaddexp(-m, np.log(-np.log(u)) - phi))
                heapq.heappush(queue[d], (-v, leaf, t0, frozenset(head[4])))
            if queue[d]:
                v, leaf, t, left = heapq.heappop(queue[d])
                if r == k - 1:
                    kappa[d] = -v
                else:
                    value[d], start[d] = -v, (t, leaf, -v, left)
                    tops.append(d)
        going = tops
    out = []
    for d in range(n):
        rows = []
        for edges, _, m, p in leaves[d]:
            rows.append((edges, p, float(m), _log_inclusion(p - kappa[d])))
        out.append(rows or [(np.zeros(0, np.int64), 0.0, float(value[d]), 0.0)])
    return out


def _log_inclusion(x: float) -> float:
    """ln(1 - exp(-exp(x))), which for small x is x itself."""
    return x if x < -30 else 0.0 if x > 30 else float(np.log(-np.expm1(-np.exp(x))))


def _ids(lat: Lattices, edges: np.ndarray) -> np.ndarray:
    ids = lat.edges.id[edges]
    wide = np.flatnonzero(ids < 0)  # characters of several bytes without a piece
    if len(wide):
        raw = [chr(-2 - i).encode() for i in ids[wide].tolist()]
        many = np.ones(len(ids), np.int64)
        many[wide] = [len(x) for x in raw]
        at = (np.cumsum(many) - many)[wide]
        ids = np.repeat(ids, many)
        for a, x in zip(at.tolist(), raw, strict=True):
            ids[a : a + len(x)] = [BYTES + b for b in x]
    return ids


def _texts(lat: Lattices, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    found = []
    for a, b in common.spans(offsets, 1 << 18):
        raw, at = lat.decode(ids[offsets[a] : offsets[b]].astype(np.int64), offsets[a : b + 1] - offsets[a])
        found += [raw[x:y].tobytes().decode(errors="replace") for x, y in zip(at[:-1], at[1:], strict=True)]
    return pa.array(found, pa.string())


def sample(docs: DataFrame, path: str, *, k: int = SAMPLES, alpha: float = ALPHA, seed: int = 0, decoded: bool = False) -> DataFrame:
    """docs (doc_id, text) to one row for each sample: doc_id, rank, ids, log_prob, perturbed, log_inclusion; with `decoded` also text, as
    decode() would give it, without a second pass."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(path, alpha)
        for batch in batches:
            keys = common.column(batch, "doc_id").cast(pa.int64()).fill_null(0).to_numpy()
            seeds = common.mixed((keys.view(np.uint64) + np.uint64(seed)) * _STEP)
            text = common.column(batch, "text")
            _, at = common.utf8(text)
            for a, b in common.spans(at, 1 << 20):
                texts = [words(t) for t in text.slice(a, b - a).to_pylist()]
                rows = sample_chunk(lat, texts, seeds[a:b], k)
                flat = [_ids(lat, s[0]) for r in rows for s in r]
                many = [len(r) for r in rows]
                ids, ends = np.concatenate(flat).astype(np.int32), np.concatenate([[0], np.cumsum([len(x) for x in flat])])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                more = [_texts(lat, ids, ends)] if decoded else []
                yield pa.RecordBatch.from_arrays([
                    common.column(batch, "doc_id").take(pa.array(np.repeat(np.arange(a, b), many))), pa.array(np.concatenate([np.arange(m) for m in many]).astype(np.int32)), lists,
                    *(pa.array(np.array([s[i] for r in rows for s in r], float)) for i in (1, 2, 3)), *more,
                ], ["doc_id", "rank", "ids", "log_prob", "perturbed", "log_inclusion", *["text"] * decoded])

    return docs.select("doc_id", "text").transform(common.mapped, run, f"doc_id {kind}, {OUT}" + ", text string" * decoded)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Replaces the column `ids` by the text `out` that it stands for. Bytes that aren't UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattices(path, ALPHA)
        for batch in batches:
            lists = common.column(batch, ids)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            text = _texts(lat, lists.flatten().to_numpy(), offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i, n in enumerate(batch.schema.names) if n != ids), text], [*(n for n in batch.schema.names if n != ids), out])

    return df.transform(common.mapped, run, ", ".join(f"`{c}` {t}" for c, t in [*((c, t) for c, t in df.dtypes if c != ids), (out, "string")]))
