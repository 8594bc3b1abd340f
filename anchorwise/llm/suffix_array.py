"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified, the leftmost-smaller substrings are sorted by induction and named, the string of their names is sorted the same way, level by level,
until all names differ, and the order of all suffixes is induced from that. The induction runs in numpy, for bytes a whole bucket at a
time, for names, which have many small buckets, a stretch of neighbouring buckets at a time. Runs of one letter are placed in one step. Each level has at most half the
places of the one below."""

from __future__ import annotations

import numpy as np

from . import common

#: Substrings longer than this are compared one by one, and so are the last `FEW` common prefixes.
LONG, FEW = 64, 32
#: Stretches of buckets, and places in one at least.
STRETCHES, STRETCH = 256, 256


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last suffix is larger than the (virtual) end, so False."""
    n = len(t)
    smaller = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(t[:-1] != t[1:])
        less = t[differs] < t[differs + 1]
        # An equal neighbour takes its type from the next place that differs.
        smaller[: n - 1] = np.concatenate([np.repeat(less, np.diff(np.concatenate([[-1], differs]))), np.zeros(n - 1 - (differs[-1] + 1 if len(differs) else 0), bool)])
    return smaller


def _place(sa: np.ndarray, at: np.ndarray, found: np.ndarray, chars: np.ndarray, sign: int) -> None:
    """Appends found to the buckets of chars, in order: forward from heads (sign 1) or backward from tails (sign -1)."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    sizes = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, sizes)
    sa[at[c] + sign * rank] = found[order]
    at[c[first]] += sign * sizes


def _runs(t: np.ndarray) -> np.ndarray:
    """For each place, how many equal bytes stand directly before it."""
    at = np.arange(len(t))
    first = np.concatenate([[True], t[1:] != t[:-1]])
    return at - np.maximum.accumulate(np.where(first, at, 0))


def _with_runs(now: np.ndarray, back: np.ndarray) -> np.ndarray:
    """`now` and, behind it, the places before each in its run of one byte: first those one place before, then those two places before, and so on."""
    more = back[now]
    if not more.any():
        return now
    step = common.gathered(np.ones(len(now), np.int64), more)
    return np.concatenate([now, (np.repeat(now, more) - step)[np.argsort(step, kind="stable")]])


def _induce(t: np.ndarray, smaller: np.ndarray, back: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from `seeds`, the leftmost-smaller suffixes in bucket order."""
    n = len(t)
    sa = np.full(n, -1, np.int64)
    ends = np.cumsum(counts)
    begins = ends - counts
    used = np.flatnonzero(counts)
    per = np.bincount(t[seeds], minlength=len(counts))
    seed_end = np.cumsum(per)
    heads = begins.copy()
    # Larger suffixes, left to right. The virtual end induces the last suffix first. Places of the own bucket all lie in runs behind those already there.
    sa[heads[t[n - 1]]] = n - 1
    heads[t[n - 1]] += 1
    for c in used:
        if heads[c] > begins[c]:
            now = _with_runs(sa[begins[c] : heads[c]], back)
            heads[c] = begins[c] + len(now)
            sa[begins[c] : heads[c]] = now
            j = now[now > 0] - 1
            j = j[~smaller[j] & (t[j] != c)]
            if len(j):
                _place(sa, heads, j, t[j], 1)
        if per[c]:
            j = seeds[seed_end[c] - per[c] : seed_end[c]] - 1  # a seed is never the first place
            if len(j):
                _place(sa, heads, j, t[j], 1)
    # Smaller suffixes, right to left.
    tails = ends - 1
    for c in used[::-1]:
        if tails[c] < ends[c] - 1:
            now = _with_runs(sa[tails[c] + 1 : ends[c]][::-1], back)
            tails[c] = ends[c] - 1 - len(now)
            sa[tails[c] + 1 : ends[c]] = now[::-1]
            j = now[now > 0] - 1
            j = j[smaller[j] & (t[j] != c)]
            if len(j):
                _place(sa, tails, j, t[j], -1)
        now = sa[begins[c] : heads[c]][::-1]
        j = now[now > 0] - 1
        j = j[smaller[j]]
        if len(j):
            _place(sa, tails, j, t[j], -1)
    return sa


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the leftmost-smaller substrings, in text order, equal ones with equal numbers."""
    length = np.zeros(len(t), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = len(t) - lms[-1] + 1  # reaches the virtual end: equal to no other
    p, q = ordered[:-1], ordered[1:]
    same = length[p] == length[q]
    at = np.flatnonzero(same)
    far = at[length[p[at]] > LONG]
    raw = t.tobytes() if len(far) else b""
    for i in far.tolist():  # few, as all lengths together are those of the text
        a, b, size = (int(x) * t.itemsize for x in (p[i], q[i], length[p[i]]))
        same[i] = max(a, b) + size <= len(raw) and raw[a : a + size] == raw[b : b + size]
    at = at[length[p[at]] <= LONG]
    k = 0
    while len(at):
        at = at[length[p[at]] > k]
        if not len(at):
            break
        a, b = p[at] + k, q[at] + k
        inside = np.maximum(a, b) < len(t)
        equal = inside.copy()
        equal[inside] = t[a[inside]] == t[b[inside]]
        same[at[~equal]] = False
        at = at[equal]
        k += 1
    name = np.zeros(len(t), np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms], int((~same).sum()) + 1


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffix array of a byte string (uint8)."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    smaller, back = _types(t), _runs(t)
    counts = np.bincount(t, minlength=256)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms):
        by_char = lms[np.argsort(t[lms], kind="stable")]
        sa = _induce(t, smaller, back, counts, by_char)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = sa[is_lms[sa]]
        names, k = _names(t, lms, ordered)
        if k < len(lms):
            ordered = lms[_ordered(names, k)]
    else:
        ordered = lms
    return _induce(t, smaller, back, counts, ordered)


def _filled(s: np.ndarray, smaller: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """_induce() for a string of numbers. What a stretch of buckets induces in other stretches is placed at once. What it induces in itself is little: these places
    are known beforehand, and go bucket by bucket, by the ranks of the places behind them."""
    n = len(s)
    ends = np.cumsum(counts)
    begins = ends - counts
    stretch = begins // max(STRETCH, n // STRETCHES)
    own = stretch[s]
    cuts = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1], [True]]))
    back = _runs(s)
    within = np.flatnonzero((own[:-1] == own[1:]) & (s[:-1] != s[1:]))
    runs = np.flatnonzero(s[:-1] == s[1:])
    sa, rank = np.full(n, -1, np.int64), np.empty(n, np.int64)
    slots = ends[s[seeds]] - np.cumsum(np.bincount(s[seeds], minlength=len(counts)))[s[seeds]] + np.arange(len(seeds))  # at the buckets' ends
    sa[slots] = seeds
    at = begins.copy()
    sa[at[s[n - 1]]] = n - 1  # first in its bucket, as larger than the virtual end
    at[s[n - 1]] += 1
    for sign, kind in ((1, ~smaller), (-1, smaller)):  # larger suffixes from the left, then smaller ones from the right
        inner = within[kind[within]]
        inner = inner[np.argsort(s[inner], kind="stable")]
        some = np.unique(np.concatenate([s[inner], s[runs[kind[runs]]]]))  # buckets with places of their own stretch
        low, high = np.searchsorted(s[inner], some), np.searchsorted(s[inner], some, "right")
        of = np.searchsorted(some, cuts)
        for k in range(len(cuts) - 1)[::sign]:
            first, past = begins[cuts[k]], ends[cuts[k + 1] - 1]
            here = sa[first:past]
            full = np.flatnonzero(here >= 0)
            rank[here[full]] = first + full
            for m in range(of[k], of[k + 1])[::sign]:
                c = some[m]
                e = inner[low[m] : high[m]]
                e = e[np.argsort(sign * rank[e + 1])]
                now = sa[begins[c] : at[c]] if sign > 0 else sa[at[c] + 1 : ends[c]][::-1]
                now = _with_runs(np.concatenate([now, e]), back)
                place = np.arange(begins[c], begins[c] + len(now)) if sign > 0 else np.arange(ends[c] - 1, ends[c] - 1 - len(now), -1)
                sa[place], rank[now] = now, place
                at[c] = place[-1] + sign
            now = here[here >= 0][::sign]
            j = now[now > 0] - 1
            j = j[kind[j] & (own[j] != stretch[cuts[k]])]
            if len(j):
                _place(sa, at, j, s[j], sign)
        if sign > 0:
            sa[slots] = -1
            at = ends - 1
    return sa


def _ordered(s: np.ndarray, k: int) -> np.ndarray:
    """The suffix array of a string of numbers below k, all of which occur."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller, counts = _types(s), np.bincount(s, minlength=k)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    ordered = lms
    if len(lms):
        sa = _filled(s, smaller, counts, lms[np.argsort(s[lms], kind="stable")])
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = sa[is_lms[sa]]
        names, k = _names(s, lms, ordered)
        if k < len(lms):
            ordered = lms[_ordered(names, k)]
    return _filled(s, smaller, counts, ordered)


def _common_from(raw: bytes, a: int, b: int) -> int:
    """The length of the common prefix of raw[a:] and raw[b:]."""
    n, size, step = len(raw) - max(a, b), 0, LONG
    while size < n:
        step = min(2 * step, n - size)
        if raw[a + size : a + size + step] == raw[b + size : b + size + step]:
            size += step
            continue
        x, y = (np.frombuffer(raw, np.uint8, step, p + size) for p in (a, b))
        return size + int(np.argmax(x != y))
    return size


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the length of the common prefix with the suffix before it in the array (0 for the first), and that
    suffix. Only the irreducible values are compared, eight bytes a step; each other one is its left neighbour's less 1."""
    n = len(t)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = phi >= 0
    left = known & (at > 0) & (phi > 0)
    reducible = left.copy()
    reducible[left] = t[at[left] - 1] == t[phi[left] - 1]
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    word = np.zeros(n + 1, np.uint64)
    for k in range(8):
        word[:n] |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    p = np.flatnonzero(known & ~reducible)
    q, size = phi[p], np.zeros(n, np.int64)
    length = np.zeros(len(p), np.int64)
    live = np.arange(len(p))
    while len(live) > FEW:
        a, b = p[live] + length[live], q[live] + length[live]
        more = np.maximum(a, b) + 8 <= n
        more[more] = word[a[more]] == word[b[more]]
        live = live[more]
        length[live] += 8
    raw = t.tobytes() if len(live) else b""
    for i in live.tolist():
        length[i] += _common_from(raw, int(p[i] + length[i]), int(q[i] + length[i]))
    live = np.arange(len(p))
    while len(live):
        a, b = p[live] + length[live], q[live] + length[live]
        more = np.maximum(a, b) < n
        more[more] = t[a[more]] == t[b[more]]
        live = live[more]
        length[live] += 1
    size[p] = length
    # From an irreducible place on, the value falls by 1 a step.
    base = np.where(~reducible, at, 0)
    base = np.maximum.accumulate(base)
    out = size[base] - (at - base)
    out[~known] = 0
    return np.maximum(out, 0), phi
