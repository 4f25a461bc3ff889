"""Suffix arrays by induced sorting and permuted common prefixes, on numpy arrays.

Suffixes are classed as larger (L) or smaller (S) than the one that follows. A leftmost-smaller (LMS)
suffix is an S one after an L one. The LMS substrings are sorted by one round of induction and named;
names that repeat are told apart by the names that follow, twice as many each time; a second round then induces
all suffixes from the sorted LMS ones. A round scans the array in stretches: a stretch ends before the first
slot that a suffix in it writes to, so each stretch is one vector operation and reads final slots only.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor; the end counts as smallest."""
    sign = np.r_[np.sign(np.diff(t.astype(np.int64))), -1]
    at = np.where(sign != 0, np.arange(len(t)), len(t))
    return sign[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _dealt(d: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``j`` by letter ``d``, in its order within a letter; the place within the letter; the letters and their counts."""
    order = np.argsort(d, kind="stable")
    ordered = d[order]
    first = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
    count = np.diff(first, append=len(d))
    return j[order], np.arange(len(d)) - np.repeat(first, count), ordered[first], count


def _induce(t: np.ndarray, smaller: np.ndarray, sizes: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes, induced from LMS suffixes that are in order within each first letter."""
    n, ends = len(t), np.cumsum(sizes)
    letter = t.astype(np.uint16 if len(sizes) <= 1 << 16 else np.int32)
    sa = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    if len(lms):
        j, place, values, count = _dealt(letter[lms], lms)
        sa[np.repeat(ends[values] - count, count) + place] = j
    head = ends - sizes
    sa[head[t[-1]]] = n - 1
    head[t[-1]] += 1
    at, step = 0, 4096
    while at < n:
        stop = min(n, at + step)
        seg = sa[at:stop]
        src = np.flatnonzero(seg > 0)
        j = seg[src] - 1
        ok = ~smaller[j]
        j = j[ok]
        if len(j):
            d = letter[j]
            first = int(head[d].min())
            if first < stop:
                stop = first
                ok = src[ok] + at < stop
                j, d = j[ok], d[ok]
            if len(j):
                j, place, values, count = _dealt(d, j)
                sa[np.repeat(head[values], count) + place] = j
                head[values] += count
        step = min(1 << 16, step * 2) if stop - at == step else max(64, step // 2) if stop - at < step // 4 else step
        at = stop
    tail, at, step = ends.copy(), n, 4096
    while at > 0:
        stop = max(0, at - step)
        seg = sa[stop:at][::-1]
        src = np.flatnonzero(seg > 0)
        j = seg[src] - 1
        ok = smaller[j]
        j = j[ok]
        if len(j):
            d = letter[j]
            last = int(tail[d].max()) - 1
            if last >= stop:
                stop = last + 1
                ok = at - 1 - src[ok] >= stop
                j, d = j[ok], d[ok]
            if len(j):
                j, place, values, count = _dealt(d, j)
                sa[np.repeat(tail[values] - 1, count) - place] = j
                tail[values] -= count
        step = min(1 << 16, step * 2) if at - stop == step else max(64, step // 2) if at - stop < step // 4 else step
        at = stop
    return sa


def _by_names(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Numbers of LMS suffixes, in order by the name they start with (``same``: as the one before), by all their names."""
    m = len(order)
    rank = np.full(m + 1, -1, np.int64)  # the first slot of those that are equal so far; the end comes before all
    rank[order] = np.maximum.accumulate(np.where(same, 0, np.arange(m)))
    slots = np.flatnonzero(same | np.r_[same[1:], False])
    bits, k = m.bit_length(), 1
    while len(slots):
        who = order[slots]
        pair = rank[who] << bits | rank[np.minimum(who + k, m)] + 1
        if 3 * bits < 64:
            pair = pair << bits | who
            pair.sort()
            who, pair = pair & (1 << bits) - 1, pair >> bits
        else:
            by = np.argsort(pair, kind="stable")
            who, pair = who[by], pair[by]
        new = np.r_[True, pair[1:] != pair[:-1]]
        order[slots] = who
        rank[who] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.r_[new[1:], True])]
        k *= 2
    return order


def suffix_array(t: np.ndarray, letters: int) -> np.ndarray:
    """The suffixes of ``t`` (values below ``letters``) in ascending order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    smaller = _types(t)
    sizes = np.bincount(t, minlength=letters)
    is_lms = np.r_[False, smaller[1:] & ~smaller[:-1]]
    lms = np.flatnonzero(is_lms)
    sa = _induce(t, smaller, sizes, lms)
    if len(lms) < 2:
        return sa
    ordered = sa[is_lms[sa]]
    length = np.zeros(n, np.int64)
    length[lms] = np.diff(np.r_[lms, n]) + 1
    size = length[ordered]
    same = np.r_[False, size[1:] == size[:-1]]
    same[1:] &= (ordered[1:] != lms[-1]) & (ordered[:-1] != lms[-1])
    live, k = np.flatnonzero(same), 0
    while len(live):
        equal = t[ordered[live] + k] == t[ordered[live - 1] + k]
        same[live[~equal]] = False
        k += 1
        live = live[equal]
        live = live[size[live] > k]
    number = np.cumsum(is_lms) - 1
    return _induce(t, smaller, sizes, lms[_by_names(number[ordered], same)])


def common_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position its predecessor in the array (-1: none) and the length they share, up to ``most``.

    Where the letters before both are equal, the shared length is one less than that of the position
    before. Only the other positions, and ``starts``, are compared letter by letter, eight at a time.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = (before[1:] < 1) | (before[:-1] < 0) | (t[:-1] != t[np.maximum(before[1:] - 1, 0)])
    fresh[starts] = True
    at = np.flatnonzero(fresh)
    other, shared = before[at], np.zeros(len(at), np.int64)
    words = None
    if t.max(initial=0) < 256:  # the eight letters from each position on as one number
        words = np.ndarray(n, np.uint64, np.r_[t.astype(np.uint8), np.zeros(8, np.uint8)], strides=(1,)).copy()
    live = np.flatnonzero(other >= 0)

    def room(rows: np.ndarray, step: int) -> np.ndarray:
        return (np.maximum(at[rows], other[rows]) + shared[rows] + step <= n) & (shared[rows] + step <= most)

    if words is not None:
        wide = live
        while len(wide):
            wide = wide[room(wide, 8)]
            wide = wide[words[at[wide] + shared[wide]] == words[other[wide] + shared[wide]]]
            shared[wide] += 8
    while len(live):
        live = live[room(live, 1)]
        live = live[t[at[live] + shared[live]] == t[other[live] + shared[live]]]
        shared[live] += 1
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    value = np.zeros(n, np.int64)
    value[at] = shared
    return before, np.maximum(value[last] - (np.arange(n) - last), 0)
