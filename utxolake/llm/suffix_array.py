"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard.

The text has a byte alphabet: the two induction scans run bucket by bucket, all entries
of a bucket's part at once (an entry may only fill later buckets, or later places of its own).
The reduced string, whose alphabet is as large as it is long, is sorted by prefix doubling.
"""

from __future__ import annotations

import numpy as np


def _classify(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S-type flags (a suffix smaller than the next one) and the leftmost-S positions in order."""
    n = len(t)
    s = np.empty(n, bool)
    s[-1] = True
    differs = np.flatnonzero(t[:-1] != t[1:])  # equal neighbours take the type of what follows
    nxt = np.repeat(differs, np.diff(differs, prepend=-1))  # the last two differ
    s[:-1] = t[nxt] < t[nxt + 1]
    return s, np.flatnonzero(s[1:] & ~s[:-1]) + 1


def _by_bucket(values: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by character: values, their characters, ranks within, and the start of each character."""
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    first = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
    rank = np.arange(len(chars)) - np.repeat(first, np.diff(np.append(first, len(chars))))
    return values[order], chars, rank, first


def _induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """The suffix array induced from leftmost-S positions in the order given within each character."""
    n = len(t)
    sa = np.full(n, -1, np.int32)
    count = np.bincount(t, minlength=size)
    end = np.cumsum(count)
    start = end - count
    values, chars, rank, _ = _by_bucket(lms, t[lms])
    lms_count = np.bincount(chars, minlength=size)
    seeds = [values[a:b] for a, b in zip(np.cumsum(lms_count) - lms_count, np.cumsum(lms_count), strict=True)]
    present = np.flatnonzero(count)
    fill = start.copy()

    def put(entries: np.ndarray, wanted: bool, up: bool) -> None:
        before = entries[entries > 0] - 1
        before = before[s[before] == wanted]
        if not len(before):
            return
        values, chars, rank, first = _by_bucket(before, t[before])
        if up:
            sa[fill[chars] + rank] = values
            fill[chars[first]] += np.diff(np.append(first, len(chars)))
        else:
            sa[fill[chars] - 1 - rank] = values
            fill[chars[first]] -= np.diff(np.append(first, len(chars)))

    for c in present:  # larger suffixes, left to right
        at = start[c]
        while at < fill[c]:
            upto = fill[c]
            put(sa[at:upto], False, True)
            at = upto
        put(seeds[c], False, True)
    l_end = fill
    fill = end.copy()
    for c in present[::-1]:  # smaller suffixes, right to left
        at = end[c]
        while at > fill[c]:
            down = fill[c]
            put(sa[down:at][::-1], True, False)
            at = down
        put(sa[start[c] : l_end[c]][::-1], True, False)
    sa[0] = n - 1  # the end mark has no successor to induce it
    return sa


def _doubled(order: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Suffix array of a string whose entries ``order`` lists by character, and ``names`` gives their characters. Its
    last character is its only smallest.

    Suffixes that agree in their first ``depth`` characters are sorted by the rank of what follows these. None of them
    reaches the end there, since its character would set it apart.
    """
    order = order.astype(np.int64)
    key, place = names, np.arange(len(order))  # of the entries that still have an equal
    rank = np.empty(len(order), np.int64)
    depth = 0
    while True:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        rank[order[place]] = np.repeat(place[first], count)
        place = place[np.repeat(count > 1, count)]
        if not len(place):
            return order
        depth = 2 * depth or 1
        entries = order[place]
        key = rank[entries] * len(order) + rank[entries + depth]
        by = np.argsort(key)
        key = key[by]
        order[place] = entries[by]


def _same_substrings(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of leftmost-S substrings, which ``order`` lists sorted: equal ones share a name."""
    length = np.zeros(len(t), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = order[:-1], order[1:]
    open_ = np.flatnonzero(length[a] == length[b])
    new = np.ones(len(order), np.int64)
    at = 0
    while len(open_):
        open_ = open_[t[a[open_] + at] == t[b[open_] + at]]
        at += 1
        done = length[a[open_]] <= at
        new[open_[done] + 1] = 0
        open_ = open_[~done]
    return np.cumsum(new) - 1


def suffix_array(t: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``t`` over 0..size-1, whose last character is its only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    s, lms = _classify(t)
    sa = _induce(t, s, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names = _same_substrings(t, order, lms)
    if names[-1] + 1 < len(lms):
        index = np.empty(n, np.int32)
        index[lms] = np.arange(len(lms))
        order = lms[_doubled(index[order], names)]
    return _induce(t, s, order, size)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position, the common prefix, up to ``most``, with the suffix before it in the array.

    Only positions whose preceding characters differ from their neighbour's are compared, and every
    ``most``-th one; any other has the value of the position before it less one.
    """
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    i = np.arange(1, n)
    free = np.ones(n, bool)
    free[1:] = (before[1:] <= 0) | (t[i - 1] != t[before[1:] - 1])
    free[::most] = True  # so that a value compared up to twice ``most`` is never carried too far
    starts = np.flatnonzero(free)
    value = np.zeros(len(starts), np.int64)
    open_ = np.flatnonzero(before[starts] >= 0)
    at, limit = 0, n - np.maximum(starts, before[starts])
    while len(open_) and at < 2 * most:
        open_ = open_[limit[open_] > at]
        open_ = open_[t[starts[open_] + at] == t[before[starts[open_]] + at]]
        at += 1
        value[open_] = at
    index = np.cumsum(free) - 1
    return np.minimum(np.maximum(value[index] - (np.arange(n) - starts[index]), 0), most)
