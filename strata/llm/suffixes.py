"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour; the
leftmost S suffixes (LMS) of runs cut the text into substrings. One pass of induced
sorting orders these substrings; equal ones get equal names; the names' order is
refined by doubling (the recursion, cut off at the ``depth`` that is asked for); a
second pass induces all suffixes from the sorted LMS ones. Passes go bucket by bucket;
inside a bucket whole blocks of suffixes are induced at once.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a number; ``text`` has 8 bytes more than needed."""
    n = len(text) - 8
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        size = (n - k + 7) // 8
        out[k::8] = np.frombuffer(text, np.uint64, size, k) if (k + size * 8) <= len(text) else 0
    return out


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour; the last one counts so."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    ahead = np.where(differs, np.arange(n), n)
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]  # the next place where a change follows
    smaller = np.append(text[:-1] < text[1:], True)
    return smaller[ahead]


class _Buckets:
    def __init__(self, text: np.ndarray):
        self.counts = np.bincount(text, minlength=int(text.max()) + 1)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.chars = np.flatnonzero(self.counts)


def _put(sa: np.ndarray, items: np.ndarray, chars: np.ndarray, fill: np.ndarray, step: int) -> None:
    """Append ``items`` to the buckets of their ``chars``, in order, moving ``fill`` by ``step``."""
    order = np.argsort(chars, kind="stable")
    sorted_chars = chars[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_chars[1:] != sorted_chars[:-1]]))
    sizes = np.diff(np.append(heads, len(order)))
    rank = np.arange(len(order)) - np.repeat(heads, sizes)
    places = fill[sorted_chars] + (rank if step > 0 else -1 - rank)
    sa[places] = items[order]
    fill[sorted_chars[heads]] += step * sizes


def _induce(text: np.ndarray, is_s: np.ndarray, buckets: _Buckets, lms: np.ndarray) -> np.ndarray:
    """All suffixes, from LMS ones in the order given."""
    n = len(text)
    sa = np.full(n, -1, np.int64)
    tails = buckets.ends.copy()
    _put(sa, lms[::-1], text[lms[::-1]], tails, -1)
    heads = buckets.starts.copy()

    def add_l(block: np.ndarray) -> None:
        before = block[block > 0] - 1
        before = before[~is_s[before]]
        if len(before):
            _put(sa, before, text[before], heads, 1)

    for c in buckets.chars:
        at = buckets.starts[c]
        while at < heads[c]:
            at, block = heads[c], sa[at : heads[c]]
            add_l(block)
        add_l(sa[tails[c] : buckets.ends[c]])
    tails = buckets.ends.copy()
    last = tails.copy()

    def add_s(block: np.ndarray) -> None:
        before = block[block > 0] - 1
        before = before[is_s[before]]
        if len(before):
            _put(sa, before, text[before], tails, -1)

    tails[text[n - 1]] -= 1  # the end of the text has no suffix that induces it
    sa[tails[text[n - 1]]] = n - 1
    for c in buckets.chars[::-1]:
        at = last[c]
        while at > tails[c]:
            at, block = tails[c], sa[tails[c] : at][::-1]
            add_s(block)
        add_s(sa[buckets.starts[c] : heads[c]][::-1])
    return sa


def _names(text: np.ndarray, lms_sorted: np.ndarray, next_lms: np.ndarray) -> np.ndarray:
    """Equal numbers for equal LMS substrings that stand next to each other in order."""
    a, b = lms_sorted[:-1], lms_sorted[1:]
    size_a, size_b = next_lms[a] - a, next_lms[b] - b
    same = size_a == size_b
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        equal = text[np.minimum(a[active] + k, len(text) - 1)] == text[np.minimum(b[active] + k, len(text) - 1)]
        same[active[~equal]] = False
        active = active[equal]
        active = active[size_a[active] > k]
        k += 1
    return np.concatenate([[0], np.cumsum(~same)])


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their next ``depth`` characters (at least)."""
    text = np.asarray(text)
    n = len(text)
    if n < 2:
        return np.arange(n)
    is_s = _types(text)
    lms_flag = np.concatenate([[False], is_s[1:] & ~is_s[:-1]])
    lms = np.flatnonzero(lms_flag)
    buckets = _Buckets(text)
    if not len(lms):
        return _induce(text, is_s, buckets, lms)
    first = _induce(text, is_s, buckets, lms)
    by_substring = first[lms_flag[first]]
    next_lms = np.full(n, n, np.int64)
    next_lms[lms] = np.append(lms[1:], n - 1)
    place = np.full(n, 0, np.int64)
    place[lms] = np.arange(len(lms))
    rank = np.empty(len(lms), np.int64)
    rank[place[by_substring]] = _names(text, by_substring, next_lms)
    order, length = place[by_substring], 1
    while rank[order[-1]] < len(lms) - 1 and 2 * length <= depth:  # an LMS substring takes two characters at least
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-length] = rank[length:] + 1
        key = rank * (len(rank) + 1) + ahead
        order = np.argsort(key, kind="stable")
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        length *= 2
    return _induce(text, is_s, buckets, lms[order])


def agrees(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the stretches of ``depth`` bytes from ``a`` and ``b`` on are equal."""
    same = np.ones(len(a), bool)
    padded = words_at(np.concatenate([text, np.zeros(depth + 16, np.uint8)]))
    for k in [*range(0, depth - 7, 8), depth - 8]:
        same[same] = padded[a[same] + k] == padded[b[same] + k]
    return same


def permuted_matches(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each position, in text order: is its common prefix with the suffix before it ``depth`` or more.

    ``order`` may leave suffixes out; those in it have ``depth`` characters of ``text`` at least.
    """
    before = np.full(len(text), -1, np.int64)
    before[order[1:]] = order[:-1]  # the suffix before each, permuted to text order
    at = np.flatnonzero(before >= 0)
    out = np.zeros(len(text), bool)
    out[at] = agrees(text, at, before[at], depth)
    return out
