"""Word-level suffix arrays in numpy: building, searching, longest matches.

A text is an array of word numbers (1..V); 0 separates texts and never occurs
in a searched text, so no match runs over a separator.
"""

from __future__ import annotations

import numpy as np


def build(ids: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in lexicographic order of their first ``depth`` words.

    Prefix tripling: ranks of h words give ranks of 3h words by one sort of
    packed keys.  It ends early once all ranks differ.  Searches for texts of
    up to ``depth`` words need no deeper order.
    """
    n = len(ids)
    rank = ids.astype(np.int64)
    order = np.argsort(rank)
    h = 1
    while h < depth and n:
        bits = int(rank.max()).bit_length()
        fold = 3 if 3 * bits <= 63 else 2
        key = rank.copy()
        for k in range(1, fold):
            key <<= bits
            if k * h < n:
                key[:n - k * h] |= rank[k * h:]
        order = np.argsort(key)
        ordered = key[order]
        step = np.ones(n, np.int64)
        step[1:] = ordered[1:] != ordered[:-1]
        dense = np.cumsum(step)
        rank = np.empty(n, np.int64)
        rank[order] = dense
        h *= fold
        if dense[-1] == n:
            break
    return order


def _compare(ids: np.ndarray, at: np.ndarray, query: np.ndarray, q_at: np.ndarray,
             q_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common length (at most ``q_len``) of text suffixes and queries, and
    whether the suffix sorts before its query; only undecided pairs go on."""
    n = len(ids)
    same = np.zeros(len(at), np.int64)
    less = np.zeros(len(at), bool)
    todo = np.flatnonzero((q_len > 0) & (at >= 0) & (at < n))
    less[at >= n] = True
    k = 0
    while len(todo):
        pos = at[todo] + k
        inside = pos < n
        t = np.where(inside, ids[np.minimum(pos, n - 1)], 0)
        q = query[q_at[todo] + k]
        equal = t == q
        less[todo] = ~equal & (t < q)
        todo = todo[equal]
        k += 1
        same[todo] = k
        todo = todo[q_len[todo] > k]
    return same, less


def lower_bound(ids: np.ndarray, order: np.ndarray, query: np.ndarray, q_at: np.ndarray,
                q_len: np.ndarray, after_equal: bool = False) -> np.ndarray:
    """Binary search of all queries at once: the first place in ``order``
    whose suffix is not below its query (with ``after_equal``: above it)."""
    lo = np.zeros(len(q_at), np.int64)
    hi = np.full(len(q_at), len(order), np.int64)
    while len(active := np.flatnonzero(lo < hi)):
        mid = (lo[active] + hi[active]) >> 1
        same, less = _compare(ids, order[mid], query, q_at[active], q_len[active])
        below = less | (same == q_len[active]) if after_equal else less
        lo[active[below]] = mid[below] + 1
        hi[active[~below]] = mid[~below]
    return lo


def longest(ids: np.ndarray, order: np.ndarray, query: np.ndarray, q_at: np.ndarray,
            q_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query the longest prefix that occurs in the text, and one place in
    ``order`` where it does: it is a neighbour of the query's own place."""
    place = lower_bound(ids, order, query, q_at, q_len)
    if not len(order):
        return np.zeros(len(q_at), np.int64), place
    before, after = np.maximum(place - 1, 0), np.minimum(place, len(order) - 1)
    a, _ = _compare(ids, order[before], query, q_at, q_len)
    b, _ = _compare(ids, order[after], query, q_at, q_len)
    return np.maximum(a, b), np.where(a > b, before, after)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first - starts, lengths)
