"""Suffix arrays by induced sorting and permuted common prefixes, over numpy arrays."""

from __future__ import annotations

import numpy as np

from glossarion.llm._bytes import segment_hash


def _induce(t: np.ndarray, is_s: np.ndarray, heads: np.ndarray, tails: np.ndarray, seeds: list[np.ndarray]) -> np.ndarray:
    """The suffix array from leftmost-S suffixes given in order within each bucket.

    Buckets are taken in turn; what a bucket induces into a bucket goes there in one
    vector step. A run of one letter takes a step for each of its places.
    """
    n, width = len(t), len(heads)
    sa = np.full(n, -1, np.int32)
    head, tail = heads.copy(), tails.copy()

    def spread(at: np.ndarray, c: np.ndarray) -> None:
        order = np.argsort(c, kind="stable")
        c = c[order]
        counts = np.bincount(c, minlength=width)
        first = np.cumsum(counts) - counts
        sa[head[c] + np.arange(len(c)) - first[c]] = at[order]
        head[:] += counts

    for c in range(width):
        done = heads[c]
        while done < head[c]:
            new = sa[done : head[c]]
            done = head[c]
            new = new[new > 0] - 1
            new = new[~is_s[new]]
            if len(new):
                spread(new, t[new])
        if len(seeds[c]):
            new = seeds[c][seeds[c] > 0] - 1
            new = new[~is_s[new]]
            if len(new):
                spread(new, t[new])

    def spread_back(at: np.ndarray, c: np.ndarray) -> None:
        """``at`` in descending order of suffixes."""
        order = np.argsort(c, kind="stable")
        c = c[order]
        counts = np.bincount(c, minlength=width)
        first = np.cumsum(counts) - counts
        sa[tail[c] - 1 - (np.arange(len(c)) - first[c])] = at[order]
        tail[:] -= counts

    for c in range(width - 1, -1, -1):
        done = tails[c]
        while done > tail[c]:
            new = sa[tail[c] : done][::-1]
            done = tail[c]
            new = new[new > 0] - 1
            new = new[is_s[new]]
            if len(new):
                spread_back(new, t[new])
        if head[c] > heads[c]:
            new = sa[heads[c] : head[c]][::-1]
            new = new[new > 0] - 1
            new = new[is_s[new]]
            if len(new):
                spread_back(new, t[new])
    return sa


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of substring names.

    The recursion: names of pairs of names, of pairs of those, until all differ.
    Suffixes whose name is alone already have their place and sort no more.
    """
    n = len(names)
    rank, span = names.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        new = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
        place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = place
        alone = new & np.concatenate([new[1:], [True]])
        if alone.all():
            return order
        at = np.flatnonzero(~alone)
        who = order[at]
        nxt = np.where(who + span < n, rank[np.minimum(who + span, n - 1)] + 1, 0)
        key = place[at] * (n + 2) + nxt
        by = np.argsort(key, kind="stable")
        order[at] = who[by]
        fresh = rank.copy()
        key = key[by]
        step = np.concatenate([[True], key[1:] != key[:-1]])
        group_new = np.concatenate([[True], place[at][1:] != place[at][:-1]])
        begin = np.maximum.accumulate(np.where(step | group_new, np.arange(len(at)), 0))
        fresh[order[at]] = at[begin]
        rank, span = fresh, span * 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of bytes (uint8). A shorter suffix sorts before one it begins."""
    n = len(text) + 1
    if n <= 2:
        return np.arange(n - 1, dtype=np.int32)
    t = np.zeros(n, np.uint16)
    t[:-1] = text
    t[:-1] += 1
    # classify: S if less than the suffix after it; equal letters take the type of the next other letter
    differs = np.flatnonzero(t[:-1] != t[1:])
    rising = t[differs] < t[differs + 1]
    is_s = np.empty(n, bool)
    is_s[:-1] = np.repeat(rising, np.diff(np.concatenate([[-1], differs])))
    is_s[-1] = True
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    counts = np.bincount(t, minlength=257)
    tails = np.cumsum(counts)
    heads = tails - counts

    def seeds(order: np.ndarray) -> list[np.ndarray]:
        c = t[order]
        by = np.argsort(c, kind="stable")
        return np.split(order[by], np.cumsum(np.bincount(c, minlength=257))[:-1])

    if len(lms) > 1:
        sa = _induce(t, is_s, heads, tails, seeds(lms))
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        found = sa[sa >= 0]
        ordered = found[is_lms[found]]
        if len(ordered) < len(lms):  # the sentinel is induced by nothing
            ordered = np.concatenate([[n - 1], ordered])
        index = np.empty(n, np.int32)
        index[lms] = np.arange(len(lms))
        ends = np.concatenate([lms[1:] + 1, [n]])
        sums = segment_hash(np.concatenate([text, [0]]).astype(np.uint8), lms, ends, 1)
        sums[-1] ^= np.uint64(1 << 63)
        k = index[ordered]
        same = sums[k][1:] == sums[k][:-1]
        names = np.empty(len(lms), np.int64)
        names[k] = np.concatenate([[0], np.cumsum(~same)])
        lms = lms[_sort_names(names)]
    sa = _induce(t, is_s, heads, tails, seeds(lms))
    sa[0] = n - 1
    return sa[1:]


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the array, up to ``most``
    where it is longer.

    Only where the letters before the two suffixes differ are letters compared; elsewhere
    the value is that of the position before, less one.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    eight = np.lib.stride_tricks.as_strided(padded, (n + 1, 8), (1, 1))
    at = np.arange(n)
    kept = (before > 0) & (at > 0)
    kept[kept] = text[at[kept] - 1] == text[before[kept] - 1]
    work = np.flatnonzero(~kept & (before >= 0))
    value = np.zeros(n, np.int64)
    a, b = work.copy(), before[work]
    live = np.arange(len(work))
    got = np.zeros(len(work), np.int64)
    while len(live):
        x, y = a[live] + got[live], b[live] + got[live]
        d = np.ascontiguousarray(eight[np.minimum(x, n)]) != np.ascontiguousarray(eight[np.minimum(y, n)])
        first = np.where(d.any(1), d.argmax(1), 8)
        got[live] += np.minimum(first, n - np.maximum(x, y))
        live = live[(first == 8) & (np.maximum(x, y) + 8 < n)]
    value[work] = got
    last = np.maximum.accumulate(np.where(kept, -1, at))
    value = np.where(kept, value[np.maximum(last, 0)] - (at - last), value)
    return np.minimum(value, most)
