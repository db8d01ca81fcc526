"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

``suffix_array`` is the induced-sorting construction: classify every suffix
as larger (L) or smaller (S) than its successor, sort the leftmost-smaller
(LMS) substrings by inducing, name them, sort the shorter string of names
recursively when names repeat, and induce the whole array from the sorted LMS
suffixes.  The inducing scan goes symbol by symbol; all suffixes of a
symbol's bucket that are known so far induce their predecessors at once.  That pays
while buckets are large: a string of names with few repeats per name is sorted
by doubling instead, which ends the recursion.
"""

from __future__ import annotations

import numpy as np

SMALL_BUCKETS = 32          # occurrences per symbol below which buckets are too small to induce by


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (the end counts as smallest)."""
    n = len(s)
    step = np.sign(np.append(s[1:], -1).astype(np.int64) - s)          # +1: S, -1: L, 0: as the next
    known = np.flatnonzero(step)
    return step[known[np.searchsorted(known, np.arange(n))]] > 0


def _induce(s: np.ndarray, small: np.ndarray, sizes: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array induced from ``lms`` (LMS places, in their order)."""
    n = len(s)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    symbols = np.flatnonzero(sizes)
    sa = np.full(n, -1, np.int64)
    of = s[lms]
    lms_from = np.searchsorted(of, symbols, side="left")               # lms is ordered by first symbol
    lms_to = np.searchsorted(of, symbols, side="right")
    head = starts.copy()

    def deal(pred: np.ndarray, down: bool) -> None:
        """Appends places to the free heads (or tails) of their symbols' buckets, in the order given."""
        c = s[pred]
        if len(c) == 1:
            x = c[0]
            if down:
                tail[x] -= 1
                sa[tail[x]] = pred[0]
            else:
                sa[head[x]] = pred[0]
                head[x] += 1
            return
        order = np.argsort(c, kind="stable")
        c = c[order]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        count = np.diff(np.append(first, len(c)))
        nth = np.arange(len(c)) - np.repeat(first, count)
        if down:
            sa[tail[c] - 1 - nth] = pred[order]
            tail[c[first]] -= count
        else:
            sa[head[c] + nth] = pred[order]
            head[c[first]] += count

    # L suffixes, from small to large; the end of the string comes before everything.
    if not small[n - 1]:
        deal(np.array([n - 1]), False)
    for k, c in enumerate(symbols.tolist()):
        done = starts[c]
        while done < head[c]:                                           # L suffixes of this symbol, in waves
            known = sa[done:head[c]]
            done = head[c]
            pred = known[known > 0] - 1
            pred = pred[~small[pred]]
            if len(pred):
                deal(pred, False)
        known = lms[lms_from[k]:lms_to[k]]                              # then its LMS suffixes
        pred = known[known > 0] - 1
        pred = pred[~small[pred]]
        if len(pred):
            deal(pred, False)
    # S suffixes, from large to small.
    tail = ends.copy()
    l_end = head.copy()
    for c in symbols[::-1].tolist():
        done = ends[c]
        while tail[c] < done:                                           # S suffixes of this symbol, in waves
            known = sa[tail[c]:done][::-1]
            done = tail[c]
            pred = known[known > 0] - 1
            pred = pred[small[pred]]
            if len(pred):
                deal(pred, True)
        known = sa[starts[c]:l_end[c]][::-1]                            # then its L suffixes
        pred = known[known > 0] - 1
        pred = pred[small[pred]]
        if len(pred):
            deal(pred, True)
    return sa


def _doubled(s: np.ndarray) -> np.ndarray:
    """The suffix array by prefix doubling: order by 1, 2, 4, ... symbols until all differ."""
    n = len(s)
    rank, k = s.astype(np.int64) + 1, 1
    while True:
        pair = rank << 32
        pair[: n - k] |= rank[k:]
        order = np.argsort(pair, kind="stable")
        x = pair[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(1, x[1:] != x[:-1]))
        rank, k = new, 2 * k
        if rank[order[-1]] == n or k >= n:
            return np.argsort(rank, kind="stable")


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` (integers from 0) in order; a prefix comes before its extensions."""
    s = np.asarray(s, np.int64)
    n = len(s)
    if n < 2:
        return np.arange(n)
    sizes = np.bincount(s)
    if n < SMALL_BUCKETS * np.count_nonzero(sizes):
        return _doubled(s)
    small = _types(s)
    is_lms = np.append(False, small[1:] & ~small[:-1])
    lms = np.flatnonzero(is_lms)
    if not len(lms):
        return _induce(s, small, sizes, lms)
    # Order of the LMS substrings, induced from the LMS places by first symbol alone.
    sa = _induce(s, small, sizes, lms[np.argsort(s[lms], kind="stable")])
    ordered = sa[is_lms[sa]]
    # Names: neighbours are equal if their substrings, up to the next LMS place, are.
    nxt = np.full(n, n - 1)
    nxt[lms[:-1]] = lms[1:]
    length = nxt[ordered] - ordered + 1
    last = ordered == lms[-1]                                           # runs to the end: equal to no other
    a, b = ordered[:-1], ordered[1:]
    same = (length[:-1] == length[1:]) & ~last[:-1] & ~last[1:]
    at = np.flatnonzero(same)
    k = 0
    while len(at):
        at = at[k < length[at]]
        if not len(at):
            break
        bad = s[a[at] + k] != s[b[at] + k]
        same[at[bad]] = False
        at = at[~bad]
        k += 1
    name = np.concatenate([[0], np.cumsum(~same)])
    if name[-1] + 1 < len(lms):
        names = np.empty(n, np.int64)
        names[ordered] = name
        ordered = lms[suffix_array(names[lms])]
    return _induce(s, small, sizes, ordered)


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, previous): for each place the length shared with the suffix before it in order, and that suffix.

    A place whose predecessor in the text also precedes it at the same
    distance in the order shares one symbol less than that place; only the
    other (irreducible) places are compared, all at once, symbol by symbol.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    plcp = np.zeros(n, np.int64)
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] > 0) & (phi[:-1] >= 0) & (phi[1:] == phi[:-1] + 1) & (s[:-1] == s[phi[:-1]])
    place = np.flatnonzero(~reducible & (phi >= 0))
    other = phi[place]
    got = np.zeros(len(place), np.int64)
    todo = np.arange(len(place))
    while len(todo):
        x, y = place[todo] + got[todo], other[todo] + got[todo]
        ok = np.maximum(x, y) < n
        ok[ok] = s[x[ok]] == s[y[ok]]
        todo = todo[ok]
        got[todo] += 1
    plcp[place] = got
    # A reducible place takes the value of the last irreducible one less the distance to it.
    base = np.where(reducible, 0, np.arange(n))
    np.maximum.accumulate(base, out=base)
    plcp = np.where(reducible, np.maximum(plcp[base] - (np.arange(n) - base), 0), plcp)
    return plcp, phi
