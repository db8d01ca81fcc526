"""BPE merges of many short fragments at once, with numpy.

All fragments of a batch take their next merge in the same round: the
leftmost pair of lowest rank of each fragment.  A fragment leaves when no
pair of it can merge.  This is what merging one fragment after the other by
rank gives, because fragments do not depend on each other.
"""

from __future__ import annotations

import numpy as np

_NONE = np.int32(2**31 - 1)


class MergeTable:
    """Ranks and results of the merges, by pair of symbol ids, in an open-addressed table."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        bits = max(10, (len(merges) * 8).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int32)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._rank = np.full(1 << bits, _NONE, np.int32)
        first = {}
        for r, k in enumerate(keys.tolist()):
            first.setdefault(k, r)
        at = self._slot(np.fromiter(first, np.int64, len(first))).tolist()
        for (k, r), i in zip(first.items(), at):
            while self._keys[i] != -1:
                i = (i + 1) & int(self._mask)
            self._keys[i], self._rank[i] = k, r

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        found = self._keys[at]
        out = np.where(found == keys, self._rank[at], _NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self._mask
            found = self._keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self._rank[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


def _merge_block(table: MergeTable, sym: np.ndarray) -> None:
    """Merges in place; ``sym`` is (fragments, places), -1 where there is no symbol (at the end, and after merges)."""
    n, width = sym.shape
    cols = np.arange(width, dtype=np.int32)
    nxt = np.broadcast_to(cols + 1, (n, width)).copy()
    prv = np.broadcast_to(cols - 1, (n, width)).copy()
    length = (sym >= 0).sum(axis=1)
    rank = np.full((n, width), _NONE, np.int32)
    there = cols[None, :] < (length - 1)[:, None]
    r, c = np.nonzero(there)
    rank[r, c] = table.rank(sym[r, c], sym[r, c + 1])
    rows = np.arange(n)
    while len(rows):
        at = rank[rows].argmin(axis=1) if len(rows) < n else rank.argmin(axis=1)
        best = rank[rows, at]
        go = best < _NONE
        rows, at, best = rows[go], at[go], best[go]
        if not len(rows):
            break
        gone = nxt[rows, at]
        sym[rows, at] = table.result[best]
        sym[rows, gone] = -1
        rank[rows, gone] = _NONE
        after = nxt[rows, gone]
        nxt[rows, at] = after
        has = after < length[rows]
        prv[rows[has], after[has]] = at[has]
        new = np.full(len(rows), _NONE, np.int32)
        new[has] = table.rank(sym[rows[has], at[has]], sym[rows[has], after[has]])
        rank[rows, at] = new
        before = prv[rows, at]
        has = before >= 0
        rank[rows[has], before[has]] = table.rank(sym[rows[has], before[has]], sym[rows[has], at[has]])


def merge(table: MergeTable, sym: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
          widths: tuple[int, ...] = (4, 8, 16, 32, 64, 256)) -> tuple[np.ndarray, np.ndarray]:
    """Merges the fragments ``sym[starts:starts + lengths]``.

    Returns ``out`` like ``sym`` with -1 at places that merged away, and the
    indexes of fragments longer than the largest width, which are left alone.
    """
    out = sym.astype(np.int32).copy()
    low = 1
    for w in widths:
        pick = np.flatnonzero((lengths > low) & (lengths <= w))
        low = w
        for a in range(0, len(pick), 65536):
            p = pick[a:a + 65536]
            cols = np.arange(w)
            there = cols[None, :] < lengths[p][:, None]
            at = starts[p][:, None] + cols
            block = np.full((len(p), w), -1, np.int32)
            block[there] = out[at[there]]
            _merge_block(table, block)
            out[at[there]] = block[there]
    return out, np.flatnonzero(lengths > low)
