"""Anchors: places chosen by content alone, such that equal strings choose equal places.

Every string of ``length`` bytes holds ``length - GRAM + 1`` grams of GRAM
bytes; its anchor is the gram with the smallest hash, the leftmost of
several.  Equal strings hold equal grams, so they have equal anchors at equal
distances.  Neighbouring strings mostly share an anchor: the stretch of bytes
that the strings of one anchor cover is its segment.
"""

from __future__ import annotations

import hashlib

import numpy as np

GRAM = 64
_M = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte grams, by doubling: 1, 2, 4, ... bytes."""
    h = (b.astype(np.uint64) + np.uint64(1)) * _M
    h ^= h >> np.uint64(29)
    n = 1
    while n < GRAM:
        h = (h[:-n] * np.uint64(0xBF58476D1CE4E5B9) + (h[n:] ^ (h[n:] >> np.uint64(31)))) * _M
        h ^= h >> np.uint64(32)
        n *= 2
    return h


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, n, anchor) of every segment: the anchor's hash, its first string's place, its number of
    strings, and the anchor's place.

    Strings of one text that share an anchor are one segment; two segments of a
    text never share a string.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    width = length - GRAM + 1
    # The hash's upper half and the place: the minimum is the leftmost smallest.
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    place = (m & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    at = place[start]
    return h[at].view(np.int64), start, np.diff(np.append(start, len(place))), at


def digests(data: bytes, start: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """int64 digests of the segments' bytes; with the key they make 128 bits."""
    view = memoryview(data)
    out = b"".join(hashlib.blake2b(view[a:a + k + length - 1], digest_size=8).digest()
                   for a, k in zip(start.tolist(), n.tolist()))
    return np.frombuffer(out, "<i8")
