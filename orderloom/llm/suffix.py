"""Suffix sorting by compared hashes.

Prefix polynomial hashes give the hash of any substring at once, so the
common extension of two suffixes is found by binary search over its length,
and two suffixes are compared in logarithmic time.  ``Suffixes.sort`` is a
bottom-up mergesort on that comparison; each round merges all runs at once,
every suffix looking for its place in the run beside it.
"""

from __future__ import annotations

import numpy as np

from orderloom.llm import common as C


class Suffixes:
    """Suffixes of a byte buffer, compared on their first ``depth`` bytes;
    each start must have ``depth`` bytes after it."""

    def __init__(self, data: np.ndarray, depth: int):
        self.data, self.depth = data, depth
        self.prefix = C.prefix_hashes(C.BYTE_VALUES[data])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, at most depth."""
        lo = np.zeros(len(a), np.int64)
        hi = np.full(len(a), self.depth, np.int64)
        pa, pb = self.prefix[a], self.prefix[b]
        # Hashes of the two ranges are equal if they are after one is moved
        # to the other's place.
        shift = C.POWERS.up[np.abs(b - a)]
        first = a <= b
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            ha, hb = self.prefix[a + mid] - pa, self.prefix[b + mid] - pb
            same = np.where(first, ha * shift == hb, hb * shift == ha)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix a is before, equal to or after suffix b."""
        n = self.extension(a, b)
        at = np.minimum(n, self.depth - 1)
        x, y = self.data[a + at].astype(np.int64), self.data[b + at].astype(np.int64)
        return np.where(n == self.depth, 0, np.sign(x - y))

    def sort(self, starts: np.ndarray) -> np.ndarray:
        """The order of the suffixes at ``starts`` (a stable mergesort)."""
        n = len(starts)
        at = np.arange(n)
        order, width = at, 1
        while width < n:
            run = at // width
            base = (run ^ 1) * width
            lo, hi = np.zeros(n, np.int64), np.clip(n - base, 0, width)
            later = (run & 1).astype(bool)
            own = starts[order]
            open_ = np.flatnonzero(lo < hi)
            while len(open_):
                mid = (lo[open_] + hi[open_]) >> 1
                c = self.compare(own[base[open_] + mid], own[open_])
                go = (c < 0) | ((c == 0) & later[open_])
                lo[open_] = np.where(go, mid + 1, lo[open_])
                hi[open_] = np.where(go, hi[open_], mid)
                open_ = open_[lo[open_] < hi[open_]]
            merged = np.empty(n, np.int64)
            merged[(run >> 1) * (2 * width) + (at - run * width) + lo] = order
            order, width = merged, 2 * width
        return order

    def repeated(self, starts: np.ndarray) -> np.ndarray:
        """Which of the suffixes share all ``depth`` bytes with another one;
        equal neighbours of the sorted order are verified byte by byte."""
        out = np.zeros(len(starts), bool)
        if len(starts) < 2:
            return out
        order = self.sort(starts)
        a, b = starts[order[:-1]], starts[order[1:]]
        same = np.flatnonzero(self.extension(a, b) == self.depth)
        span = np.arange(self.depth)
        for i in range(0, len(same), 4096):
            s = same[i:i + 4096]
            equal = (self.data[a[s, None] + span] == self.data[b[s, None] + span]).all(axis=1)
            out[order[:-1][s[equal]]] = True
            out[order[1:][s[equal]]] = True
        return out
