"""Words of many texts at once as numpy arrays: where they are, their hashes, hashes of runs."""

from __future__ import annotations

from functools import cache

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20


def _byte_table(word: str) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.zeros(256, bool)
    if word == "spaced":  # everything but the space and the five control characters from tab on
        table[:] = True
        table[[0x20, *range(0x09, 0x0E)]] = False
    else:  # letters, digits; all of a character beyond ASCII
        table[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(128, 256)]] = True
        if word == "letters":
            table[ord("0") : ord("9") + 1] = False
    return table


TABLES = {name: _byte_table(name) for name in ("spaced", "letters", "alnum")}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def spans(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and where each text's words begin in these arrays."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = TABLES[kind][data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    stop[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(_BLOCK + 1, base, U)
        out[0] = 1
        return np.multiply.accumulate(out)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads each bit over all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, equal for equal words in every process."""
    out = np.empty(len(starts), U)
    powers, inverse = _powers()
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = int(np.searchsorted(ends, low + _BLOCK, "right"))
        if to == at:  # a word longer than a block: folded block by block
            folded = U(0)
            for x in range(low, int(ends[at]), _BLOCK):
                part = data[x : min(x + _BLOCK, int(ends[at]))]
                folded = mix(np.array([folded + np.sum((part.astype(U) + U(1)) * powers[: len(part)])], U))[0]
            out[at] = folded
            at += 1
            continue
        high = int(ends[to - 1])
        sums = np.zeros(high - low + 1, U)
        np.cumsum((data[low:high].astype(U) + U(1)) * powers[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * inverse[s]
        at = to
    return mix(out ^ ((ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k words, also of runs that cross texts; see `inside`."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = h[:n].copy()
    for j in range(1, k):
        out *= U(_BASE)
        out += h[j : n + j]
    return mix(out)


def inside(firsts: np.ndarray, n: int, k: int) -> np.ndarray:
    """True for the runs of k words that lie in one text; firsts from `spans`, n words in all."""
    if n < k:
        return np.empty(0, bool)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    return text[: n - k + 1] == text[k - 1 :]


class Lookup:
    """Values of a bounded set of hashes, found for many words at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & U(0xFFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h that have a value, and the values."""
        if not len(self.keys):
            return np.empty(0, np.int64), self.values[:0]
        at = np.flatnonzero(self.maybe[(h & U(0xFFFFF)).astype(np.int64)])
        got = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[got] == h[at]
        return at[same], self.values[got[same]]
