"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard at a time.

Suffixes are classified as smaller (S) or larger (L) than their successor. The leftmost S of each
run are the samples: their substrings are sorted by inducing L from samples and S from L, named,
and the string of names is sorted by recursion; the sorted samples then induce all suffixes. The
string over bytes is induced bucket by bucket with numpy, in waves where a bucket feeds itself;
the strings of names, a third as long and with many small buckets, place by place.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are S, and the places of the samples. s ends with its only 0."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    places = np.where(differs, np.arange(n), n)
    following = np.minimum.accumulate(places[::-1])[::-1]
    small = np.append(s[:-1] < s[1:], True)[following]
    sample = small.copy()
    sample[0] = False
    sample[1:] &= ~small[:-1]
    return small, np.flatnonzero(sample)


def _dealt(suffixes: np.ndarray, kinds: np.ndarray, at: np.ndarray, sign: int, out: np.ndarray) -> None:
    """Puts suffixes into the buckets of their first symbols in order; `at` holds the next free places."""
    order = np.argsort(kinds, kind="stable")
    kinds = kinds[order]
    counts = np.bincount(kinds, minlength=len(at))
    within = np.arange(len(kinds)) - (np.cumsum(counts) - counts)[kinds]
    out[at[kinds] + sign * within] = suffixes[order]
    at += sign * counts


def _induce_bytes(s: np.ndarray, small: np.ndarray, samples: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from samples that are in order (of suffixes, or any order for substrings)."""
    counts = np.bincount(s, minlength=symbols)
    ends = np.cumsum(counts)
    firsts = ends - counts
    out = np.full(len(s), -1, np.int32)
    kinds = s[samples]
    order = np.argsort(kinds, kind="stable")
    by_kind, cut = samples[order], np.searchsorted(kinds[order], np.arange(symbols + 1))
    used = np.flatnonzero(counts).tolist()

    def feed(batch: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray]:
        before = batch[batch > 0] - 1
        before = before[small[before] == want]
        return before, s[before]

    at = firsts.copy()
    for c in used:
        low = firsts[c]
        while low < at[c]:
            high = at[c]
            before, kind = feed(out[low:high], False)
            _dealt(before, kind, at, 1, out)
            low = high
        before, kind = feed(by_kind[cut[c] : cut[c + 1]], False)
        _dealt(before, kind, at, 1, out)
    large_ends = at
    at = ends - 1
    for c in reversed(used):
        high = ends[c] - 1
        if c == 0:
            out[0] = len(s) - 1
            at[0] -= 1
            high = 0
            before, kind = feed(out[:1], True)
            _dealt(before, kind, at, -1, out)
            continue
        while at[c] < high:
            low = at[c]
            before, kind = feed(out[low + 1 : high + 1][::-1], True)
            _dealt(before, kind, at, -1, out)
            high = low
        before, kind = feed(out[firsts[c] : large_ends[c]][::-1], True)
        _dealt(before, kind, at, -1, out)
    return out


def _induce_names(s: list[int], small: list[bool], samples: list[int], counts: list[int]) -> list[int]:
    """The same, place by place."""
    firsts, ends, total = [], [], 0
    for n in counts:
        firsts.append(total)
        total += n
        ends.append(total)
    out = [-1] * len(s)
    at = ends.copy()
    for i in reversed(samples):
        at[s[i]] -= 1
        out[at[s[i]]] = i
    at = firsts.copy()
    for i in out:  # grows ahead of the reader
        if i > 0 and not small[i - 1]:
            c = s[i - 1]
            out[at[c]] = i - 1
            at[c] += 1
    at = ends
    for k in range(len(s) - 1, -1, -1):
        i = out[k]
        if i > 0 and small[i - 1]:
            c = s[i - 1]
            at[c] -= 1
            out[at[c]] = i - 1
    return out


def _named(s: np.ndarray, samples: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names, in text order, of the sample substrings, which are given in order."""
    rank = np.empty(len(s), np.int64)
    rank[samples] = np.arange(len(samples))
    size = np.append(np.diff(samples), 0) + 1
    own = rank[ordered]
    same = size[own[1:]] == size[own[:-1]]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        left = left[size[own[left + 1]] > k]
        differ = s[ordered[left] + k] != s[ordered[left + 1] + k]
        same[left[differ]] = False
        left = left[~differ]
        k += 1
        if len(left) <= 16:
            for i in left.tolist():
                a, b, n = int(ordered[i]), int(ordered[i + 1]), int(size[own[i]])
                same[i] = np.array_equal(s[a : a + n], s[b : b + n])
            break
    names = np.empty(len(samples), np.int64)
    names[own] = np.concatenate([[0], np.cumsum(~same)])
    return names


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """The suffixes of s in order. s holds numbers below `symbols` and ends with its only 0."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    small, samples = classify(s)
    if symbols <= 512:
        kind = s.astype(np.uint16)

        def induce(own: np.ndarray) -> np.ndarray:
            return _induce_bytes(kind, small, own, symbols)
    else:
        as_list, flags, counts = s.tolist(), small.tolist(), np.bincount(s, minlength=symbols).tolist()

        def induce(own: np.ndarray) -> np.ndarray:
            return np.array(_induce_names(as_list, flags, own.tolist(), counts), np.int32)

    found = induce(samples)
    is_sample = np.zeros(len(s), bool)
    is_sample[samples] = True
    names = _named(s, samples, found[is_sample[found]])
    different = int(names.max()) + 1
    order = suffix_array(names, different) if different < len(names) else np.argsort(names)
    return induce(samples[order])


def common_prefixes(s: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix, in text order, its predecessor in suffix order and the length of their common prefix.

    A suffix whose preceding symbol equals that of its predecessor has one symbol less in common
    than the suffix before it; only the others are compared, eight symbols at a time.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    padded = np.concatenate([s.astype(np.uint8), np.zeros(16, np.uint8)])
    eight = np.ndarray(n + 8, "<u8", padded.tobytes(), strides=(1,))
    fresh = np.ones(n, bool)
    fresh[1:] = (before[1:] <= 0) | (s[:-1] != s[before[1:] - 1])
    at = np.flatnonzero(fresh)
    length = np.zeros(n, np.int64)
    left = at[before[at] >= 0]
    shared = np.zeros(len(left), np.int64)
    going = np.arange(len(left))
    while len(going):
        a, b = left[going] + shared[going], before[left[going]] + shared[going]
        differ = eight[np.minimum(a, n)] ^ eight[np.minimum(b, n)]
        equal = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
        shared[going] += equal
        going = going[equal == 8]
    length[left] = shared
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    length = length[last] - (np.arange(n) - last)
    return before, length
