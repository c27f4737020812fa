"""License scan: winnowed fingerprints of templates pick candidates, banded alignment decides.

Templates are cut into lower-cased words and hashed runs of `GRAM` words; of every `WINDOW`
neighbouring runs the least hash is a fingerprint, so any copied stretch of GRAM + WINDOW - 1
words holds one. The inverted index maps fingerprints to templates and places. In a document
all runs are looked up; hits of a template that lie near each other on near diagonals are a
candidate, aligned with the template inside a band around these diagonals; hits beside the
aligned run are aligned again. Aligned parts of GRAM + WINDOW - 1 words and more whose places
rise in the document and the template are chained, however far apart they lie, so words put in
or left out break no match. Reported is how much of the template a chain covers, and the span
of the document from its first to its last part.

The templates are a parameter and are sent to the tasks; documents are never shuffled.

Defined cases: null and empty texts hold no license; templates without a word match nothing; a
match all of whose parts lie within parts of other matches is not reported, of equal parts the better covered and
then the first by name is; repeated rows are reported each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardlight.llm import words
from wardlight.llm.common import char_starts, id_and_text, pieces
from wardlight.llm.decontaminate import text_words
from wardlight.llm.license_texts import TEMPLATES

GRAM, WINDOW, BAND, COVERAGE = 3, 4, 8, 0.8
MATCH, MISMATCH, GAP = 2, -1, -1


def winnowed(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hash of every `window` neighbouring hashes, the last of equal ones."""
    if len(grams) <= window:
        return np.arange(len(grams))  # too short to thin out
    views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


class Index:
    """The inverted index of the templates."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW):
        self.names = sorted(templates)
        *_, firsts, h = text_words(pa.array([templates[n] for n in self.names], pa.string()))
        self.words = [h[a:b] for a, b in zip(firsts, firsts[1:], strict=False)]
        self.grams: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for t, own in enumerate(self.words):
            k = min(gram, len(own))  # a template of one or two words is one run
            if k:
                hashes = words.gram_hashes(own, k)
                at = winnowed(hashes, window)
                self.grams.setdefault(k, []).append((t, hashes[at], at))
        self.lookups = {}
        for k, found in self.grams.items():
            keys = np.concatenate([h for _, h, _ in found])
            order = np.argsort(keys, kind="stable")
            template = np.concatenate([np.full(len(h), t) for t, h, _ in found])[order]
            place = np.concatenate([at for *_, at in found])[order]
            self.lookups[k] = (words.Lookup(np.unique(keys), np.unique(keys)), keys[order], template, place)

    def hits(self, h: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Rows (text, template, place in the document, place in the template), sorted."""
        out = [np.empty((0, 4), np.int64)]
        for k, (lookup, keys, template, place) in self.lookups.items():
            grams = words.gram_hashes(h, k)
            at, key = lookup.find(grams)
            inside = text[at] == text[at + k - 1]
            at, key = at[inside], key[inside]
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            sizes = high - low
            posts = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            where = np.repeat(at, sizes)
            out.append(np.stack([text[where], template[posts], where, place[posts]], axis=1))
        found = np.concatenate(out)
        return found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]

    def matches(self, firsts: np.ndarray, h: np.ndarray, least: float) -> list[tuple[int, int, int, int, int]]:
        """(text, template, covered words, first word, end word) of each reported match."""
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        hits = self.hits(h, text)
        if not len(hits):
            return []
        diagonal = hits[:, 2] - hits[:, 3]
        new = np.ones(len(hits), bool)
        new[1:] = (hits[1:, 0] != hits[:-1, 0]) | (hits[1:, 1] != hits[:-1, 1]) | (np.abs(np.diff(diagonal)) > BAND)
        # A candidate's diagonals don't drift further than the template is long: beyond that another one begins.
        begins, places, own_sizes = new.tolist(), diagonal.tolist(), [max(BAND, len(w)) for w in self.words]
        first = 0
        for k, template in enumerate(hits[:, 1].tolist()):
            if begins[k] or abs(places[k] - places[first]) > own_sizes[template]:
                begins[k], first = True, k
        starts = np.flatnonzero(begins)
        parts: dict[tuple[int, int], set[Part]] = {}
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(hits)], strict=True):
            t, template = int(hits[a, 0]), int(hits[a, 1])
            own = self.words[template]
            waiting = [(a, b, int(firsts[t]), int(firsts[t + 1]))]
            while waiting:
                a, b, least_begin, most_stop = waiting.pop()
                low, high = int(diagonal[a:b].min()) - BAND, int(diagonal[a:b].max()) + BAND
                begin, stop = max(least_begin, low), min(most_stop, high + len(own))
                mask, s, e = banded(own.tolist(), h[begin:stop].tolist(), low - begin, high - begin)
                if not mask:
                    continue
                s, e = begin + s, begin + e
                parts.setdefault((t, template), set()).add((s, e, mask))
                before, after = a + int(np.searchsorted(hits[a:b, 2], s)), a + int(np.searchsorted(hits[a:b, 2], e))
                waiting += [x for x in ((a, before, least_begin, s), (after, b, e, most_stop)) if x[0] < x[1]]
        found = []
        for (t, template), own_parts in parts.items():
            found += [(t, template, covered, spans) for covered, spans in chains(own_parts, least * len(self.words[template]))]
        return outermost(found, self.words)


#: An aligned run: start and end in the document, and the template's matched words as bits.
Part = tuple[int, int, int]


def chains_to(parts: list[Part], cost: int) -> list[tuple[float, int, int, list[int]]]:
    """Worth, covered words, bits and members of the best chain to each part.

    Worth is the covered words, less `cost` times the logarithm of the words between.
    """
    best: list[tuple[float, int, int, list[int]]] = []  # worth, covered words, bits, members
    for j, (s, e, mask) in enumerate(parts):
        alone = mask.bit_count()
        top = (float(alone), alone, mask, [j])
        if alone >= GRAM + WINDOW - 1 and not mask & 1:  # what holds the template's first word begins a chain
            for i in range(j):
                s0, e0, mask0 = parts[i]
                rising = s0 < s and e0 < e and mask0 & -mask0 < mask & -mask and mask0.bit_length() < mask.bit_length()
                if not rising or mask0.bit_count() < GRAM + WINDOW - 1:
                    continue
                worth, covered, bits, members = best[i]
                gained = (bits | mask).bit_count() - bits.bit_count() - max(0, e0 - s)
                if gained > 0:
                    top = max(top, (worth + gained - cost * math.log2(1 + max(0, s - e0)), covered + gained, bits | mask, [*members, j]), key=lambda x: x[:2])
        best.append(top)
    return best


def chains(parts: set[Part], least: float) -> list[tuple[int, list[tuple[int, int]]]]:
    """Covered words and the runs of each chain that covers so many, the best first, none over the runs of one before.

    Near parts go before far ones that cover little more; where these cover too little, distance counts nothing.
    """
    left = sorted(p for p in parts if p[2].bit_count() >= min(least, GRAM + WINDOW - 1))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    cost = 1
    while left:
        taken: list[tuple[int, int]] = []
        for _, covered, _, members in sorted(chains_to(left, cost), key=lambda x: x[:2], reverse=True):
            runs = [left[i][:2] for i in members]
            if covered >= least and not any(overlaps(taken, *run) for run in runs):
                out.append((covered, runs))
                for run in runs:
                    insort(taken, run)
        left = [p for p in left if not overlaps(taken, p[0], p[1])]
        if not taken:
            if not cost:
                break
            cost = 0
    return out


def overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a run meets one of the sorted disjoint runs."""
    at = bisect_left(taken, (end, -1))
    return at > 0 and taken[at - 1][1] > start


def banded(template: list[int], text: list[int], low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment with text place - template place between low and high.

    Gives the template's matched words as bits, and the start and end of the aligned run of the text.
    """
    best = (0, 0, 0, 0, 0)
    above: dict[int, tuple[int, int, int, int]] = {}  # place in the text after the last word: score, matched, start, bits
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int, int]] = {}
        for j in range(max(0, i + low), min(len(text), i + high + 1)):
            score, matched, start, bits = above.get(j, (0, 0, j, 0))
            same = word == text[j]
            options = [(score + (MATCH if same else MISMATCH), matched + same, start, bits | same << i)]
            if j + 1 in above:  # the template's word is left out
                options.append((above[j + 1][0] + GAP, *above[j + 1][1:]))
            if j in row:  # the text's word is left out
                options.append((row[j][0] + GAP, *row[j][1:]))
            top = max(options, key=lambda o: (o[0], o[1], o[2]))
            if top[0] > 0:
                row[j + 1] = top
                if (top[0], top[1]) > best[:2]:
                    best = (top[0], top[1], top[2], j + 1, top[3])
        above = row
    return best[4], best[2], best[3]


def outermost(found: list[tuple[int, int, int, list[tuple[int, int]]]], templates: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """Without matches whose parts all lie within others' parts: one scan over each text's parts, longest first at each start."""
    parts = [(t, s, -e, -covered / len(templates[template]), template, k) for k, (t, template, covered, spans) in enumerate(found) for s, e in spans]
    kept, text, reach = set(), -1, -1
    for t, _, end, *_, k in sorted(parts):
        if t != text:
            text, reach = t, -1
        if -end > reach:
            kept.add(k)
            reach = -end
    chosen = [found[k] for k in kept]
    return sorted(((t, template, covered, spans[0][0], spans[-1][1]) for t, template, covered, spans in chosen), key=lambda m: (m[0], m[3], -m[4], m[1]))


_TYPE = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _scan(templates: dict[str, str], least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch in batches:
            for part in pieces(batch):
                data, offsets, starts, ends, firsts, h = text_words(part.column("text"))
                ids, rows = part.column("doc_id"), []
                for t, template, covered, a, b in index.matches(firsts, h, least):
                    chars = char_starts(data[offsets[t] : offsets[t + 1]])
                    rows.append({"doc_id": ids[t].as_py(), "license": index.names[template], "coverage": covered / len(index.words[template]), "matched_words": covered, "start": int(chars[starts[a] - offsets[t]]), "end": int(chars[ends[b - 1] - offsets[t]])})
                yield pa.RecordBatch.from_pylist(rows, _TYPE)

    return run


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """One row per license text found in a document; start and end count code points."""
    return id_and_text(docs).mapInArrow(_scan(TEMPLATES if templates is None else templates, least), "doc_id bigint, license string, coverage double, matched_words int, start int, end int")
