"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Items and documents are sequences of lower-cased words. A document leaks an item when some
run of its words is within floor((1 - similarity) * words of the item) word edits of it.

Items are cut into classes of like length. A window of the class's length at each word of a
document goes through: 1. the q-gram lemma, which loses nothing (d edits leave all but 2 d of
the pairs of neighbouring words whole, so a window with fewer known pairs can't match); 2. the
CGK random walk, which writes the word it stands on and steps on or not by a random bit of
that word, turning edit distance into Hamming distance, and `SAMPLED` coordinates of it as a
key, in as many repetitions as reach the target recall at the lowest similarity; 3. bit-parallel
edit distance of each item that shares a key with the window, around the window.

The longer an item, the rarer the shared keys. Where `MOST_REPETITIONS` miss the target, the
items of a class are cut in halves that are looked for instead, and these again if need be:
of the parts of an item within its edits, one is within its own share of them. Whatever part
is found, the whole item is verified around it.

Items and parts that allow no edit are looked up by the hash of their words instead.

Documents are never shuffled. The items are sent to them in blocks of at most `BLOCK_BYTES` of
text, so a larger benchmark takes more passes, not more memory.

Defined cases: null and empty texts and items without a word match nothing; repeated documents
and repeated items are reported each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, char_starts, id_and_text, pieces, text_of, whole_row

SIMILARITY, RECALL, SAMPLED = 0.8, 0.99, 3
BLOCK_BYTES, MOST_REPETITIONS, COPIES = 8 << 20, 128, 50
U = np.uint64
_PAD = U(0x5851F42D4C957F2D)


def text_words(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes, offsets, starts and ends of words, first word of each text, hash of each word."""
    data, offsets = byte_view(column)
    lower = words.LOWER[data] if len(data) else data
    starts, ends, firsts = words.spans(lower, offsets, "alnum")
    return data, offsets, starts, ends, firsts, words.hashes(lower, starts, ends)


def embedded(h: np.ndarray, starts: np.ndarray, stops: np.ndarray, steps: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Keys of the sampled coordinates of the walks from each start, for all repetitions at once.

    steps: an odd factor for each repetition and coordinate, whose product with a word's hash
    gives the random bit; taken: which coordinates a repetition samples.
    """
    at = np.repeat(starts[None, :], len(steps), axis=0)
    key = np.repeat(np.arange(1, len(steps) + 1, dtype=U)[:, None], len(starts), axis=1)
    top = max(0, len(h) - 1)
    for j in range(steps.shape[1]):
        word = np.where(at < stops[None, :], h[np.minimum(at, top)], _PAD)
        key = np.where(taken[:, j, None], words.mix(key * U(0x9E3779B97F4A7C15) + word), key)
        at += ((word * steps[:, j, None]) >> U(63)).astype(np.int64)
    return key


@dataclass
class LengthClass:
    """Items of like length with their search structures."""

    low: int
    edits: int
    q: int
    grams: words.Lookup
    steps: np.ndarray
    taken: np.ndarray
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray  # where in the item the part with this key begins


def _functions(low: int, repetitions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random walks over the first words of a window, and the coordinates sampled from each."""
    rng = np.random.default_rng(seed)
    length = max(1, int(1.6 * low))
    steps = rng.integers(0, 2**63, (repetitions, length), dtype=U) * U(2) + U(1)
    taken = np.zeros((repetitions, length), bool)
    for r in range(repetitions):
        taken[r, rng.choice(length, min(SAMPLED, length), replace=False)] = True
    last = int(np.flatnonzero(taken.any(axis=0)).max()) + 1
    return steps[:, :last], taken[:, :last]


def _edited(h: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """An item after random edits."""
    out = h.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(0, max(1, len(out)))), rng.integers(0, 3)
        new = int(rng.integers(0, 2**63))
        out[at : at + (kind != 0)] = [new] if kind != 1 else []
    return np.array(out, U)


def repetitions_for(items: list[np.ndarray], low: int, similarity: float, recall: float) -> int | None:
    """How many repetitions find an item after the most edits allowed with the target probability, None if too many.

    Measured on about `COPIES` edited copies of at most 50 items of the class, with unrelated words
    behind them: a walk that leaves the item must not count on the end of the document.
    """
    rng = np.random.default_rng(low)
    steps, taken = _functions(low, MOST_REPETITIONS, low)
    hits = []
    for h in items[:50]:
        own = embedded(h, np.array([0]), np.array([len(h)]), steps, taken)
        for _ in range(math.ceil(COPIES / min(50, len(items)))):
            changed = np.concatenate([_edited(h, int((1 - similarity) * len(h) + 1e-9), rng), rng.integers(0, 2**63, steps.shape[1], dtype=U)])
            hits.append(float((embedded(changed, np.array([0]), np.array([len(changed)]), steps, taken) == own).mean()))
    # An item is found with 1 - (1 - p)^R; the mean over the items must reach the target.
    for r in range(1, MOST_REPETITIONS + 1):
        if np.mean(1 - (1 - np.array(hits)) ** r) >= recall:
            return r
    return None


def classes_of(items: list[np.ndarray], similarity: float, recall: float) -> tuple[list[LengthClass], list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The classes, and for each length that allows no edit the sorted hashes of its runs, with their items and offsets."""
    bounds = [1]
    while bounds[-1] <= max((len(h) for h in items), default=0):
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * 1.25)))
    # Parts of items (item, offset, words) by class; the longest come first, as they may leave halves to shorter classes.
    parts: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in bounds]
    whole: dict[int, list[tuple[int, int, np.ndarray]]] = {}

    def put(i: int, offset: int, h: np.ndarray) -> None:
        if len(h) == 1 or (len(h) and (1 - similarity) * len(h) + 1e-9 < 1):
            whole.setdefault(len(h), []).append((i, offset, h))
        elif len(h):
            parts[bisect_right(bounds, len(h)) - 1].append((i, offset, h))

    for i, h in enumerate(items):
        put(i, 0, h)
    out = []
    for c in reversed(range(len(bounds) - 1)):
        low, high, own = bounds[c], bounds[c + 1], parts[c]
        if not own:
            continue
        repetitions = repetitions_for([h for *_, h in own], low, similarity, recall)
        if repetitions is None:
            for i, offset, h in own:
                put(i, offset, h[: len(h) // 2])
                put(i, offset + len(h) // 2, h[len(h) // 2 :])
            continue
        edits, q = int((1 - similarity) * (high - 1) + 1e-9), 2 if low > 1 else 1
        grams = np.unique(np.concatenate([words.gram_hashes(h, q) for *_, h in own]))
        steps, taken = _functions(low, repetitions, low)
        keys = np.concatenate([embedded(h, np.array([0]), np.array([len(h)]), steps, taken)[:, 0] for *_, h in own])
        named, offsets = (np.repeat(np.array([part[k] for part in own]), len(steps)) for k in (0, 1))
        order = np.argsort(keys, kind="stable")
        out.append(LengthClass(low, edits, q, words.Lookup(grams, np.ones(len(grams), np.int8)), steps, taken, keys[order], named[order], offsets[order]))
    runs = []
    for k, own in sorted(whole.items()):
        keys = np.concatenate([words.gram_hashes(h, k) for *_, h in own])
        order = np.argsort(keys, kind="stable")
        runs.append((k, keys[order], *(np.array([part[x] for part in own])[order] for x in (0, 1))))
    return out, runs


def _distances(pattern: list[int], text: list[int], anchored: bool) -> list[int]:
    """Edit distance of the pattern to the best run that ends at each word, or (anchored) to the whole prefix."""
    m = len(pattern)
    mask, top, places = (1 << m) - 1, 1 << (m - 1), {}
    for i, w in enumerate(pattern):
        places[w] = places.get(w, 0) | 1 << i
    up, down, now, out = mask, 0, m, []
    for w in text:
        eq = places.get(w, 0)
        v = eq | down
        x = (((eq & up) + up) ^ up) | eq
        plus, minus = (down | ~(x | up)) & mask, up & x
        now += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 | anchored, minus << 1
        up, down = (minus | ~(v | plus)) & mask, plus & v & mask
        out.append(now)
    return out


def best_match(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """Least edit distance of the pattern to a run of the text, and that run's start and end."""
    found = _distances(pattern, text, False)
    if not found or min(found) >= len(pattern):
        return len(pattern), 0, 0
    least = min(found)
    end = found.index(least) + 1
    back = _distances(pattern[::-1], text[:end][::-1], True)
    return least, end - back.index(least) - 1, end


@dataclass
class Index:
    """A block of items, ready to be sent to the tasks."""

    ids: list[int | None]
    items: list[np.ndarray]
    classes: list[LengthClass]
    runs: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    similarity: float

    def matches(self, firsts: np.ndarray, h: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word) of each verified match in a piece of texts."""
        pairs: set[tuple[int, int, int]] = set()
        n = len(h)
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        for k, keys, named, offsets in self.runs:
            grams = words.gram_hashes(h, k)
            left, right = np.searchsorted(keys, grams, "left"), np.searchsorted(keys, grams, "right")
            for p in np.flatnonzero((right > left) & words.inside(firsts, n, k)).tolist():
                found = slice(left[p], right[p])
                pairs.update((int(text[p]), i, p - o) for i, o in zip(named[found].tolist(), offsets[found].tolist(), strict=True))
        for c in self.classes:
            known = np.zeros(n + c.low + 1, np.int64)
            grams = words.gram_hashes(h, c.q)
            at, _ = c.grams.find(grams)
            if c.q > 1:
                at = at[text[at] == text[at + 1]]
            if not len(at):
                continue
            known[at + 1] = 1
            sums = np.cumsum(known)
            width = c.low - c.q + 1
            need = max(1, width - c.q * c.edits)
            starts = np.flatnonzero(sums[width : n + width] - sums[:n] >= need)
            for low in range(0, len(starts), 4096):
                part = starts[low : low + 4096]
                keys = embedded(h, part, firsts[text[part] + 1], c.steps, c.taken)
                left, right = np.searchsorted(c.keys, keys, "left"), np.searchsorted(c.keys, keys, "right")
                for r, s in zip(*np.nonzero(right > left), strict=True):
                    p = int(part[s])
                    found = slice(left[r, s], right[r, s])
                    pairs.update((int(text[p]), i, p - o) for i, o in zip(c.items[found].tolist(), c.offsets[found].tolist(), strict=True))
        out, run = [], []
        ordered = sorted(pairs)
        for k, (t, i, p) in enumerate(ordered):
            run.append(p)
            following = ordered[k + 1] if k + 1 < len(ordered) else None
            size = len(self.items[i])
            if following and following[:2] == (t, i) and following[2] - p <= max(1, size // 2):
                continue
            edits = int((1 - self.similarity) * size + 1e-9)
            around = [(max(int(firsts[t]), run[0] - edits), min(int(firsts[t + 1]), run[-1] + size + 2 * edits))]
            while around:  # parts that repeat in an item can chain several copies
                a, b = around.pop()
                if b - a < max(1, size - edits):
                    continue
                distance, start, end = best_match(self.items[i].tolist(), h[a:b].tolist())
                if distance <= edits:
                    out.append((t, i, distance, a + start, a + end))
                    if end > start:
                        around += [(a, a + start), (a + end, b)]
            run = []
        return sorted(set(out))


def build_index(rows: list[tuple[int | None, str | None]], similarity: float = SIMILARITY, recall: float = RECALL) -> Index:
    ids = [i for i, _ in rows]
    *_, firsts, h = text_words(pa.array([t for _, t in rows], pa.string()))
    items = [h[a:b] for a, b in zip(firsts, firsts[1:], strict=False)]
    return Index(ids, items, *classes_of(items, similarity, recall), similarity)


def blocks(benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> Iterator[Index]:
    """The benchmark as indexes of bounded size, one after another."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = math.ceil(total / BLOCK_BYTES)
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        yield build_index([tuple(r) for r in rows], similarity, recall)


_SCHEMA = "doc_id bigint, item_id bigint, similarity double, distance int, start int, end int"


def _report(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for part in pieces(batch):
                data, offsets, starts, ends, firsts, h = text_words(part.column("text"))
                doc_ids, rows = part.column("doc_id"), []
                for t, i, distance, a, b in own.matches(firsts, h):
                    low = offsets[t]
                    chars = char_starts(data[low : offsets[t + 1]])
                    rows.append({"doc_id": doc_ids[t].as_py(), "item_id": own.ids[i], "similarity": 1 - distance / len(own.items[i]), "distance": distance, "start": int(chars[starts[a] - low]), "end": int(chars[ends[b - 1] - low])})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per passage of a document that matches an item; start and end count code points."""
    texts = id_and_text(docs)
    out = texts.sparkSession.createDataFrame([], _SCHEMA)
    for k, index in enumerate(blocks(benchmark, similarity, recall)):
        found = texts.mapInArrow(_report(docs.sparkSession.sparkContext.broadcast(index)), _SCHEMA)
        out = found if not k else out.unionByName(found)
    return out


def _keep(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text")
            for part in pieces(batch, texts):
                *_, firsts, h = text_words(part.column("row").field("text"))
                clean = np.ones(part.num_rows, bool)
                clean[[m[0] for m in index.value.matches(firsts, h)]] = False
                yield part.filter(pa.array(clean))

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of docs without a benchmark passage."""
    rows = docs.select(whole_row(docs))
    schema = rows.schema
    for index in blocks(benchmark, similarity, recall):
        rows = rows.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(index)), schema)
    return rows.select("row.*")
