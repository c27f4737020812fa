"""SimHash near-duplicates found by covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's three-word shingles.
For radius r, 2^(r+1) - 1 structured bit masks make every pair within r differing bits equal
under at least one mask: bit i has a vector m(i) of r+1 bits, mask v keeps bit i where v and
m(i) have an odd number of common bits, and r vectors always have a common v that is even
with all of them.

A bucket with more than `most` fingerprints is never held: it is dealt out again over r+1
longer keys (the bits left out are cut into r+1 blocks, of which two texts within r bits share
one), until buckets are small or so few bits are left that all are within r. Buckets give the
edges of a spanning forest, not pairs.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; rows
with equal text share a fingerprint and a component; a null doc_id never is a component's id
unless all its ids are null; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import id_and_text, keep_rows, pieces, text_key
from wardlight.llm.components import components
from wardlight.session import cut_lineage

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
MOST = 4096
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of k words, of the whole sequence if it is shorter."""
    words = text.translate(_LOWER).split()  # bytes split at the space and the controls 09 to 0D
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    last = ends[k - 1 :] if len(words) >= k else ends[-1:]
    runs = [joined[s:e] for s, e in zip(starts[:n].tolist(), last.tolist(), strict=True)]
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """For each list of hashes the bits that are set in over half of them; zero for none.

    One byte-wide counter for each of eight bits is added at a time, over runs of 255 hashes.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat, sizes = np.concatenate([hashes[i] for i in full]), sizes[full]
    firsts = np.cumsum(sizes) - sizes
    parts = -(-sizes // 255)
    runs = np.repeat(firsts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    groups = np.cumsum(parts) - parts
    found = np.zeros(len(full), np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(bit)) & _LANES, runs).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), groups, axis=0)
        for lane in range(8):
            found |= (2 * counts[:, lane] > sizes).astype(np.uint64) << np.uint64(8 * lane + bit)
    out[full] = found
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            found = majority([shingle_hashes(t.encode()) for t in part.column("text").to_pylist()])
            yield pa.record_batch([part.column("doc_id"), part.column("text_key"), pa.array(found.view(np.int64))], names=["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and fingerprint (a signed long) of every row."""
    return id_and_text(docs).withColumn("text_key", text_key()).mapInArrow(_fingerprints, "doc_id bigint, text_key bigint, fp bigint")


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _free_blocks(used: int, radius: int) -> list[int]:
    """The keys of the next level: the bits in use and one of radius + 1 blocks of the others."""
    free = [i for i in range(BITS) if not used >> i & 1]
    return [used | reduce(lambda a, i: a | 1 << i, free[b :: radius + 1], 0) for b in range(radius + 1)]


def forest(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (first, other) of a spanning forest of the fingerprints within radius of each other."""
    left, edges = fps, []
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(front), 64):
                near |= (np.bitwise_count(front[at : at + 64, None] ^ left[None, :]) <= radius).any(axis=0)
            front, left = left[near], left[~near]
            edges += [(int(root), int(x)) for x in front]
    return edges


def _links(most: int, radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads (used, key, fp) sorted by bucket. Gives edges (null, a, b), and (used, fp, null) of buckets to deal out again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int | None, int, int | None]] = []
        held: list[np.ndarray] = []
        bucket, size, root = None, 0, None

        def again(fps: np.ndarray) -> None:
            used = int(bucket[0]) & (2**64 - 1)
            if BITS - used.bit_count() <= radius:  # all texts in this bucket are near each other
                out.extend((None, int(root), int(x)) for x in fps if x != root)
            else:
                out.extend((_signed(mask), int(x), None) for mask in _free_blocks(used, radius) for x in fps)

        def close() -> None:
            if 1 < size <= most:
                out.extend((None, a, b) for a, b in forest(np.concatenate(held).view(np.uint64), radius))

        def rows() -> pa.RecordBatch:
            used, a, b = zip(*out, strict=True) if out else ((), (), ())
            wrap = [None if x is None else _signed(x & (2**64 - 1)) for x in (*a, *b)]
            out.clear()
            return pa.record_batch([pa.array(used, pa.int64()), pa.array(wrap[: len(a)], pa.int64()), pa.array(wrap[len(a) :], pa.int64())], names=["used", "a", "b"])

        for batch in batches:
            used, key, fp = (batch.column(i).to_numpy() for i in range(3))
            edge = np.flatnonzero((used[1:] != used[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], edge]) if len(used) else np.empty(0, np.int64)
            ends = np.concatenate([edge, [len(used)]])
            # Of a run inside the batch only those of two and more matter; the first and last may go on.
            keep = np.flatnonzero((ends[: len(starts)] - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1))
            for i in keep.tolist():
                s, e = int(starts[i]), int(ends[i])
                if bucket != (used[s], key[s]):
                    close()
                    bucket, size, root, held = (used[s], key[s]), 0, fp[s], []
                fps, was = fp[s:e], size
                size += e - s
                if size <= most:
                    held.append(fps)
                else:
                    if was <= most and held:
                        again(np.concatenate(held))
                        held = []
                    again(fps)
                if len(out) >= 50_000:
                    yield rows()
        if bucket is not None:
            close()
        yield rows()

    return run


def near_edges(fps: DataFrame, most: int = MOST, radius: int = RADIUS) -> DataFrame:
    """From distinct fingerprints (fp): edges (a, b) that connect all that lie within radius, by chains."""
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(BITS, radius)])
    level = fps.select(F.explode(masks).alias("used"), "fp")
    edges = None
    while True:
        keyed = level.withColumn("key", F.col("fp").bitwiseAND(F.col("used"))).select("used", "key", "fp")
        sorted_rows = keyed.repartition("used", "key").sortWithinPartitions("used", "key", "fp")
        found = cut_lineage(sorted_rows.mapInArrow(_links(most, radius), "used bigint, a bigint, b bigint"))
        new = found.filter("used IS NULL").select("a", "b")
        edges = new if edges is None else edges.unionByName(new)
        level = found.filter("used IS NOT NULL").select("used", F.col("a").alias("fp"))
        if level.isEmpty():
            return edges


def near_groups(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One row per row of docs: doc_id, text_key, fp, component_id."""
    rows = cut_lineage(fingerprints(docs))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    stars = components(near_edges(distinct.select("fp"), most))
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp")
    linked = members.join(distinct, "fp")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(least, "root").select("fp", "component_id")
    ids = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(ids, "fp").select("doc_id", "text_key", "fp", "component_id")


def drop_near(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id."""
    groups = near_groups(docs, most)
    # Where all ids of a component are null the fingerprint stands for it.
    best = Window.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    chosen = groups.withColumn("row", F.row_number().over(best)).filter("row = 1").select("doc_id", "text_key")
    return keep_rows(docs, chosen)
