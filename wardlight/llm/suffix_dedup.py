"""Substring dedup by suffix arrays: bytes under a repeated string of `WINDOW` bytes go.

Every window of `WINDOW` bytes has an anchor, the least hash among its runs of `GRAMS[0]` bytes,
so equal windows have equal anchors. Neighbouring windows with one anchor form a stretch. A shard
takes all stretches of some anchors: whatever repeats, repeats inside a shard.

1. Anchors are found in one scan; a stretch is a narrow row (anchor, digest, place). Equal
   stretches are repeated as a whole and need one representative; of equal ones in a map task no
   more than two are shuffled. An anchor that has no other stretch needs nothing more.
2. The different stretches of an anchor are cut from their documents and dealt to shards by
   anchor. A shard joins them to one string, builds its suffix array by induced sorting and the
   permuted common prefixes; a window is repeated if it shares `WINDOW` bytes with a neighbour.
3. Anchors with more than `MOST` different stretches are not cut: their windows are dealt out
   again under anchors of longer runs, in the end of the whole window. No shard grows with a
   frequent passage.

Defined cases: a null or empty text has no bytes; every row is a document, so texts of repeated
rows (same id and text) repeat each other; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import byte_view, pieces, text_key, text_of
from wardlight.llm.suffix_arrays import common_prefixes, suffix_array
from wardlight.llm.words import U, mix
from wardlight.session import cut_lineage

WINDOW = 400
#: Bytes of an anchor, and of those that windows of frequent anchors get instead.
GRAMS = (128, 320, WINDOW)
#: Different stretches of an anchor in one shard, bytes of a shard, digests a map task remembers.
MOST, SHARD_BYTES, SEEN = 2_048, 1 << 19, 250_000
#: Bits that tell which documents a step needs; their number is fixed, some documents are named without need.
NAMED = 24
_BITMAP = 1 << 15  # bits of one value of bitmap_construct_agg
_LOW = -(2**63)
_CHUNK = 1 << 19  # windows hashed at once
_PLACE = U(20)
_BASE = 0x9E3779B97F4A7C15 | 1

SINGLE, REPEATED, KNOWN = 0, 1, 2  # states of a stretch: judged here; repeated, but a partner; a run of windows that goes
_STRETCH = "anchor bigint, digest bigint, doc bigint, key bigint, start int, n int, state tinyint"
_FIELDS = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("state", pa.int8())])
_CUT = f"{_STRETCH}, frequent boolean, bytes binary"
_CUT_FIELDS = _FIELDS.append(pa.field("frequent", pa.bool_())).append(pa.field("bytes", pa.binary()))
Rows = list[tuple]


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(_CHUNK + WINDOW + 1, base, U)
        out[0] = 1
        return np.multiply.accumulate(out)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def stretches(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, windows, anchor and digest of each stretch of at most `_CHUNK` windows."""
    n = len(data) - window + 1
    powers, inverse = _powers()
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers[: len(data)], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1])
    least = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=U)  # of equal hashes the first
    span, have = window - gram + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least & ((U(1) << _PLACE) - U(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sizes = np.diff(np.append(first, n))
    whole = (sums[first + sizes + window - 1] - sums[first]) * inverse[first]
    return first, sizes, grams[at[first]], mix(whole ^ sizes.astype(U) * U(0xD6E8FEB86659FD93))


def stretches_of(texts: list[np.ndarray], gram: int, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Text, first window, windows, anchor and digest of the stretches of many texts."""
    found = []
    for t, data in enumerate(texts):
        for low in range(0, len(data) - window + 1, _CHUNK):
            part = stretches(data[low : low + _CHUNK + window - 1], window, gram)
            found.append((np.full(len(part[0]), t), part[0] + low, *part[1:]))
    if not found:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, U, U))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def joined(runs: Rows) -> Rows:
    """Runs of windows (doc, key, start, windows) with those that touch made one."""
    out: Rows = []
    for doc, key, start, n in sorted(set(runs)):
        if out and out[-1][:2] == (doc, key) and start <= out[-1][2] + out[-1][3]:
            out[-1] = (doc, key, out[-1][2], max(out[-1][3], start + n - out[-1][2]))
        else:
            out.append((doc, key, start, n))
    return out


def _record(rows: Rows, fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


class Combiner:
    """Of stretches with one digest that a task meets, the first goes on as it is, the second as
    repeated, all others as runs that go."""

    def __init__(self) -> None:
        self.seen: dict[tuple[int, int], int] = {}

    def rows(self, anchor: np.ndarray, digest: np.ndarray, doc: np.ndarray, key: np.ndarray, start: np.ndarray, n: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
        if len(self.seen) > SEEN:
            self.seen.clear()
        pairs = list(zip(anchor.view(np.int64).tolist(), digest.view(np.int64).tolist(), strict=True))
        before = np.empty(len(pairs), np.int64)
        seen = self.seen
        for i, pair in enumerate(pairs):
            before[i] = seen.get(pair, 0)
            seen[pair] = min(before[i] + 1, 2)
        state = np.where(before == 1, REPEATED, state)
        on, known = before < 2, before > 0
        known &= ~((before == 1) & (state == KNOWN))
        gone = joined(list(zip(doc[known].tolist(), key[known].tolist(), start[known].tolist(), n[known].tolist(), strict=True)))
        first = pa.record_batch(
            [pa.array(x[on].astype(t)) for x, t in ((anchor.view(np.int64), np.int64), (digest.view(np.int64), np.int64), (doc, np.int64), (key, np.int64), (start, np.int32), (n, np.int32), (state, np.int8))],
            schema=_FIELDS,
        )
        rest = _record([(0, 0, *run, KNOWN) for run in gone], _FIELDS)
        return pa.Table.from_batches([first, rest]).combine_chunks().to_batches()[0] if len(first) + len(rest) else first


def _find(gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner()
        for batch in batches:
            for part in pieces(batch):
                data, offsets = byte_view(part.column("text"))
                text, start, n, anchor, digest = stretches_of([data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)], gram)
                doc, key = (part.column(c).to_numpy()[text] for c in ("doc", "key"))
                yield combiner.rows(anchor, digest, doc, key, start, n, np.full(len(text), SINGLE, np.int8))

    return run


def _meet(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads stretches sorted by anchor and digest. Gives runs that go, and one each of the different
    stretches of anchors with more than one; `frequent` marks those of anchors with more than `most`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Rows = []
        own: Rows = []  # different stretches of the anchor being read, until they are too many
        first: tuple | None = None  # of the stretches with the digest being read
        again = frequent = False
        before: int | None = None

        def tell() -> None:
            nonlocal frequent
            row = (*first[:6], REPEATED if again else first[6])
            if frequent:
                out.append((*row, True, None))
                return
            own.append(row)
            if len(own) > most:
                out.extend((*x, True, None) for x in own)
                own.clear()
                frequent = True

        def take(row: tuple) -> None:
            nonlocal first, again, frequent
            if first is not None and row[:2] == first[:2]:
                out.extend((0, 0, *x[2:6], KNOWN, False, None) for x in (row, *([] if again else [first])) if x[6] == SINGLE)
                again = True
                return
            if first is not None:
                tell()
            if first is None or row[0] != first[0]:
                close()
            first, again = row, False

        def close() -> None:
            nonlocal frequent
            if len(own) > 1:
                out.extend((*x, False, None) for x in own)
            own.clear()
            frequent = False

        held: pa.RecordBatch | None = None
        for batch in chain(batches, [None]):
            if batch is None:
                batch, held = held, None
            else:
                if held is not None:
                    batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                held = batch.slice(batch.num_rows - 1)
                batch = batch.slice(0, batch.num_rows - 1)
            if batch is None or not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy()
            known = batch.column("state").to_numpy() == KNOWN
            differs = anchor[1:] != anchor[:-1]
            last = held is None or held.column("anchor")[0].as_py() != int(anchor[-1])
            alone = np.append(differs, last) & np.concatenate([[before != int(anchor[0])], differs])
            before = int(anchor[-1])
            yield from _wide(batch.filter(pa.array(known)))
            for row in zip(*(c.to_pylist() for c in batch.filter(pa.array(~alone & ~known)).columns), strict=True):
                take(row)
                if len(out) > 50_000:
                    yield _record(out, _CUT_FIELDS)
                    out.clear()
        if first is not None:
            tell()
        close()
        yield _record(out, _CUT_FIELDS)

    return run


def _wide(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Narrow rows with the columns of cut ones."""
    yield pa.record_batch([*batch.columns, pa.array([False] * batch.num_rows), pa.nulls(batch.num_rows, pa.binary())], schema=_CUT_FIELDS)


def _cut(gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the stretches; of those with a frequent anchor the stretches under longer anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, combiner = zstandard.ZstdDecompressor(), Combiner()
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                out: Rows = []
                again: Rows = []
                parts: list[np.ndarray] = []
                for x in batch.slice(at, 16).to_pylist():
                    data = unpacker.decompress(x["text"])
                    for y in x["found"]:
                        own = data[y["start"] : y["start"] + y["n"] + WINDOW - 1]
                        if y["frequent"]:
                            again.append((x["doc"], x["key"], y["start"], y["state"]))
                            parts.append(np.frombuffer(own, np.uint8))
                        else:
                            out.append((y["anchor"], y["digest"], x["doc"], x["key"], y["start"], y["n"], y["state"], False, own))
                yield _record(out, _CUT_FIELDS)
                if again:
                    t, start, n, anchor, digest = stretches_of(parts, gram)
                    doc, key, base, state = (np.array(c, np.int64)[t] for c in zip(*again, strict=True))
                    yield from _wide(combiner.rows(anchor, digest, doc, key, base + start, n, state))

    return run


def repeated_windows(texts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each text of a shard the places whose window occurs anywhere else in the shard."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    joined_bytes = np.frombuffer(b"\xff".join(texts) + b"\xfe", np.uint8)  # neither is a byte of UTF-8
    s = joined_bytes + np.uint8(2)  # \xff turns into 1, \xfe into the 0 at the end
    order = suffix_array(s.astype(np.int64), 258)
    before, shared = common_prefixes(s, order)
    at = np.flatnonzero(shared >= window)
    repeated = np.zeros(len(s), bool)
    repeated[at] = True
    repeated[before[at]] = True
    return [np.flatnonzero(repeated[e - n - 1 : max(e - window, e - n - 1)]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _shards(shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads cut stretches sorted by anchor, and judges their windows; rows without bytes pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Rows = []
        size, anchor = 0, None

        def judged() -> pa.RecordBatch:
            out: Rows = []
            for (_, _, doc, key, start, _, state, _, _), places in zip(held, repeated_windows([x[8] for x in held]), strict=True):
                if state == SINGLE and len(places):
                    cut = np.flatnonzero(np.diff(places) > 1)
                    firsts, lasts = places[np.append(0, cut + 1)], places[np.append(cut, len(places) - 1)]
                    out.extend((0, 0, doc, key, start + a, b - a + 1, KNOWN, False, None) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True))
            held.clear()
            return _record(out, _CUT_FIELDS)

        for batch in batches:
            narrow = batch.column("bytes").is_null()
            yield batch.filter(narrow)
            for row in zip(*(c.to_pylist() for c in batch.filter(batch.column("bytes").is_valid()).columns), strict=True):
                if size > shard_bytes and row[0] != anchor:
                    yield judged()
                    size = 0
                held.append(row)
                size, anchor = size + len(row[8]), row[0]
        if held:
            yield judged()

    return run


def _slot() -> F.Column:
    return F.xxhash64("doc", "key").bitwiseAND(F.lit((1 << NAMED) - 1))


def _named(keys: DataFrame) -> np.ndarray:
    """For each slot whether it may hold one of the documents (doc, key): 2^NAMED bits reach the driver at most."""
    packed = keys.select(_slot().alias("slot")).groupBy(F.shiftright("slot", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(_BITMAP - 1))).alias("bits"))
    out = np.zeros((1 << NAMED) // 8, np.uint8)
    for row in packed.collect():
        out[row["block"] * _BITMAP // 8 : (row["block"] + 1) * _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _chosen(batch: pa.RecordBatch, named: np.ndarray, inside: bool) -> pa.RecordBatch:
    slot = batch.column("slot").to_numpy()
    return batch.filter(pa.array((named[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1) == inside))


def _pack(named) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of the named documents as zstandard frames: the shuffle's own codec packs them less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in pieces(_chosen(batch, named.value, True)):
                frames = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc"), part.column("key"), pa.array(frames, pa.binary())], names=["doc", "key", "text"])

    return run


def _untouched(named) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents that are not named keep all their bytes; they are not shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(_chosen(batch, named.value, False)):
                kept = part.column("text").cast(pa.binary())
                none = pa.array(np.zeros(part.num_rows, np.int64))
                yield pa.record_batch([part.column("doc"), part.column("key"), pc.binary_length(kept).cast(pa.int64()), none, none, kept], names=["doc", "key", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOW)).alias("doc"), text_key().alias("key"), text_of().alias("text"))


def _packed(docs: DataFrame, named) -> DataFrame:
    return _documents(docs).withColumn("slot", _slot()).mapInArrow(_pack(named), "doc bigint, key bigint, text binary")


def repeated_places(docs: DataFrame, most: int = MOST, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc, key, start, n: the runs of windows of each document that occur anywhere else."""
    level = _documents(docs).filter(F.octet_length("text") >= WINDOW).mapInArrow(_find(GRAMS[0]), _STRETCH)
    run = ("doc", "key", "start", "n")
    gone = None
    for k in range(len(GRAMS)):
        slot = F.when(F.col("state") == KNOWN, F.xxhash64("doc", "key", "start")).otherwise(F.col("anchor"))
        last = k + 1 == len(GRAMS)  # then equal anchors mean equal windows
        met = cut_lineage(level.repartition(slot).sortWithinPartitions("anchor", "digest").mapInArrow(_meet(1 << 62 if last else most), _CUT))
        known = met.filter(F.col("state") == KNOWN).select(*run)
        gone = known if gone is None else gone.unionByName(known)
        wanted = met.filter(F.col("state") != KNOWN)
        found = wanted.groupBy("doc", "key").agg(F.collect_list(F.struct("anchor", "digest", "start", "n", "state", "frequent")).alias("found"))
        named = docs.sparkSession.sparkContext.broadcast(_named(wanted))
        cut = _packed(docs, named).join(found, ["doc", "key"]).select("doc", "key", "text", "found").mapInArrow(_cut(GRAMS[min(k + 1, len(GRAMS) - 1)]), _CUT)
        judged = cut_lineage(cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shards(shard_bytes), _CUT).drop("frequent", "bytes"))
        gone = gone.unionByName(judged.filter(F.col("state") == KNOWN).select(*run))
        level = judged.filter(F.col("state") != KNOWN)
        if last or level.isEmpty():
            return gone
    raise AssertionError


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 32):
            part = batch.slice(at, 32)
            rows = []
            for text, runs in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(), strict=True):
                data = np.frombuffer(unpacker.decompress(text), np.uint8)
                lost = np.zeros(len(data), bool)
                for r in runs or ():
                    lost[r["start"] : r["start"] + r["n"] + WINDOW - 1] = True
                spans = int(lost[:1].sum() + (lost[1:] & ~lost[:-1]).sum())
                rows.append((len(data), int(lost.sum()), spans, data[~lost].tobytes()))
            n, removed, spans, kept = zip(*rows, strict=True)
            yield pa.record_batch([part.column("doc"), part.column("key"), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(kept, pa.binary())], names=["doc", "key", "n_bytes", "n_removed", "n_spans", "kept"])


def strip_repeats(docs: DataFrame, most: int = MOST, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, text_key, n_bytes, n_removed, n_spans and the kept bytes of every row."""
    places = repeated_places(docs, most, shard_bytes)
    named = docs.sparkSession.sparkContext.broadcast(_named(places))
    gone = places.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    columns = "doc bigint, key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    touched = _packed(docs, named).join(gone, ["doc", "key"], "left").select("doc", "key", "text", "gone").mapInArrow(_strip, columns)
    out = touched.unionByName(_documents(docs).withColumn("slot", _slot()).mapInArrow(_untouched(named), columns))
    return out.select(F.when(F.col("doc") != _LOW, F.col("doc")).alias("doc_id"), F.col("key").alias("text_key"), "n_bytes", "n_removed", "n_spans", "kept")
