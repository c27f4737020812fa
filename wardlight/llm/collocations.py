"""Phrase collocation mining by dynamic itemset counting.

Texts are cut into words once: the corpus of word hashes is dealt into `SHARDS` shards that are
scanned in a cycle. Words are counted from the first scan on. A longer phrase is counted from the
scan on after which both its parts (all but the last word, all but the first) had reached the
threshold, whatever its length, and until it has met every shard once; so lengths are counted side
by side. Sums are carried from scan to scan as long as a phrase is in its cycle. The work ends when
no phrase is left in its cycle.

When a phrase has reached the threshold is kept in a table of `TABLE_BITS`, one byte a slot, that
every task reads: its size is fixed, whatever the corpus holds. Phrases that share a slot are
counted earlier or for nothing; never later or in fewer shards, since a slot that is set stays as
it is. The scans count 64-bit hashes of language and phrase, so two phrases in 10^8 share one with
odds below 1 in 3,000. A last scan, of the texts, looks up each hash at a few of its places, so many
that it seldom misses one; what it misses is looked for in a second scan at all places.

Defined cases: a null text has no words; a null lang is `und`; empty pieces and texts give
nothing; repeated rows count as often as they are met; phrases never cross a piece, a document or
a language; an empty table gives no rows; other columns are not looked at. Texts are read twice, to
count and to name, and have to be the same each time.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, pieces, text_of
from wardlight.session import cut_lineage, shared_dir

LONGEST, LEAST, COVER, TOP = 5, 100, 100, 2000
SHARDS, TABLE_BITS = 3, 24
#: Of N phrases each is named from ln(N) places and so many more, or up to twice as many, whatever its
#: count: the odds that one of the N is missed are below 1 in 20.
SPARE_SIGHTINGS = 3
#: Hashes, and different phrases, that a task holds.
HELD, HELD_TEXTS = 4 << 20, 200_000
#: Bytes up to which the polynomial hash tells words apart; longer ones with a pattern can share it.
PLAIN = 64
NEVER = 255
_BITMAP = 1 << 15  # bits of one value of bitmap_construct_agg
U = np.uint64
_BASE = U(0xD1342543DE82EF95)

_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 0


def phrase_words(langs: pa.Array, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, and of every word its text, start, end, piece and a hash of language and word."""
    data, offsets = byte_view(texts)
    data = words.LOWER[data]
    kind = _KIND[data]
    inside, cut = kind == 2, np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    stop[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    cut[:-1] |= kind == 0
    piece = np.searchsorted(np.flatnonzero(cut), starts, "right")
    text = np.searchsorted(offsets, starts, "right") - 1
    coded = langs.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x.encode()) for x in coded.dictionary.to_pylist()], U)
    h = words.hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > PLAIN).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    if len(h):
        h = words.mix(h ^ known[coded.indices.to_numpy(zero_copy_only=False)][text])
    return data, text, starts, ends, piece, h


class Steps:
    """The table, packed on its way to the tasks: most slots are alike."""

    def __init__(self, value: np.ndarray):
        self.value = value

    def __getstate__(self) -> bytes:
        return zstandard.compress(self.value.tobytes())

    def __setstate__(self, packed: bytes) -> None:
        self.value = np.frombuffer(zstandard.decompress(packed), np.uint8)


def slots(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (h & U(len(table) - 1)).astype(np.int64)


def phrases(h: np.ndarray, piece: np.ndarray, table: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, first words, hashes and first scan of the phrases that are counted or were.

    A phrase of two words and more is one whose two parts have reached the threshold.
    """
    at, g, began = np.arange(len(h)), h, np.zeros(len(h), np.int16)
    for n in range(1, longest + 1):
        yield n, at, g, began
        seen = table[slots(g, table)]
        alive = np.flatnonzero(seen != NEVER)
        at, g, seen = at[alive], g[alive], seen[alive].astype(np.int16)
        if len(at) < 2:
            return
        pair = np.flatnonzero(at[1:] == at[:-1] + 1)
        pair = pair[piece[at[pair]] == piece[at[pair] + n]]
        began = np.maximum(seen[pair], seen[pair + 1]) + 1
        at = at[pair]
        g = words.mix(g[pair] * _BASE + h[at + n])


def add_up(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h)
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


def _deal(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words of the documents of a shard: their different hashes, the place of each word's hash among those, and whether it begins a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = TaskContext.get().partitionId()
        for batch in batches:
            for part in pieces(batch):
                _, text, _, _, piece, h = phrase_words(part.column("lang"), part.column("text"))
                for shard in range(shards):
                    own = np.flatnonzero((text + met) % shards == shard)
                    if len(own):
                        coded = pa.array(h[own].view(np.int64)).dictionary_encode()
                        begins = np.diff(piece[own], prepend=-1) != 0
                        packed = (coded.dictionary.to_numpy().tobytes(), coded.indices.to_numpy().astype(np.int32).tobytes(), np.packbits(begins).tobytes())
                        yield pa.record_batch([pa.array([shard], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=["shard", "hashes", "places", "begins"])
                met += part.num_rows

    return run


def _dealt(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and piece of every word, by row of the dealt corpus."""
    for hashes, places, begins in zip(*(batch.column(c) for c in ("hashes", "places", "begins")), strict=True):
        at = np.frombuffer(places.as_buffer(), np.int32)
        yield np.frombuffer(hashes.as_buffer(), U)[at], np.cumsum(np.unpackbits(np.frombuffer(begins.as_buffer(), np.uint8), count=len(at)), dtype=np.int64)


def _count(table, step: int, shards: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the phrases whose cycle takes in this step, added up in the task, and the last step of their cycle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict[int, list[np.ndarray]] = {until: [] for until in range(step, step + shards)}
        summed: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def fold() -> None:
            for until, own in raw.items():
                if own:
                    h, c = np.unique(np.concatenate(own), return_counts=True)
                    summed[until] = add_up(*([x, y] for x, y in zip(summed[until], (h, c), strict=True))) if until in summed else (h, c)
                    own.clear()

        def given() -> Iterator[pa.RecordBatch]:
            fold()
            for until, (h, c) in summed.items():
                for low in range(0, len(h), 1 << 18):
                    own = h[low : low + (1 << 18)].view(np.int64)
                    yield pa.record_batch([pa.array(own), pa.array(c[low : low + (1 << 18)].astype(np.int64)), pa.array(np.full(len(own), until, np.int32))], names=["h", "total", "until"])
            summed.clear()

        for batch in batches:
            for h, piece in _dealt(batch):
                for _, _, g, began in phrases(h, piece, table.value.value, longest):
                    for until, own in raw.items():
                        at = np.flatnonzero(began == until - shards + 1)
                        if len(at):
                            own.append(g[at])
                if sum(len(x) for own in raw.values() for x in own) > HELD:
                    fold()
                    if sum(len(h) for h, _ in summed.values()) > HELD:
                        yield from given()
        yield from given()

    return run


def _name(table, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of phrases, each from a few of its places; and, with a null phrase, the number of words of a language.

    A slot of the table holds by how many halvings the places of its phrases are thinned out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        total: Counter[str] = Counter()

        def given() -> pa.RecordBatch:
            rows = [(h, *x) for h, x in found.items()] + [(None, lang, None, n) for lang, n in total.items()]
            found.clear()
            total.clear()
            h, lang, phrase, n = zip(*rows, strict=True) if rows else ((),) * 4
            return pa.record_batch([pa.array(np.array(h[: len(h) - h.count(None)], U).view(np.int64).tolist() + [None] * h.count(None), pa.int64()), pa.array(lang, pa.string()), pa.array(phrase, pa.binary()), pa.array(n, pa.int64())], names=["h", "lang", "phrase", "n"])

        for batch in batches:
            for part in pieces(batch):
                langs, thin = part.column("lang").to_pylist(), table.value.value
                data, text, starts, ends, piece, h = phrase_words(part.column("lang"), part.column("text"))
                for t, n in enumerate(np.bincount(text, minlength=len(langs)).tolist()):
                    total[langs[t]] += n
                draw = words.mix(np.arange(len(h), dtype=U) + U(xxhash.xxh64_intdigest(data[: 1 << 16].tobytes())))
                for n, at, g, _ in phrases(h, piece, thin, longest):
                    halvings = thin[slots(g, thin)]
                    kept = np.flatnonzero(halvings != NEVER)
                    kept = kept[words.mix(g[kept] ^ draw[at[kept]]) & ((U(1) << halvings[kept].astype(U)) - U(1)) == 0]
                    unique, first = np.unique(g[kept], return_index=True)
                    for key, a in zip(unique.tolist(), at[kept][first].tolist(), strict=True):
                        if key not in found:
                            own = data[starts[a] : ends[a + n - 1]].tobytes()
                            found[key] = (langs[text[a]], b" ".join(own.split()) if n > 1 else own, n)
                if len(found) > HELD_TEXTS:
                    yield given()
        yield given()

    return run


def _bitmap(rows: DataFrame, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """From rows (level, h) the slots of the hashes of each level, in parts: at most 2^bits bits a level reach the driver.

    They come in one job: an iterator would start one for each partition.
    """
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    packed = rows.select("level", slot.alias("slot")).groupBy("level", F.shiftright("slot", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(_BITMAP - 1))).alias("bits"))
    for row in sorted(packed.collect(), key=lambda r: r["level"]):
        yield row["level"], row["block"] * _BITMAP + np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little"))


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = TABLE_BITS, sightings: float | None = None) -> DataFrame:
    """lang, phrase, size, c: every phrase of up to `longest` words with at least `least` occurrences,
    and for each language a row with a null phrase and size 0 that counts all its words."""
    spark = docs.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/phrases-{uuid.uuid4().hex}"
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    packed = "hashes binary, places binary, begins binary"
    texts.mapInArrow(_deal(shards), f"shard int, {packed}").write.option("compression", "zstd").partitionBy("shard").parquet(f"{base}/corpus")
    corpus = spark.read.schema(f"{packed}, shard int").parquet(f"{base}/corpus")
    kept = "h long, total long, until int"
    reached = F.col("total") >= least
    table = np.full(1 << bits, NEVER, np.uint8)
    step, last = 0, -1  # the last step after which a phrase reached the threshold
    while step <= last + shards:
        if step >= NEVER:
            raise ValueError(f"{shards} shards need more scans than the table can tell apart")
        shared = spark.sparkContext.broadcast(Steps(table.copy()))
        rows = corpus.filter(F.col("shard") == step % shards).drop("shard").mapInArrow(_count(shared, step, shards, longest), kept)
        if step:
            rows = rows.unionByName(spark.read.schema(kept).parquet(f"{base}/counts/{step - 1:03d}").filter(F.col("until") >= step))
        summed = rows.groupBy("h").agg(F.sum("total").alias("total"), F.max("until").alias("until"))
        # A phrase that has met every shard is kept if it reached the threshold: its last sum is its count.
        summed.filter((F.col("until") > step) | reached).write.parquet(f"{base}/counts/{step:03d}")
        shared.unpersist()
        for _, slot in _bitmap(spark.read.schema(kept).parquet(f"{base}/counts/{step:03d}").filter(reached).select(F.lit(0).alias("level"), "h"), bits):
            new = slot[table[slot] == NEVER]
            table[new] = step
            last = step if len(new) else last
        step += 1
    counts = cut_lineage(spark.read.schema(kept).parquet(*[f"{base}/counts/{s:03d}" for s in range(step)]).filter(reached).groupBy("h").agg(F.max("total").alias("c")))
    if sightings is None:
        sightings = math.log(counts.count() + 1) + SPARE_SIGHTINGS
    names, scans = None, 0
    unnamed = counts.select(F.greatest(F.floor(F.log2(F.col("c") / sightings)), F.lit(0)).cast("int").alias("level"), "h")
    while names is None or not unnamed.isEmpty():
        if scans == 2:  # the second one looks at all places
            raise RuntimeError("the texts have changed between two scans")
        scans += 1
        thin = np.full(1 << bits, NEVER, np.uint8)
        for level, slot in _bitmap(unnamed, bits):  # in rising order: phrases that share a slot are thinned as the rarer
            thin[slot[thin[slot] == NEVER]] = level
        if names is not None:  # longer phrases are found by way of their parts
            thin[(table != NEVER) & (thin == NEVER)] = NEVER - 1
        found = texts.mapInArrow(_name(spark.sparkContext.broadcast(Steps(thin)), longest), "h bigint, lang string, phrase binary, n bigint")
        own = cut_lineage(found.groupBy("h", F.when(F.col("h").isNull(), F.col("lang")).alias("whole")).agg(F.min("lang").alias("lang"), F.min(F.col("phrase").cast("string")).alias("phrase"), F.sum("n").alias("n"), F.max("n").alias("size")))
        if names is None:
            totals = own.filter("h IS NULL").select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("size"), F.col("n").alias("c"))
        own = own.filter("h IS NOT NULL").select("h", "lang", "phrase", F.col("size").cast("int").alias("size"))
        names = own if names is None else names.unionByName(own.join(unnamed, "h", "left_semi"))
        unnamed = counts.join(names, "h", "left_anti").select(F.lit(0).alias("level"), "h")
    return names.join(counts, "h").select("lang", "phrase", "size", "c").unionByName(totals)


def _run(first, n) -> F.Column:
    """The words from place `first` (from 1) on, n of them."""
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP, shards: int = SHARDS, bits: int = TABLE_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language by the weakest cut.

    Dropped before ranking is a phrase that lies in a longer one with at least `cover` percent of
    its occurrences. Products are decimals of 38 digits, so scores are exact.
    """
    counted = cut_lineage(frequent(docs, least, shards=shards, bits=bits))  # read six times below
    parts = counted.filter("size > 0").select("lang", "phrase", "c")
    totals = counted.filter("size = 0").select("lang", F.col("c").alias("n"))
    candidates = counted.filter("size > 1").select("lang", "phrase", "size", F.col("c").alias("a"), F.split("phrase", " ").alias("words"))

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", _run(F.lit(1), F.col("k")).alias("first"), _run(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cut = cut.join(parts.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"])
    cut = cut.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"]).join(totals, "lang")
    whole = "decimal(19,0)"
    score = F.expr(f"(cast(1000 as {whole}) * cast(a as {whole}) * cast(n as {whole})) div (cast(l as {whole}) * cast(r as {whole}))")
    scored = cut.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")

    runs = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: _run(i, n))))
    longer = candidates.filter("size > 2").select("lang", F.explode(runs).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
