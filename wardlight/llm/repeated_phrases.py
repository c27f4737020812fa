"""Substring dedup by repeated-phrase automata.

A window is `WINDOW` consecutive words. A word goes if a window that covers it also starts
earlier: in a document with a smaller doc_id, or earlier in the same document.

1. Every window has an anchor, the least hash among its runs of `ANCHOR` words, so equal windows
   have equal anchors. Neighbouring windows with one anchor form a stretch. Anchors met once in
   the whole corpus can't belong to a repeated window; only they are shuffled, without text.
2. Stretches with a repeated anchor are cut from their documents and dealt out by anchor. Each
   task confirms the repeated windows of some thousand stretches, compiles them into one
   Aho-Corasick automaton over words (a word is one letter of a private alphabet) and streams
   the stretches through it in the order of documents: a phrase's first hit stays.
3. The places that go are joined to their documents.

A document whose whole text came before is known to go from the digest of its text and is not
cut. Repeats that meet in a map task are settled there, so a frequent passage sends one row from
each task. An anchor with more than `MOST` different stretches is dealt out again window by
window, where only equal windows meet; no group is held whole.

Defined cases: null and empty texts have no words; rows with a null id come first and rows with
one id in the order of a hash of their text; repeated rows (same id and text) are one document
and get equal results; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, pieces, text_key, text_of
from wardlight.session import cut_lineage

WINDOW, ANCHOR = 20, 5
#: Different stretches of one anchor held at most, and stretches for one automaton.
MOST, TOGETHER = 20_000, 2_000
#: Stretches that a map task holds while it looks for equal ones.
HELD = 30_000
_LOW = -(2**63)
U = np.uint64
_PLACE = U(28)

_STRETCH = "anchor bigint, doc bigint, key bigint, start int, n int"
_CUT = f"slot bigint, {_STRETCH}, words binary"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOW)).alias("doc"), text_key().alias("key"), text_of().alias("text"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstandard frames: they are shuffled twice, and the shuffle's own codec packs them less."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in pieces(batch):
            frames = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("doc"), part.column("key"), pa.array(frames, pa.binary())], names=["doc", "key", "text"])


def _packed(docs: DataFrame) -> DataFrame:
    return _documents(docs).mapInArrow(_pack, "doc bigint, key bigint, text binary")


def later_copies(docs: DataFrame) -> DataFrame:
    """doc, key of documents whose whole text an earlier document has; every window of them goes."""
    low = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOW))
    rows = docs.select(low.alias("doc"), text_key().alias("key"), F.unhex(F.sha2(text_of(), 256)).alias("digest"))
    first = rows.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("size")).filter("size > 1").drop("size")
    return rows.join(first, "digest").filter("doc > first").select("doc", "key").distinct()


def stretches(h: np.ndarray, firsts: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text, first window, windows and anchor of each stretch."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U)
    grams = words.gram_hashes(h, anchor)
    least = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=U)  # of equal hashes the first
    span, have = window - anchor + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least & ((U(1) << _PLACE) - U(1))).astype(np.int64)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    valid = np.flatnonzero(text[:n] == text[window - 1 :])
    new = np.ones(len(valid), bool)
    new[1:] = (at[valid[1:]] != at[valid[:-1]]) | (text[valid[1:]] != text[valid[:-1]])
    begin = np.flatnonzero(new)
    sizes = np.diff(np.append(begin, len(valid)))
    first = valid[begin]
    return text[first], first - firsts[text[first]], sizes, grams[at[first]]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of all documents. seen: 2 for an anchor met before in this piece, 1 if it is met again, else 0."""
    for batch in batches:
        for part in pieces(batch):
            data, offsets = byte_view(part.column("text"))
            starts, ends, firsts = words.spans(data, offsets, "spaced")
            text, start, n, anchor = stretches(words.hashes(data, starts, ends), firsts)
            _, first, where, count = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            seen = np.where(count[where] > 1, 2, 0).astype(np.int8)
            seen[first] = count > 1
            doc, key = (part.column(c).to_numpy()[text] for c in ("doc", "key"))
            yield pa.record_batch([pa.array(anchor.view(np.int64)), pa.array(doc), pa.array(key), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(seen)], names=["anchor", "doc", "key", "start", "n", "seen"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor those whose anchor is met twice. Holds one row between batches."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        anchor, seen = batch.column("anchor").to_numpy(), batch.column("seen").to_numpy()
        again = seen > 0
        same = anchor[1:] == anchor[:-1]
        again[1:] |= same
        again[:-1] |= same
        held = batch.slice(batch.num_rows - 1) if batch.num_rows else None
        if held is not None and again[-1]:  # already told; it only lends its mark to the next rows
            held = held.set_column(5, "seen", pa.array([-1], pa.int8()))
        keep = again & (seen >= 0)
        yield batch.filter(pa.array(keep)).select(["anchor", "doc", "key", "start", "n"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the stretches. Equal ones that meet here go on once, the others as known repeats (words null)."""
    unpacker = zstandard.ZstdDecompressor()
    rows: set[tuple] = set()  # a repeated row is the same document
    known: list[tuple[int, int, int, int]] = []

    def settled() -> pa.RecordBatch:
        out, seen = [], set()
        for anchor, doc, key, start, n, text in sorted(rows):
            if text in seen:
                known.append((doc, key, start, n))
            else:
                seen.add(text)
                out.append((anchor, anchor, doc, key, start, n, text))
        out += [(doc ^ key ^ start, 0, doc, key, start, n, None) for doc, key, start, n in joined(known)]
        rows.clear()
        known.clear()
        return _batch(out)

    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            for x in batch.slice(at, 16).to_pylist():
                if x["copy"]:  # all windows of a later copy are repeated, so its stretches are what goes
                    known += [(x["doc"], x["key"], y["start"], y["n"]) for y in x["found"]]
                else:
                    split = unpacker.decompress(x["text"]).split()
                    rows.update((y["anchor"], x["doc"], x["key"], y["start"], y["n"], b" ".join(split[y["start"] : y["start"] + y["n"] + WINDOW - 1])) for y in x["found"])
            if len(rows) + len(known) > HELD:
                yield settled()
    yield settled()


def joined(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs of windows (doc, key, start, windows) with those that touch made one."""
    out: list[tuple[int, int, int, int]] = []
    for doc, key, start, n in sorted(set(runs)):
        if out and out[-1][:2] == (doc, key) and start <= out[-1][2] + out[-1][3]:
            out[-1] = (doc, key, out[-1][2], max(out[-1][3], start + n - out[-1][2]))
        else:
            out.append((doc, key, start, n))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slot", "anchor", "doc", "key", "start", "n", "words"])


def repeats(held: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """From stretches (doc, key, start, words) in the order of documents within each anchor, the
    runs of windows (doc, key, start, windows) that occur earlier among them."""
    alphabet: dict[bytes, int] = {}

    def letters(text: bytes) -> str:
        codes = [alphabet.setdefault(w, len(alphabet) + 32) for w in text.split(b" ")]
        return "".join(chr(c if c < 0xD800 else c + 0x800) for c in codes)

    coded = [letters(x[3]) for x in held]
    count: dict[str, int] = {}
    for text in coded:
        for i in range(len(text) - WINDOW + 1):
            phrase = text[i : i + WINDOW]
            count[phrase] = count.get(phrase, 0) + 1
    automaton = ahocorasick.Automaton()
    confirmed = 0
    for phrase, n in count.items():
        if n > 1:
            automaton.add_word(phrase, confirmed)
            confirmed += 1
    if not confirmed:
        return []
    automaton.make_automaton()
    met = bytearray(confirmed)
    out: list[tuple[int, int, int, int]] = []
    for (doc, key, start, _), text in zip(held, coded, strict=True):
        first, n = None, 0
        for end, phrase in automaton.iter(text):
            if not met[phrase]:
                met[phrase] = 1
                continue
            place = start + end - WINDOW + 1
            if first is not None and place == first + n:
                n += 1
                continue
            if first is not None:
                out.append((doc, key, first, n))
            first, n = place, 1
        if first is not None:
            out.append((doc, key, first, n))
    return out


def _settle(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads stretches sorted by slot, anchor, doc, key, start.

    Gives rows without words for what goes, and rows with words and a new slot for the windows
    of anchors with too many stretches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: list[tuple] = []
        again: list[tuple] = []
        done: list[tuple[int, int, int, bytes]] = []  # stretches of anchors that are complete
        own: list[tuple[int, int, int, bytes]] = []  # of the anchor being read
        seen: set[bytes] = set()
        current, large = None, False

        def windows(doc: int, key: int, start: int, text: bytes) -> None:
            split = text.split(b" ")
            data = np.frombuffer(text, np.uint8)
            starts, ends, _ = words.spans(data, np.array([0, len(data)]), "spaced")
            slots = words.gram_hashes(words.hashes(data, starts, ends), WINDOW).view(np.int64).tolist()
            again.extend((s, s, doc, key, start + i, 1, b" ".join(split[i : i + WINDOW])) for i, s in enumerate(slots))

        def compile_done() -> None:
            gone.extend((0, 0, d, k, s, n, None) for d, k, s, n in repeats(done))
            done.clear()

        for batch in batches:
            _, anchors, docs, keys, starts, ns, texts = (c.to_pylist() for c in batch.columns)
            for anchor, doc, key, start, n, text in zip(anchors, docs, keys, starts, ns, texts, strict=True):
                if text is None:
                    gone.append((0, 0, doc, key, start, n, None))
                    continue
                if anchor != current:
                    if len(done) + len(own) > TOGETHER:
                        compile_done()
                    done.extend(own)
                    own, seen, current, large = [], set(), anchor, False
                if text in seen:  # an equal stretch of an earlier place: all its windows go
                    gone.append((0, 0, doc, key, start, n, None))
                elif large:
                    windows(doc, key, start, text)
                else:
                    seen.add(text)
                    own.append((doc, key, start, text))
                    if len(own) > most:
                        for x in own:
                            windows(*x)
                        own, seen, large = [], set(), True
                if len(gone) + len(again) > HELD:
                    yield _batch(gone + again)
                    gone.clear()
                    again.clear()
        done.extend(own)
        compile_done()
        yield _batch(gone + again)

    return run


def repeated_places(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc, key, start, n: the runs of windows of each document that occur earlier."""
    texts = _documents(docs)
    found = texts.mapInArrow(_find, f"{_STRETCH}, seen tinyint")
    # Anchors met before in the same piece need no partner: they are spread by document.
    slot = F.when(F.col("seen") == 2, F.xxhash64("doc", "key", "start")).otherwise(F.col("anchor"))
    met = found.repartition(slot).sortWithinPartitions("anchor").mapInArrow(_repeated, _STRETCH)
    copies = later_copies(docs).withColumn("copy", F.lit(True))
    own = met.groupBy("doc", "key").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("found"))
    own = own.join(copies, ["doc", "key"], "left")
    level = _packed(docs).join(own, ["doc", "key"]).select("doc", "key", "text", "found", "copy").mapInArrow(_cut, _CUT)
    gone = None
    while True:
        dealt = level.repartition("slot").sortWithinPartitions("slot", "anchor", "doc", "key", "start")
        settled = cut_lineage(dealt.mapInArrow(_settle(most), _CUT))
        new = settled.filter("words IS NULL").select("doc", "key", "start", "n")
        gone = new if gone is None else gone.unionByName(new)
        level = settled.filter("words IS NOT NULL")
        if level.isEmpty():
            return gone


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            kept, total, lost = [], [], []
            for text, runs in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(), strict=True):
                split = unpacker.decompress(text).split()
                stay = np.ones(len(split), bool)
                for r in runs or ():
                    stay[r["start"] : r["start"] + r["n"] + WINDOW - 1] = False
                kept.append(b" ".join(split[i] for i in np.flatnonzero(stay).tolist()).decode())
                total.append(len(split))
                lost.append(len(split) - int(stay.sum()))
            yield pa.record_batch([part.column("doc"), part.column("key"), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())], names=["doc", "key", "n_words", "n_removed", "kept"])


def strip_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, text_key, n_words, n_removed and the kept words of every row."""
    gone = repeated_places(docs, most).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    joined = _packed(docs).join(gone, ["doc", "key"], "left").select("doc", "key", "text", "gone")
    out = joined.mapInArrow(_strip, "doc bigint, key bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.when(F.col("doc") != _LOW, F.col("doc")).alias("doc_id"), F.col("key").alias("text_key"), "n_words", "n_removed", "kept")
