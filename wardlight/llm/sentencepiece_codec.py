"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text gets a space in front, spaces become the word mark, and the best sum of piece scores
decides. Texts are cut before runs of spaces and around line ends, which no piece crosses, so
the best cut of each word is the best cut of the text. Distinct words of equal length advance
together: hashes of all their substrings probe the sorted hashes of the pieces, and maxima over
the piece lengths store backpointers. Of equal sums the one with the shorter last piece wins.
A character without a piece costs `UNKNOWN` below the worst score and is written as its UTF-8
bytes; so is a word mark that is part of the text itself. decode(encode(text)) == text for
every text.

The vocabulary is a file made elsewhere. If its scores are merge ranks, the pieces are those of
the best sum of scores, not those a merge order gives.

Defined cases: null and empty texts give no ids, and no ids decode to the empty text; ids out of
range and control ids decode to nothing; bytes that are no UTF-8 decode to the replacement
character; an empty table gives no rows; other columns are kept apart in a struct or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import pieces, text_of
from wardlight.llm.words import Lookup, mix

#: Where the vocabulary lies on the driver's machine; it is sent to the tasks from there.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK, UNKNOWN = "▁", 10.0
#: Words a task remembers before it starts anew, and code points advanced together at most.
REMEMBERED, TOGETHER = 200_000, 1 << 20
_WORDS = re.compile(r" *[^ \n]+|\n| +")
_LITERAL = 0x110000  # stands for a word mark that is part of the text
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    hashes: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    longest: int
    unknown: float
    raw: list[bytes]

    def __post_init__(self) -> None:
        self.lookup = Lookup(self.hashes, self.ids)
        self.lengths = np.array([len(b) for b in self.raw], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)


def code_points(words: list[str]) -> np.ndarray:
    """The code points of equally long words, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint32)


def _prefixes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), codes.shape[1] + 1), U)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + codes[:, i].astype(U) + U(1)
    return out


def _power(n: int) -> np.uint64:
    return U(pow(int(_BASE), n, 1 << 64))


def vocabulary(pieces_: list[tuple[str, float]], byte_ids: dict[int, int], controls: set[int]) -> Vocabulary:
    """From all pieces in the order of their ids; byte pieces and controls match no text."""
    normal = [i for i in range(len(pieces_)) if i not in controls and i not in set(byte_ids.values())]
    if any(MARK in pieces_[i][0].lstrip(MARK) or "\n" in pieces_[i][0] for i in normal):
        raise ValueError("pieces may hold word marks in front only, and no line ends")
    hashes = np.empty(len(normal), U)
    for k, i in enumerate(normal):
        text = pieces_[i][0]
        hashes[k] = mix(_prefixes(code_points([text]))[:, -1] + U(len(text)))[0]
    scores = np.array([s for _, s in pieces_], float)
    raw = [b"" if i in controls else text.replace(MARK, " ").encode() for i, (text, _) in enumerate(pieces_)]
    for byte, i in byte_ids.items():
        raw[i] = bytes([byte])
    return Vocabulary(hashes, np.array(normal, np.int64), scores, np.array([byte_ids[b] for b in range(256)], np.int32), max(len(pieces_[i][0]) for i in normal), float(scores[normal].min()) - UNKNOWN, raw)


def load(path: str = MODEL_FILE) -> Vocabulary:
    """Reads the pieces of a model file; only the list is used, not the file's encoder."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    all_ids = range(model.get_piece_size())
    byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in all_ids if model.is_byte(i)}
    controls = {i for i in all_ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    return vocabulary([(model.id_to_piece(i), model.get_score(i)) for i in all_ids], byte_ids, controls)


def _paths_together(found: list[np.ndarray], scores: list[np.ndarray], n: int, length: int, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """For each word and end the length and id of the last piece of the best path."""
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    size, last = np.zeros((n, length + 1), np.int32), np.full((n, length + 1), -1, np.int64)
    for end in range(1, length + 1):
        top, taken, ids = best[:, end], size[:, end], last[:, end]
        for k in range(1, min(len(found), end) + 1):
            own = found[k - 1][:, end - k]
            sums = best[:, end - k] + scores[k - 1][:, end - k]
            better = sums > top
            top[better], taken[better], ids[better] = sums[better], k, own[better]
    return size, last


def encode_words(words: list[str], v: Vocabulary) -> list[np.ndarray]:
    """The ids of each word, in which spaces stand for word marks."""
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        together = max(1, TOGETHER // max(1, length * min(length, v.longest)))
        for at in range(0, len(rows), together):
            own = rows[at : at + together]
            if length:
                _encode_equal([words[i] for i in own], own, length, v, out)
    return out


def _encode_equal(words: list[str], rows: np.ndarray, length: int, v: Vocabulary, out: list[np.ndarray]) -> None:
    n = len(words)
    codes = code_points(words)
    literal = codes == ord(MARK)
    codes = np.where(codes == 0x20, ord(MARK), codes)
    codes[literal] = _LITERAL
    sums = _prefixes(codes)
    found, scores = [], []
    for k in range(1, min(v.longest, length) + 1):
        hashes = mix(sums[:, k:] - sums[:, : length + 1 - k] * _power(k) + U(k)).ravel()
        at, ids = v.lookup.find(hashes)
        named = np.full(len(hashes), -1, np.int64)
        worth = np.full(len(hashes), v.unknown if k == 1 else -np.inf)
        named[at], worth[at] = ids, v.scores[ids]
        found.append(named.reshape(n, -1))
        scores.append(worth.reshape(n, -1))
    size, last = _paths_together(found, scores, n, length, v.unknown)
    # All words step back together; the steps of a word come out last first.
    end = np.full(n, length, np.int64)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive = np.arange(n)
    while len(alive):
        e = end[alive]
        ids, sizes = last[alive, e], size[alive, e]
        steps.append((alive, ids, codes[alive, e - 1]))
        end[alive] = e - sizes
        alive = alive[end[alive] > 0]
    who, ids, code = (np.concatenate([s[i] for s in steps]) for i in range(3))
    order = np.lexsort((-np.arange(len(who)), who))
    who, ids, code = who[order], ids[order], code[order]
    cuts = np.searchsorted(who, np.arange(n + 1))
    strange = np.zeros(n, bool)
    strange[who[ids < 0]] = True
    ids = ids.astype(np.int32)
    for i in range(n):
        a, b = cuts[i], cuts[i + 1]
        if strange[i]:
            parts = [ids[j : j + 1] if ids[j] >= 0 else v.byte_ids[list((MARK if code[j] == _LITERAL else chr(code[j])).encode("utf-8", "surrogatepass"))] for j in range(a, b)]
            out[rows[i]] = np.concatenate(parts)
        else:
            out[rows[i]] = ids[a:b]


def gather(flat: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of flat at the given places, one after another."""
    total = int(lengths.sum())
    return flat[np.repeat(places - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)]


class Encoder:
    """Encodes texts and remembers a bounded number of words."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.places, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self.index) > REMEMBERED:
            self._forget()
        split = [_WORDS.findall(" " + t) if t else [] for t in texts]
        new = list({w: None for ws in split for w in ws if w not in self.index})
        if new:
            coded = encode_words(new, self.v)
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.places = np.concatenate([self.places, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, *coded])
        counts = np.fromiter(map(len, split), np.int64, len(split))
        which = np.fromiter((self.index[w] for ws in split for w in ws), np.int64, int(counts.sum()))
        sizes = self.lengths[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return gather(self.flat, self.places[which], sizes), np.diff(ends)


def decode_ids(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> list[str]:
    """The text of each run of ids, without the space put in front."""
    known = (ids >= 0) & (ids < len(v.raw))
    safe = np.where(known, ids, 0)
    sizes = np.where(known, v.lengths[safe], 0)
    data = gather(v.flat, v.places[safe], sizes).tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [data[a + (data[a : a + 1] == b" " and b > a) : b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]


def _encode(v) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v.value)
        for batch in batches:
            for part in pieces(batch):
                ids, counts = encoder.encode(part.column("text").to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.record_batch([part.column("row"), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=["row", "ids"])

    return run


def encode(docs: DataFrame, v: Vocabulary, keep: list[str | Column]) -> DataFrame:
    """The columns named in keep, and the ids of the text of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), text_of().alias("text"))
    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType()))
    shared = docs.sparkSession.sparkContext.broadcast(v)
    return rows.mapInArrow(_encode(shared), schema).select("row.*", "ids")


def _decode(v) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column("ids")
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.record_batch([part.column("row"), pa.array(decode_ids(ids, counts, v.value), pa.string())], names=["row", "text"])

    return run


def decode(rows: DataFrame, v: Vocabulary, keep: list[str | Column]) -> DataFrame:
    """The columns named in keep, and the text of the ids of every row."""
    own = rows.select(F.struct(*keep).alias("row"), "ids")
    schema = own.select("row").schema.add("text", T.StringType())
    shared = rows.sparkSession.sparkContext.broadcast(v)
    return own.mapInArrow(_decode(shared), schema).select("row.*", "text")
