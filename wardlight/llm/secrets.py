"""Secret scan: fixed patterns, and the novelty of strings in sensitive places.

Three patterns give the base spans. Beside them, strings of `LEAST_LENGTH` and more characters
that come after a sensitive word are measured: the bytes by which the string makes its
surroundings longer under zstandard, primed with a dictionary of the identifiers that are
frequent in the whole corpus. A string of which at least `LEAST_BYTES` bytes are new is reported
as `novel`, if these are `LEAST_RATIO` bytes a character or `SURPLUS` bytes more than random
characters of its own alphabet need, and it does not lie wholly in base spans. There is no
distance at which a word stops to count: both bounds rise by a byte each time the distance from
the nearest word before, in units of `NEAR` characters, doubles. A string has to change between
words, capitals and digits at least every `STRIDE` characters, as names in code do not, unless it
follows within `CLOSE` characters and holds letters and digits only.

A string is a run of printable ASCII characters without blanks and quotes, symbols included, less
the brackets and separators at its ends; of a run that assigns to a name with a sensitive word
only the value. A run with further symbols counts as a whole where it stands in quotes, is
assigned, or comes right after the word; if it doesn't, or is not novel as a whole, its pieces of
letters, digits and `+/_.=-` are measured.
Lines that consist of one string and adjoin such a string, as in a key file, are
measured together with it, and each by itself if that fails.

The dictionary holds every identifier with at least `SHARE` of all identifiers of the corpus,
at most 1 / SHARE of them: Misra-Gries summaries name candidates, a second pass counts them.

Defined cases: null and empty texts have no spans; repeated rows get equal rows; spans of a
kind never overlap, spans of different kinds may; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, id_and_text, pieces, text_key
from wardlight.llm.exact_dedup import add_counts

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters and more
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|pwd|secret|token|credential|bearer|signature|(?:api|private|access|auth|signing|encryption)[_ .-]?key", re.I | re.A)
RUN = re.compile(r"[!#-&(-_a-~]{16,}")  # printable ASCII but blanks and quotes
ASSIGNED = re.compile(f"(?:{SENSITIVE.pattern})" + r"[\w.-]{0,64}[:=]+(?=[^:=])", re.I | re.A)  # within a run: the name that its value follows
PIECE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
STRETCH = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
LEADING = re.compile(r"[\s:=>\"'`]*")
QUOTES = "\"'`"
CLOSE, STRIDE = 64, 6
OPENING, CLOSING = "([{<:=,;", ")]}>:,;"  # not part of a string that they enclose
NEAR, AROUND = 1024, 256
LEAST_LENGTH, LEAST_BYTES, LEAST_RATIO, SURPLUS = 16, 12, 0.8, 8
FOLLOWING = re.compile(r"""["',+\\\x20\t]*(?:\r\n|\n|\r)["'\x20\t]*([A-Za-z0-9+/_.=-]+)(?=["',;+\\\x20\t]*(?:[\r\n]|\Z))""", re.A)
SHARE, LEVEL = 1e-4, 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the fixed patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Novelty:
    """New bytes of a string between its surroundings."""

    def __init__(self, dictionary: bytes):
        primed = None
        if len(dictionary) >= 8:
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False) if primed else zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def bytes_of(self, text: str, start: int, end: int) -> int:
        before, after = text[max(0, start - AROUND) : start].encode("utf-8", "surrogatepass"), text[end : end + AROUND].encode("utf-8", "surrogatepass")
        return len(self.compressor.compress(before + text[start:end].encode() + after)) - len(self.compressor.compress(before + after))


def is_novel(text: str, start: int, end: int, novelty: Novelty, distance: int = 0) -> bool:
    size, new = end - start, novelty.bytes_of(text, start, end) - math.log2(1 + distance / NEAR)
    bound = size * math.log2(len(set(text[start:end]))) / 8 + SURPLUS
    return new >= LEAST_BYTES and new >= min(LEAST_RATIO * size, bound)


def _changes(string: str) -> bool:
    """Does it change between words, capitals and digits as random strings do? Symbols don't count."""
    plain = "".join(c for c in string if c.isalnum())
    return len(STRETCH.findall(plain)) * STRIDE >= max(len(plain), 3 * STRIDE)


def _inner(text: str, start: int, end: int) -> tuple[int, int]:
    """A run less what encloses it."""
    while start < end and text[start] in OPENING:
        start += 1
    while start < end and text[end - 1] in CLOSING:
        end -= 1
    return start, end


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Novel strings in order: every run after the first sensitive word is looked at once."""
    sensitive = [m.end() for m in SENSITIVE.finditer(text)]
    if not sensitive:
        return []
    covered: list[tuple[int, int]] = []  # the base spans put together
    for s, _, e in base:
        if covered and s <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(e, covered[-1][1]))
        else:
            covered.append((s, e))

    def nearest(start: int) -> int:
        return sensitive[bisect_right(sensitive, start) - 1]

    def measured(start: int, end: int, symbols: bool = False) -> bool:
        at = bisect_right(covered, (start, len(text)))
        distance = start - nearest(start)
        if end - start < LEAST_LENGTH or (at > 0 and end <= covered[at - 1][1]):
            return False
        named = not symbols and distance <= CLOSE and text[start:end].isalnum()
        return (named or _changes(text[start:end])) and is_novel(text, start, end, novelty, distance)

    def stands_alone(run: re.Match, start: int) -> bool:
        """A run in quotes, one that is assigned, or one right after the sensitive word."""
        quoted = text[run.start() - 1] in QUOTES and text[run.end() : run.end() + 1] in QUOTES
        assigned = start > run.start() and text[start - 1] in ":="
        near = max(nearest(start), start - CLOSE)
        return quoted or assigned or text[max(0, run.start() - CLOSE) : run.start()].rstrip()[-1:] in (":", "=") or LEADING.fullmatch(text, near, start) is not None

    found, at = [], sensitive[0]
    while run := RUN.search(text, at):
        at = run.end()
        start, end = _inner(text, max([run.start(), *(m.end() for m in ASSIGNED.finditer(text, *run.span()))]), run.end())
        whole = PIECE.fullmatch(text, start, end) is not None
        lines = [(start, end)]
        if whole:
            while lines[-1][1] - lines[-1][0] >= LEAST_LENGTH and (following := FOLLOWING.match(text, lines[-1][1])):
                lines.append(following.span(1))
            at = max(at, lines[-1][1])
        if len(lines) > 1 and measured(start, lines[-1][1]):
            found.append((start, 3, lines[-1][1]))
            continue
        if whole:
            alone = [(s, 3, e) for s, e in lines if measured(s, e)]
        elif stands_alone(run, start) and measured(start, end, symbols=True):
            alone = [(start, 3, end)]
        else:
            alone = [(m.start(), 3, m.end()) for m in PIECE.finditer(text, start, end) if measured(*m.span())]
        found += alone
    return found


def _identifiers(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, offsets = byte_view(column)
    starts, ends, _ = words.spans(data, offsets, "alnum")
    long = ends - starts >= 3
    starts, ends = starts[long], ends[long]
    return data, starts, ends, words.hashes(data, starts, ends)


def _candidates(share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = int(2 / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        spelled: dict[int, bytes] = {}
        total = 0
        for batch in batches:
            for part in pieces(batch):
                data, starts, ends, h = _identifiers(part.column("text"))
                keys, first, n = np.unique(h, return_index=True, return_counts=True)
                total += len(h)
                more = dict(zip(keys.tolist(), n.tolist(), strict=True))
                counts = add_counts(counts, more, k)
                for key, i in zip(keys.tolist(), first.tolist(), strict=True):
                    if key in counts and key not in spelled:
                        spelled[key] = data[starts[i] : ends[i]].tobytes()
                spelled = {key: spelled[key] for key in counts}
        kept = {key: n for key, n in counts.items() if n > share * total / 4}
        yield pa.record_batch([pa.array([None, *(spelled[x].decode("utf-8", "replace") for x in kept)], pa.string()), pa.array([total, *kept.values()], pa.int64())], names=["word", "n"])

    return run


def _exact(words_: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, offsets = byte_view(pa.array(words_, pa.string()))
        lookup = words.Lookup(words.hashes(data, offsets[:-1], offsets[1:]), np.arange(len(words_)))
        counts = np.zeros(len(words_), np.int64)
        for batch in batches:
            for part in pieces(batch):
                _, found = lookup.find(_identifiers(part.column("text"))[-1])
                counts += np.bincount(found, minlength=len(words_))
        yield pa.record_batch([pa.array(words_, pa.string()), pa.array(counts)], names=["word", "n"])

    return run


def dictionary(docs: DataFrame, share: float = SHARE) -> bytes:
    """The frequent identifiers of all texts, rarest first, whatever the partitions are.

    The summaries fall short by less than 3/4 of `share`, so every identifier with that share
    is a candidate; at most 4 / share candidates and 1 / share identifiers come to the driver.
    """
    texts = id_and_text(docs).select("text")
    sums = texts.mapInArrow(_candidates(share), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).persist()
    total = (sums.filter("word IS NULL").first() or {"n": 0})["n"]
    named = [r["word"] for r in sums.filter(F.col("word").isNotNull() & (F.col("n") >= share * total / 4)).select("word").collect()]
    sums.unpersist()
    exact = texts.mapInArrow(_exact(sorted(named)), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    frequent = sorted((r["n"], r["word"]) for r in exact.filter(F.col("n") >= share * total).collect()) if named else []
    return " ".join(word for _, word in frequent).encode()


def _scan(dictionary_: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary_)
        for batch in batches:
            for part in pieces(batch):
                out = []
                for text in part.column("text").to_pylist():
                    base = base_spans(text)
                    out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + novel_spans(text, base, novelty))])
                yield pa.record_batch([part.column("doc_id"), part.column("text_key"), pa.array(out, _SPANS)], names=["doc_id", "text_key", "spans"])

    return run


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame, dictionary_: bytes) -> DataFrame:
    """doc_id, text_key and all spans (kind, start, end in code points) of every row."""
    schema = "doc_id bigint, text_key bigint, spans array<struct<kind:string,start:int,end:int>>"
    return id_and_text(docs).withColumn("text_key", text_key()).mapInArrow(_scan(dictionary_), schema)
