"""Ranked lexical search, by a hybrid of term-at-a-time and document-at-a-time evaluation.

The items to search for are taken in blocks of `BLOCK_BYTES` of text. For a block the documents
are read once and their occurrences of its terms are written as an index; document frequencies
and lengths are added up from that index, and every task searches its own documents in blocks
for all items. In a block of documents the posting lists of an item are used in two ways. The
short ones are added up term at a time into accumulators, and the sorted accumulators are then
one more list with its own upper bound. Document at a time, the lists in order of their bounds
are split where the sum of bounds falls below the score of the last place: documents are taken
from the lists beyond that point only, and looked up in the others, with a skip to the wanted
document, as long as they can still enter. Bounds are exact and places are kept from block to
block, so nothing that belongs to the best is lost. The best of all tasks are ranked at the end.

Terms are told apart by 64-bit hashes. All scores are integers but for the logarithm of a weight.

Defined cases: a null or empty text has no terms; an item without terms gives no rows; items are
told apart by id and text, equal rows are one item; every row of docs is a document of its own,
also repeated ones; of equal scores the smaller doc_id comes first and null ids last; empty
tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm import words
from wardlight.llm.common import byte_view, id_and_text, pieces, text_of
from wardlight.session import shared_dir

TOP = 20
BLOCK_BYTES = 8 << 20
#: Documents and postings of a block, documents scored before the last place is looked up again.
DOCUMENTS, POSTINGS, STRIDE = 16_384, 1 << 21, 1_024
#: Lists are short as long as all of them hold fewer postings than this part of the documents.
SHORT = 4
TENTHS_OF_K1, SLOPE = 12, 25
U = np.uint64


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and where each text's terms begin."""
    data, offsets = byte_view(texts)
    data = words.LOWER[data]
    starts, ends, firsts = words.spans(data, offsets, "alnum")
    return words.hashes(data, starts, ends), firsts


class Query:
    """A block of items: the hashes of their terms, and each item's terms with their repeats."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in rows]
        h, firsts = term_hashes(pa.array([t for _, t in rows], pa.string()))
        keys, where = np.unique(h, return_inverse=True)
        self.terms = len(keys)
        self.lookup = words.Lookup(keys, np.arange(len(keys), dtype=np.int64))
        self.items = [np.unique(where[a:b], return_counts=True) for a, b in zip(firsts, firsts[1:], strict=False)]


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Query]:
    """The items in blocks of bounded size, one after another."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = math.ceil(total / block_bytes)
    for b in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield Query([tuple(r) for r in own])


def _postings(query) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of every document its length and its terms of the query with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = query.value
        for batch in batches:
            for part in pieces(batch):
                h, firsts = term_hashes(part.column("text"))
                at, term = q.lookup.find(h)
                doc = np.searchsorted(firsts, at, "right") - 1
                pair, tf = np.unique(doc * q.terms + term, return_counts=True)
                doc, term = (pair // q.terms, pair % q.terms) if q.terms else (pair, pair)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (term, tf)]
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(firsts).astype(np.int64)), *lists], names=["doc_id", "n", "terms", "counts"])

    return run


def _values(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and how many each row has."""
    return lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy().astype(np.int64))


def _totals(terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents that hold each term; under -1 documents with terms, under -2 their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, documents, length = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            documents += int((n > 0).sum())
            length += int(n.sum())
            df += np.bincount(_values(batch.column("terms"))[0], minlength=terms)
        held = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.concatenate([held, [-1, -2]])), pa.array(np.concatenate([df[held], [documents, length]]))], names=["term", "total"])

    return run


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The length norm of each document; in whole numbers of any size where 64 bits may not do."""
    if len(n) and SLOPE * int(n.max()) * documents >= 1 << 63:
        return np.array([100 - SLOPE + SLOPE * x * documents // length for x in n.tolist()], np.int64)
    return 100 - SLOPE + SLOPE * n * documents // length


class Places:
    """The best documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1  # a score below `least` does not enter
        self.score, self.ids, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        score, ids, no_id = np.concatenate([self.score, score]), np.concatenate([self.ids, ids]), np.concatenate([self.no_id, no_id])
        order = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.ids, self.no_id = score[order], ids[order], no_id[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: one list with the sums of several."""
    docs, gain = (np.concatenate(x) for x in zip(*lists, strict=True))
    order = np.argsort(docs, kind="stable")
    docs, gain = docs[order], gain[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(gain, first)


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, places: Places, ids: np.ndarray, no_id: np.ndarray, stride: int = STRIDE) -> None:
    """Enters the documents of a block; lists hold sorted documents and what each gains."""
    lists = sorted(lists, key=lambda x: len(x[0]))
    size, short = 0, 0
    while short < len(lists) and size + len(lists[short][0]) <= documents // SHORT:
        size += len(lists[short][0])
        short += 1
    if short > 1:
        lists = [summed(lists[:short]), *lists[short:]]
    lists.sort(key=lambda x: x[1].max())
    bounds = np.cumsum([x[1].max() for x in lists])
    for low in range(0, documents, stride):
        lead = int(np.searchsorted(bounds, places.least, "left"))  # lists before it can't bring in a document
        if lead == len(lists):
            return
        sums = np.zeros(stride, np.int64)
        for docs, gain in lists[lead:]:
            a, b = np.searchsorted(docs, [low, low + stride])
            sums[docs[a:b] - low] += gain[a:b]
        found = np.flatnonzero(sums)
        score = sums[found]
        for j in range(lead - 1, -1, -1):
            able = score + bounds[j] >= places.least
            found, score = found[able], score[able]
            if not len(found):
                break
            docs, gain = lists[j]
            at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
            score = score + np.where(docs[at] == found + low, gain[at], 0)
        enter = score >= places.least
        if enter.any():
            at = found[enter] + low
            places.add(score[enter], ids[at], no_id[at])


def _search(shared, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, weight, documents, length = shared.value
        places = [Places(k) for _ in query.items]
        held: list[pa.RecordBatch] = []
        rows = size = 0

        def settle() -> None:
            nonlocal rows, size
            block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            rows = size = 0
            term, per = _values(block.column("terms"))
            tf, _ = _values(block.column("counts"))
            doc = np.repeat(np.arange(block.num_rows), per)
            m = norms(block.column("n").to_numpy(), documents, length)
            gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + TENTHS_OF_K1 * m[doc]))
            order = np.argsort(term, kind="stable")  # documents of a term stay in order
            doc, gain = doc[order], gain[order]
            cut = np.searchsorted(term[order], np.arange(query.terms + 1))
            no_id = block.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = block.column("doc_id").fill_null(0).to_numpy()
            for (own, repeats), best in zip(query.items, places, strict=True):
                lists = [(doc[cut[t] : cut[t + 1]], gain[cut[t] : cut[t + 1]] * r) for t, r in zip(own.tolist(), repeats.tolist(), strict=True) if cut[t] < cut[t + 1]]
                if lists:
                    search_block(lists, block.num_rows, best, ids, no_id)

        for batch in batches:
            for low in range(0, batch.num_rows, DOCUMENTS // 4):
                part = batch.slice(low, DOCUMENTS // 4)
                held.append(part)
                rows += part.num_rows
                size += len(part.column("terms").flatten())
                if rows >= DOCUMENTS or size >= POSTINGS:
                    settle()
        if held:
            settle()
        for i, best in zip(query.ids, places, strict=True):
            if len(best.score):
                yield pa.record_batch([pa.array([i] * len(best.score), pa.int64()), pa.array(best.ids, mask=best.no_id), pa.array(best.score)], names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, all with a score if they are fewer."""
    spark = docs.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b, query in enumerate(blocks(items, block_bytes)):
        shared = spark.sparkContext.broadcast(query)
        index = id_and_text(docs).mapInArrow(_postings(shared), "doc_id bigint, n bigint, terms array<int>, counts array<int>")
        index.write.option("compression", "zstd").parquet(f"{base}/{b}")
        index = spark.read.schema(index.schema).parquet(f"{base}/{b}")
        totals = index.mapInArrow(_totals(query.terms), "term bigint, total bigint").groupBy("term").agg(F.sum("total").alias("total"))
        known = {r["term"]: r["total"] for r in totals.collect()}  # one row for each term of the block at most
        documents, length = known.pop(-1, 0), known.pop(-2, 0)
        df = np.array([known.get(t, 0) for t in range(query.terms)], np.int64)
        # Items of a block are told apart by their place, so that equal ids keep their own ranks.
        names = spark.createDataFrame([(i, j) for j, i in enumerate(query.ids)], "item_id bigint, item int")
        query.ids = list(range(len(query.ids)))
        stats = spark.sparkContext.broadcast((query, weights(df, documents), documents, max(length, 1)))
        found = index.mapInArrow(_search(stats, k), "item_id bigint, doc_id bigint, score bigint").select(F.col("item_id").cast("int").alias("item"), "doc_id", "score")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).join(F.broadcast(names), "item")
        best = best.select("item_id", "rank", "doc_id", "score")
        out = best if not b else out.unionByName(best)
    return out
