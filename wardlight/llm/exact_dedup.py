"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of the text digests, one per partition and added up, name every digest
that holds more than `share` of the rows. Their winners are counted exactly and broadcast, so
copies of a frequent text are decided where they are read. All other digests are shuffled.

Defined cases: a null text counts as empty; the row with the largest doc_id stays, null ids
lose; of repeated rows (same id and text) exactly one stays; an empty table gives no rows;
other columns are not looked at, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import text_key, text_of, whole_row
from wardlight.session import cut_lineage

SHARE = 0.001


def digests(docs: DataFrame, normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """doc_id, the SHA-256 of the normalised text, and a key of the text itself."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(normalise(text_of()), 256)).alias("digest"), text_key().alias("text_key"))


def add_counts(counts: dict[bytes, int], more: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Adds to a Misra-Gries summary and shrinks it to k counters.

    What is subtracted from one counter is subtracted from more than k, so no count falls short
    by more than 1 / (k + 1) of the rows seen.
    """
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) <= k:
        return counts
    cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -k - 1)[-k - 1])
    return {key: n - cut for key, n in counts.items() if n > cut}


def _summaries(share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = int(2 / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            found = batch.column(0).value_counts()
            counts = add_counts(counts, dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)), k)
        # Counts up to share / 4 of the partition are left out: they add as much to the error.
        counts = {key: n for key, n in counts.items() if n > share * rows / 4}
        yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "n"])

    return run


def heavy_winners(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """digest, winner, size of every digest with at least `share` of the rows, and of some with less.

    A summary falls short by at most share / 2 + share / 4 of the rows, so the sum of a frequent
    digest is at least share / 4. Sums add up to the rows at most: never more than 4 / share digests.
    """
    total = rows.count()
    candidates = rows.select("digest").mapInArrow(_summaries(share), "digest binary, n bigint").groupBy("digest").agg(F.sum("n").alias("n")).filter(F.col("n") >= share * total / 4).select("digest")
    verified = rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("size"))
    return verified.filter("size > 1")


def exact_groups(docs: DataFrame, normalise: Callable[[Column], Column] = lambda c: c, share: float = SHARE) -> DataFrame:
    """One row per row of docs: doc_id, digest, text_key, keep_id, group_size, kept."""
    rows = cut_lineage(digests(docs, normalise))
    marked = rows.join(F.broadcast(heavy_winners(rows, share)), "digest", "left")
    lost = F.col("size").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("winner"))
    columns = ["doc_id", "digest", "text_key", "keep_id", "group_size", "kept"]
    removed = marked.filter(lost).select("doc_id", "digest", "text_key", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), F.lit(False).alias("kept"))
    group = Window.partitionBy("digest")
    ordinary = (
        marked.filter(~lost)
        .withColumn("keep_id", F.max("doc_id").over(group))
        .withColumn("group_size", F.coalesce("size", F.count("*").over(group)))
        .withColumn("kept", F.row_number().over(group.orderBy(F.col("doc_id").desc_nulls_last(), "text_key")) == 1)
    )
    return removed.select(*columns).unionByName(ordinary.select(*columns))


def drop_exact(docs: DataFrame, normalise: Callable[[Column], Column] = lambda c: c, share: float = SHARE) -> DataFrame:
    """The rows of docs that stay. Copies of frequent texts go before the one shuffle of texts."""
    rows = cut_lineage(digests(docs, normalise))
    keyed = docs.select(whole_row(docs), F.col("doc_id").cast("bigint").alias("id"), F.unhex(F.sha2(normalise(text_of()), 256)).alias("digest"))
    rest = keyed.join(F.broadcast(heavy_winners(rows, share)), "digest", "left").filter(F.col("size").isNull() | F.col("id").eqNullSafe(F.col("winner")))
    first = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    return rest.withColumn("place", F.row_number().over(first)).filter("place = 1").select("row.*")
