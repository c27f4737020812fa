"""Small helpers shared by the operators: reading tables, hold-out, keeping rows, Arrow pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A map task looks at so many bytes of text at once; longer texts go alone.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents no model may learn from; a null id hashes like an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators need, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))


def text_key(column: str = "text") -> Column:
    return F.xxhash64(text_of(column))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct `row`: helper columns beside it can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def keep_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of docs named in chosen(doc_id, text_key), each once, with all columns of docs.

    Texts move once, by id and text; repeated rows meet there and leave as one row.
    """
    low = F.lit(-(2**63))
    keyed = docs.select(whole_row(docs), F.coalesce(F.col("doc_id").cast("bigint"), low).alias("id"), text_key().alias("key"))
    wanted = chosen.select(F.coalesce("doc_id", low).alias("id"), F.col("text_key").alias("key"))
    return keyed.join(wanted, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]).select("row.*")


def pieces(batch: pa.RecordBatch, texts: pa.Array | None = None, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with at most so many bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column("text") if texts is None else texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values, null as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def char_starts(data: np.ndarray) -> np.ndarray:
    """For each byte and the end: how many characters begin before it."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
