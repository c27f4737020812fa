"""Rows laid along a space-filling curve, so that a filter on any one of several columns skips files.

Each column is cut into cells of about equally many rows; the bits of the cell numbers are
interleaved (Morton order) and rows lie in the order of the result. Sorting by one column alone
would help filters on that column only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5  # cells of a column: 2 ** BITS
ORDER = "_z"
_PIECE = "_piece"
PIECES = 2  # bits of the curve: within a partition rows are dealt to tasks by a quarter of it

Axis = tuple[Column, Sequence[int | float]]  # a number, and where its cells begin


def edges_of(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Where the cells of numeric columns begin: quantiles within one part in 10,000, from one mergeable aggregate.

    At most 2 ** bits - 1 numbers a column come to the driver. A value with more rows than a
    cell holds takes several quantiles; they are one edge.
    """
    cells = 1 << bits
    steps = [i / cells for i in range(1, cells)]
    row = df.agg(*[F.percentile_approx(c, steps, F.lit(10000)).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def cell_of(value: Column, edges: Sequence[int | float]) -> Column:
    """How many edges are not above the value, by a balanced tree of comparisons; NULL lies in cell 0."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= edges[middle], place(middle + 1, high)).otherwise(place(low, middle))

    return place(0, len(edges)).cast("long")


def morton(cells: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the cell numbers, taken in turns; the first column has the higher ones."""
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for cell in cells:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("long")))
    return out


def save_clustered_by(df: DataFrame, path: str, axes: Sequence[Axis], partition_by: Sequence[str] = (), bits: int = BITS) -> None:
    """Write rows along the curve through the axes, within the partitions if there are any.

    One shuffle, and no pass before it: rows of a quarter of the curve of a partition meet in a
    task, adaptive execution puts small ones together and splits big ones, and each file is sorted
    along the curve, so files and row groups of big tables and row groups of small ones span few
    cells. Dealt by cell, each task would hold cells of all partitions and write a small file of each.
    """
    if any(len(edges) >= 1 << bits for _, edges in axes):
        raise ValueError("more edges than cells")
    placed = df.withColumn(ORDER, morton([cell_of(value, edges) for value, edges in axes], bits))
    if partition_by:
        placed = placed.withColumn(_PIECE, F.shiftright(ORDER, max(bits * len(axes) - PIECES, 0)))
    dealt = placed.hint("rebalance", *partition_by, _PIECE if partition_by else ORDER)
    ordered = dealt.sortWithinPartitions(*partition_by, ORDER, *[value for value, _ in axes]).drop(ORDER, _PIECE)
    writer = ordered.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
