"""Dense surrogate keys in business-key order, without pulling the rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def _numbered(names: DataFrame, sk: str, bk: str, start: Column | int) -> DataFrame:
    """Each business key once, as ``_bk``, with its number."""
    names = names.select(F.col(bk).alias("_bk"))
    placed = cut_lineage(names.repartitionByRange("_bk").dropDuplicates(["_bk"]).sortWithinPartitions("_bk")
                         .withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumns({"_part": F.shiftright("_place", _ROW_BITS),
                                 "_row": F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    first = F.lit(start) if isinstance(start, int) else start
    return placed.join(F.broadcast(offsets), "_part").select("_bk", (first + F.col("_offset") + F.col("_row") + 1).cast("bigint").alias(sk))


def full_keys(df: DataFrame, sk: str, bk: str, start: Column | int = 0, ids: DataFrame | None = None) -> DataFrame:
    """Number the business keys start+1, start+2, ... in their order; rows of one key share its number.

    Only the keys are range-partitioned, sorted and checkpointed, so that their places stay as
    they are; the rows join their number. How many partitions there are is left to adaptive
    execution, which sizes them. The number is the place plus the size of all earlier
    partitions; that table of sizes has one row per partition. ``ids`` may name a table that
    holds exactly the keys of ``df`` and is cheaper to read.
    """
    numbered = _numbered(df if ids is None else ids, sk, bk, start)
    return df.join(numbered, F.col(bk).eqNullSafe(F.col("_bk"))).drop("_bk")


def existing_keys(existing: DataFrame, sk: str, bk: str) -> DataFrame:
    """One key per business key: of the current rows, the lowest if there are several."""
    if "is_current" in existing.columns:
        existing = existing.filter(F.col("is_current") == 1)
    return existing.groupBy(bk).agg(F.min(sk).alias(sk))


def max_key(existing: DataFrame, sk: str) -> Column:
    """Highest key in use, 0 for an empty table, as a scalar subquery."""
    return existing.select(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()


def assign_keys(src: DataFrame, existing: DataFrame, sk: str, bk: str, ids: DataFrame | None = None) -> DataFrame:
    """Known business keys keep their key; new ones follow the highest key in use. NULL is a key like any other.

    Known and new keys are found among the business keys alone, and the rows join theirs once.
    ``ids`` may name a table that holds exactly the keys of ``src`` and is cheaper to read.
    """
    names = (src if ids is None else ids).select(F.col(bk).alias("_bk"))
    wanted = existing.join(names, F.col(bk).eqNullSafe(F.col("_bk")), "left_semi")
    known = existing_keys(wanted, sk, bk).withColumnRenamed(bk, "_bk")
    unknown = names.join(known.select(F.col("_bk").alias("_known")), F.col("_bk").eqNullSafe(F.col("_known")), "left_anti")
    fresh = _numbered(unknown, sk, "_bk", max_key(existing, sk))
    return src.join(known.unionByName(fresh), F.col(bk).eqNullSafe(F.col("_bk"))).drop("_bk")
