"""Distribution shift between a base and a current sample of one numeric column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.scans import running_by_value

EMPTY_SHARE = 1e-6


def _counted(base: DataFrame, cur: DataFrame, value: Column) -> DataFrame:
    """Rows of each sample per distinct value."""
    both = base.select(value.alias("v"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionByName(
        cur.select(value.alias("v"), F.lit(0).alias("b"), F.lit(1).alias("c")))
    return both.filter(F.col("v").isNotNull()).groupBy("v").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))


def _total(counts: DataFrame, col: str) -> Column:
    return counts.select(F.sum(col)).scalar()


def psi(base: DataFrame, cur: DataFrame, col: str, bins: list[float]) -> DataFrame:
    """Population stability index over the bins cut at the given edges.

    Shares of empty bins count as one in a million. One row: psi and the bin count.
    """
    bucket = sum((F.when(F.col(col) >= edge, 1).otherwise(0) for edge in bins), F.lit(0)).cast("int")
    counts = _counted(base, cur, F.when(F.col(col).isNotNull(), bucket))
    p = F.greatest(s.ratio(F.col("b"), _total(counts, "b")), F.lit(EMPTY_SHARE))
    q = F.greatest(s.ratio(F.col("c"), _total(counts, "c")), F.lit(EMPTY_SHARE))
    shares = counts.select(p.alias("p"), q.alias("q"))
    return shares.agg(s.rounded(F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))), 6).alias("psi"),
                      F.count(F.lit(1)).alias("bins_used"))


def ks(base: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """Largest distance between the two cumulative distributions."""
    counts = running_by_value(_counted(base, cur, F.col(col)), "v", ["b", "c"])
    base_rows, current_rows = _total(counts, "b"), _total(counts, "c")
    gap = F.abs(s.ratio(F.col("run_b"), base_rows) - s.ratio(F.col("run_c"), current_rows))
    gaps = counts.select(gap.alias("gap"), "b", "c")
    return gaps.agg(s.rounded(F.max("gap"), 6).alias("ks"), F.sum("b").alias("base_rows"), F.sum("c").alias("current_rows"))
