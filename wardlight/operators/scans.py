"""Running and trailing computations that hold up when one key has very many rows.

Rows are first added up per key and instant. The timeline of a key is then cut into
chunks: within a chunk a short window runs, and a second window runs over the one-row
summaries of the chunks. No task ever sorts all rows of a key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.session import cut_lineage

DAY = 86400


@dataclass(frozen=True)
class Trailing:
    """Sum of ``value`` over the last ``seconds`` up to and including the row's instant."""

    name: str
    value: Column
    seconds: int


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on columns of one name in which NULL meets NULL: rows without a key stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def trailing(df: DataFrame, keys: list[str], epoch: str, measures: list[Trailing], chunk: int = DAY) -> DataFrame:
    """Trailing sums per key and instant; rows of the same instant count for each other.

    An amount that enters at t leaves at t + seconds + 1, so the trailing sum is the
    running sum of entries and leavings. Exact for integers and decimals.
    Result: one row per key and instant with a column per measure.
    """
    points = df.groupBy(*keys, F.col(epoch).alias("_t")).agg(*[F.sum(m.value).alias(m.name) for m in measures])
    zero = {m.name: F.coalesce(F.col(m.name), F.lit(0)) for m in measures}
    points = points.withColumns(zero)
    nothing = {m.name: F.lit(0).cast(points.schema[m.name].dataType) for m in measures}
    moves = points.withColumn("_real", F.lit(1))
    for span in sorted({m.seconds for m in measures}):
        leaving = points.select(*keys, (F.col("_t") + span + 1).alias("_t"),
                                *[(-F.col(m.name) if m.seconds == span else nothing[m.name]).alias(m.name) for m in measures],
                                F.lit(0).alias("_real"))
        moves = moves.unionByName(leaving)
    group = [*keys, "_chunk"]
    moves = moves.withColumn("_chunk", F.floor(F.col("_t") / chunk)).repartition(*[F.col(c) for c in group])
    steps = moves.groupBy(*group, "_t").agg(*[F.sum(m.name).alias(m.name) for m in measures], F.max("_real").alias("_real"))
    inside = Window.partitionBy(*group).orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = steps.withColumns({m.name: F.sum(m.name).over(inside) for m in measures}).filter(F.col("_real") == 1)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = moves.groupBy(*group).agg(*[F.sum(m.name).alias(f"_sum_{m.name}") for m in measures])
    carried = totals.select(*group, *[F.coalesce(F.sum(f"_sum_{m.name}").over(earlier), F.lit(0)).alias(f"_carry_{m.name}") for m in measures])
    joined = null_safe_join(running, carried, group)
    return joined.select(*keys, F.col("_t").alias(epoch), *[(F.col(m.name) + F.col(f"_carry_{m.name}")).alias(m.name) for m in measures])


def with_trailing(df: DataFrame, keys: list[str], epoch: str, measures: list[Trailing], chunk: int = DAY) -> DataFrame:
    """The rows with their trailing sums."""
    return null_safe_join(df, trailing(df, keys, epoch, measures, chunk), [*keys, epoch])


def previous_instant(df: DataFrame, keys: list[str], ts: str, chunk: int = DAY) -> DataFrame:
    """Per key and instant: rows at that instant (``n``) and the instant before (``prev``)."""
    points = df.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n"))
    points = points.withColumn("_chunk", F.floor(F.unix_timestamp(ts) / chunk))
    group = [*keys, "_chunk"]
    last = points.groupBy(*group).agg(F.max(ts).alias("_last"))
    before = last.select(*group, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_before"))
    inside = points.withColumn("prev", F.lag(ts).over(Window.partitionBy(*group).orderBy(ts)))
    return null_safe_join(inside, before, group).select(*keys, ts, "n", F.coalesce("prev", "_before").alias("prev"))


def running_by_value(df: DataFrame, order: str, sums: list[str]) -> DataFrame:
    """Running totals over all rows in the order of a column with unique values.

    Rows are range-partitioned by the column; totals of earlier partitions are added to
    the running totals within each.
    """
    placed = cut_lineage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    carried = totals.select("_part", *[F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_c_{c}") for c in sums])
    local = placed.withColumns({f"run_{c}": F.sum(c).over(inside) for c in sums})
    joined = local.join(F.broadcast(carried), "_part")
    return joined.select(order, *sums, *[(F.col(f"run_{c}") + F.col(f"_c_{c}")).alias(f"run_{c}") for c in sums])
