"""Distinct counts that can be put together: a theta sketch of each day, for counts over any days.

Distinct counts can't be added, so a count over a span has to shuffle all its ids again. A sketch
of a day is of a fixed size (at most 8 bytes times 2 ** LG), sketches of days unite to that of the
span, and sketches of several sets can be intersected. Up to 2 ** LG distinct values the figures
are exact; beyond, the standard error is one part in 2 ** (LG / 2) of a count, and of shared
values that part of the square root of shared times all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.operators.events import DAY

LG = 14
SKETCH = "sketch"


def by_day(df: DataFrame, ts: str, what: str, keys: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """A sketch of the values of each day and group. NULL is no value, and rows without a time lie in no day."""
    known = df.filter(F.col(ts).isNotNull() & F.col(what).isNotNull())
    return known.groupBy(F.to_date(ts).alias(DAY), *keys).agg(F.theta_sketch_agg(what, lg).alias(SKETCH))


def united(sketches: DataFrame, keys: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """The sketch of each group over all its days; choose days by a filter on the day."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg(SKETCH, lg).alias(SKETCH))


def distinct(sketches: DataFrame, keys: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """How many distinct values each group has over the given days."""
    return united(sketches, keys, lg).select(*keys, F.theta_sketch_estimate(SKETCH).alias("distinct_count"))


def shared(sketches: DataFrame, among: str, members: Sequence[str], keys: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """How many values all the named members of a column share, and how many they have together."""
    sets = united(sketches.filter(F.col(among).isin(*members)), [*keys, among], lg)
    both = sets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sets"), F.theta_intersection_agg(SKETCH).alias("_shared"), F.theta_union_agg(SKETCH, lg).alias("_all"))
    found = F.when(F.col("_sets") == len(set(members)), F.theta_sketch_estimate("_shared")).otherwise(F.lit(0))
    return both.select(*keys, found.cast("bigint").alias("shared_count"), F.theta_sketch_estimate("_all").alias("all_count"))


def allowed(count: Column, everything: Column | None = None, lg: int = LG, errors: float = 4.0) -> Column:
    """How far an estimate may be off: so many standard errors, nothing while all values fit in the sketch."""
    everything = count if everything is None else everything
    return F.when(everything <= 1 << lg, F.lit(0.0)).otherwise(errors / (1 << lg) ** 0.5 * F.sqrt(count * everything) + 1)
