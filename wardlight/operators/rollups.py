"""Counts kept by minute, hour and day, from which look-backs of any length are put together.

A look-back takes the whole days that lie in it, the hours around these, the minutes around the
hours, and only the two ragged ends, less than a minute each, from the rows themselves. What a
look-back of a week reads does not grow with the events of the week.

Roll-ups are stored by batch, so rows that come late add to their buckets like any others and a
batch that is run again replaces what it wrote. ``fold`` adds the batches up to one; readers go on
with the batches until the sum is whole. Rows without a time are in no look-back.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.events import DAY
from wardlight.sources import files

SECONDS = {"minute": 60, "hour": 3600, "day": 86400}
TIER, BUCKET, COUNT = "tier", "bucket", "event_count"
Moment = datetime.datetime
Piece = tuple[Moment, Moment]  # from the first to before the second
_EPOCH = Moment(1970, 1, 1)
_TICK = datetime.timedelta(microseconds=1)


@dataclass(frozen=True)
class Rollup:
    """What is kept: groups, and columns of which sums (exact numbers only), least and greatest values are kept."""

    ts: str
    keys: tuple[str, ...] = ()
    sums: Mapping[str, str] = field(default_factory=dict)  # column: type of its sum
    least: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()

    @property
    def figures(self) -> list[str]:
        return [COUNT, *[f"sum_{c}" for c in self.sums], *[f"min_{c}" for c in self.least], *[f"max_{c}" for c in self.greatest]]

    def _of_rows(self) -> list[Column]:
        return [F.count(F.lit(1)).alias(COUNT), *[F.sum(F.col(c).cast(kind)).cast(kind).alias(f"sum_{c}") for c, kind in self.sums.items()],
                *[F.min(c).alias(f"min_{c}") for c in self.least], *[F.max(c).alias(f"max_{c}") for c in self.greatest]]

    def _of_parts(self) -> list[Column]:
        return [F.sum(COUNT).alias(COUNT), *[F.sum(f"sum_{c}").cast(kind).alias(f"sum_{c}") for c, kind in self.sums.items()],
                *[F.min(f"min_{c}").alias(f"min_{c}") for c in self.least], *[F.max(f"max_{c}").alias(f"max_{c}") for c in self.greatest]]

    def of(self, rows: DataFrame) -> DataFrame:
        """Figures by minute."""
        bucket = F.date_trunc("minute", self.ts).alias(BUCKET)
        return rows.filter(F.col(self.ts).isNotNull()).groupBy(bucket, *self.keys).agg(*self._of_rows())

    def coarser(self, parts: DataFrame, tier: str) -> DataFrame:
        return parts.groupBy(F.date_trunc(tier, BUCKET).alias(BUCKET), *self.keys).agg(*self._of_parts())

    def summed(self, parts: DataFrame, by: Sequence[str]) -> DataFrame:
        return parts.groupBy(*by).agg(*self._of_parts())


# --- storing -----------------------------------------------------------------------------------

def _save(minutes: DataFrame, rollup: Rollup, path: str) -> None:
    """All tiers, each from the finer one as it was written; the mark of a whole folder comes last."""
    spark, finer = minutes.sparkSession, minutes
    for tier in SECONDS:
        rows = finer if tier == "minute" else rollup.coarser(finer, tier)
        files.save_table(rows.withColumn(DAY, F.to_date(BUCKET)), f"{path}/{TIER}={tier}", partition_by=[DAY])
        finer = files.read_table(spark, f"{path}/{TIER}={tier}", rows.withColumn(DAY, F.to_date(BUCKET)).schema).drop(DAY)
    spark.range(0).write.mode("overwrite").parquet(f"{path}/_whole")


def _whole(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders of a kind that were written to their end."""
    return sorted(int(p.split(f"/part={kind}-")[-1].split("/")[0]) for p in files.matching(spark, f"{path}/part={kind}-*/_whole/_SUCCESS"))


def add_batch(rows: DataFrame, rollup: Rollup, path: str, batch_id: int) -> None:
    """Take a batch of rows into the roll-ups; a batch counts once however often it is run."""
    _save(rollup.of(rows), rollup, f"{path}/part=batch-{batch_id}")


def _counted(spark: SparkSession, path: str) -> list[str]:
    """The folders that count: the last sum, and the batches after it."""
    sums = _whole(spark, path, "through")
    upto = sums[-1] if sums else -1
    return [f"{path}/part=through-{n}" for n in sums[-1:]] + [f"{path}/part=batch-{n}" for n in _whole(spark, path, "batch") if n > upto]


def _tier(spark: SparkSession, path: str, rollup: Rollup, tier: str) -> DataFrame | None:
    parts = [f"{p}/{TIER}={tier}" for p in _counted(spark, path)]
    parts = [p for p in parts if files.matching(spark, f"{p}/{DAY}=*")]  # a batch may bring no rows
    return spark.read.option("basePath", path).parquet(*parts).select(DAY, BUCKET, *rollup.keys, *rollup.figures) if parts else None


def fold(spark: SparkSession, path: str, rollup: Rollup) -> int:
    """Add all batches up to one folder, then delete those that count no more. Gives how many folders went."""
    batches, minutes = _whole(spark, path, "batch"), _tier(spark, path, rollup, "minute")
    done = _whole(spark, path, "through")
    if minutes is not None and batches and (not done or batches[-1] > done[-1]):
        _save(rollup.summed(minutes, [BUCKET, *rollup.keys]), rollup, f"{path}/part=through-{batches[-1]}")
    kept = set(_counted(spark, path))
    old = [p for kind in ("batch", "through") for n in _whole(spark, path, kind) if (p := f"{path}/part={kind}-{n}") not in kept]
    for folder in old:
        files.delete_folder(spark, folder)
    return len(old)


# --- look-backs ----------------------------------------------------------------------------------

def _floor(t: Moment, size: int) -> Moment:
    return t - (t - _EPOCH) % datetime.timedelta(seconds=size)


def _ceil(t: Moment, size: int) -> Moment:
    return _floor(t + datetime.timedelta(seconds=size) - _TICK, size)


def cover(start: Moment, end: Moment) -> dict[str, list[Piece]]:
    """Buckets of each tier, and pieces of ``rows``, that make up all moments after ``start`` up to ``end``."""
    low, high = start + _TICK, end + _TICK
    out: dict[str, list[Piece]] = {}
    inner: Piece | None = None
    for tier in ("day", "hour", "minute"):
        a, b = _ceil(low, SECONDS[tier]), _floor(high, SECONDS[tier])
        whole = (a, b) if a < b else None
        out[tier] = _around(whole, inner)
        inner = whole or inner
    out["rows"] = _around((low, high), inner)
    return out


def _around(whole: Piece | None, inner: Piece | None) -> list[Piece]:
    """What of a piece lies outside the inner one."""
    if whole is None:
        return []
    if inner is None:
        return [whole]
    return [p for p in ((whole[0], inner[0]), (inner[1], whole[1])) if p[0] < p[1]]


def _at(t: Moment) -> Column:
    return F.lit(t.isoformat(" ")).cast("timestamp")


def _within(time: str, pieces: Iterable[Piece]) -> Column:
    """Of the time, and of the day, by which the folders are chosen."""
    one = [F.col(DAY).between(F.lit(a.date()), F.lit((b - _TICK).date())) & (F.col(time) >= _at(a)) & (F.col(time) < _at(b)) for a, b in pieces]
    return reduce(lambda x, y: x | y, one, F.lit(False))


def lookbacks(spark: SparkSession, path: str, rollup: Rollup, rows: DataFrame, as_of: str, spans: Mapping[str, datetime.timedelta]) -> DataFrame:
    """The figures of every span before ``as_of``: one scan of each tier, and of the minutes at the ends of spans.

    ``rows`` are the events, with their day. Without keys a span that holds nothing has the count 0.
    """
    end = Moment.fromisoformat(as_of)
    covers = {name: cover(end - span, end) for name, span in spans.items()}

    def marked(df: DataFrame, tier: str, time: str) -> DataFrame:
        used = {name: c[tier] for name, c in covers.items() if c[tier]}
        inside = F.array_compact(F.array(*[F.when(_within(time, pieces), F.lit(name)) for name, pieces in used.items()]))
        return df.filter(_within(time, sorted({p for pieces in used.values() for p in pieces}))).withColumn("span", F.explode(inside))

    parts = []
    ends = marked(rows, "rows", rollup.ts)
    parts.append(ends.groupBy("span", *rollup.keys).agg(*rollup._of_rows()))
    for tier in SECONDS:
        stored = _tier(spark, path, rollup, tier) if any(c[tier] for c in covers.values()) else None
        if stored is not None:
            parts.append(rollup.summed(marked(stored, tier, BUCKET), ["span", *rollup.keys]))
    if not rollup.keys:
        empty = spark.createDataFrame([(name,) for name in spans], "span string").withColumns(
            {c: F.lit(0 if c == COUNT else None).cast(parts[0].schema[c].dataType) for c in rollup.figures})
        parts.append(empty)
    return rollup.summed(reduce(lambda a, b: a.unionByName(b), parts), ["span", *rollup.keys])
