"""Time windows, look-backs, freshness and lag over event tables.

All functions hold for batch input; those marked so in ``streaming.jobs`` hold for
streams as well. The moment of evaluation is an argument, never the clock.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import reference_data as ref
from wardlight.functions import scalars as s
from wardlight.operators.aggregates import quantile
from wardlight.operators.latest import dedup_latest

TS, DAY = "event_timestamp", "_day"  # event tables lie by the day of their time


def moment(as_of: str | Column) -> Column:
    return F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of


def lookback(df: DataFrame, ts: str, as_of: str | Column, interval: str, inclusive: bool = False) -> DataFrame:
    """Rows after ``as_of - interval`` (from it on, if inclusive) and not after ``as_of``; other days are not read."""
    start = moment(as_of) - s.spark_interval(interval)
    if ts == TS and DAY in df.columns:
        df = df.filter(F.col(DAY).between(F.to_date(start), F.to_date(moment(as_of))))
    lower = F.col(ts) >= start if inclusive else F.col(ts) > start
    return df.filter(lower & (F.col(ts) <= moment(as_of)))


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str] | None = None, aggs: list[Column] | None = None, slide: str | None = None) -> DataFrame:
    """Aggregates per window and key; ``bin`` is the start of the window."""
    window = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    grouped = df.filter(F.col(ts).isNotNull()).groupBy(window.alias("_w"), *(keys or []))
    out = grouped.agg(*(aggs or [F.count(F.lit(1)).alias("event_count")]))
    return out.select(F.col("_w.start").alias("bin"), *[c for c in out.columns if c != "_w"])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def tagged_union(tables: Mapping[str, DataFrame], columns: list[str], tag: str) -> DataFrame:
    return union_all([df.select(*columns, F.lit(name).alias(tag)) for name, df in tables.items()])


def velocity(tables: Mapping[str, DataFrame], as_of: str, interval: str = "1 hour") -> DataFrame:
    """Events per type in five-minute windows."""
    both = tagged_union(tables, [TS], "event_type")
    return tumbling(lookback(both, TS, as_of, interval), TS, "5 minutes", ["event_type"])


def freshness(tables: Mapping[str, DataFrame], as_of: str, warn: int = 15, crit: int = 60) -> DataFrame:
    """Minutes since the last event of each table, with its status."""
    last = union_all([df.agg(F.max(TS).alias("last_event")).select(F.lit(n).alias("table_name"), "last_event") for n, df in tables.items()])
    minutes = F.coalesce(s.minutes_between(moment(as_of), F.col("last_event")), F.lit(9999))
    aged = last.withColumn("minutes_ago", minutes)
    return aged.withColumn("status", F.when(F.col("minutes_ago") > crit, "CRITICAL").when(F.col("minutes_ago") > warn, "WARNING").otherwise("OK"))


def _with_lag(parsed: DataFrame) -> DataFrame:
    landed = parsed.filter(F.col("_corrupt_record").isNull()).withColumn("event_ts", F.try_to_timestamp("event_timestamp"))
    return landed.filter(F.col("event_ts").isNotNull()).withColumn("lag_sec", F.timestamp_diff("SECOND", F.col("event_ts"), F.col("ingest_ts")))


def ingest_lag(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Seconds from event to landing: p50, p90, p99 per tag (and minute, if asked)."""
    keys = by if by is not None else ["_table"]
    return _with_lag(parsed).groupBy(*keys).agg(
        quantile("lag_sec", 0.5).alias("p50"), quantile("lag_sec", 0.9).alias("p90"), quantile("lag_sec", 0.99).alias("p99"), F.count(F.lit(1)).alias("event_count"))


def ingest_lag_by_minute(parsed: DataFrame, as_of: str, interval: str) -> DataFrame:
    rows = lookback(_with_lag(parsed), "event_ts", as_of, interval).withColumn("bin", F.date_trunc("minute", "event_ts"))
    return rows.groupBy("bin", "_table").agg(quantile("lag_sec", 0.5).alias("p50"), quantile("lag_sec", 0.9).alias("p90"), quantile("lag_sec", 0.99).alias("p99"))


def throughput(parsed: DataFrame, as_of: str, interval: str = "15 minutes") -> DataFrame:
    """Events per minute and per second, per tag."""
    rows = lookback(_with_lag(parsed), "event_ts", as_of, interval)
    per_minute = tumbling(rows, "event_ts", "1 minute", ["_table"])
    return per_minute.withColumn("events_per_sec", s.rounded(F.col("event_count") / F.lit(60.0), 6))


def apply_retention(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows still within the days a table is kept."""
    return df.filter(F.col(ts) >= moment(as_of) - s.spark_interval(f"{days} days"))


def retention_report(tables: Mapping[str, tuple[DataFrame, str]], as_of: str, days: Mapping[str, int] = ref.RETENTION_DAYS) -> DataFrame:
    """Rows kept and dropped per table."""

    def one(name: str, df: DataFrame, ts: str) -> DataFrame:
        kept = F.col(ts) >= moment(as_of) - s.spark_interval(f"{days[name]} days")
        return df.agg(F.lit(name).alias("table_name"), F.lit(days[name]).alias("days"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))

    return union_all([one(n, df, ts) for n, (df, ts) in tables.items()])


def sessions(df: DataFrame, gap: str, keys: list[str], ts: str = TS) -> DataFrame:
    """Bursts of events of a key separated by at least the gap."""
    grouped = df.filter(F.col(ts).isNotNull()).groupBy(F.session_window(F.col(ts), gap).alias("_s"), *keys).agg(F.count(F.lit(1)).alias("event_count"))
    return grouped.select(F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), *keys, "event_count")


def split_late(parsed: DataFrame, delay: str) -> tuple[DataFrame, DataFrame]:
    """Batch twin of the watermark: rows landed within the delay, and the late ones."""
    landed = parsed.withColumn("event_ts", F.try_to_timestamp("event_timestamp"))
    late = F.coalesce(F.col("ingest_ts") > F.col("event_ts") + s.spark_interval(delay), F.lit(False))
    return landed.filter(~late), landed.filter(late)


def dedup_events(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Batch twin of the watermarked duplicate filter: each event once, its last arrival.

    Rows without an id can't be told apart and all stay.
    """
    order = [c for c in ("ingest_ts", TS) if c in df.columns]
    return dedup_latest(df.filter(F.col(key).isNotNull()), [key], order).unionByName(df.filter(F.col(key).isNull()))


def replay(df: DataFrame, from_ts: str, run_id: str, ts: str = TS) -> DataFrame:
    """Rows from a moment on, marked with the run that scored them."""
    return df.filter(F.col(ts) >= moment(from_ts)).withColumn("scoring_run_id", F.lit(run_id))


def enrich_stream(events: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Events with the columns of static dimensions, one left join each."""
    for dim, key in dims:
        events = events.join(dim, key, "left")
    return events
