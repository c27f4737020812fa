"""Slowly changing dimensions, upserts and duplicate checks on plain tables.

Each function returns the new content of the table; the caller writes it to a fresh
path and then points readers there, so a half-written table is never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.operators.keys import full_keys, max_key
from wardlight.operators.latest import dedup_latest


def _versioned(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns({"is_current": F.lit(1), "effective_start_date": as_of,
                           "effective_end_date": F.lit(None).cast("timestamp")})


def _moment(as_of: str | Column) -> Column:
    return F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of


def scd2_init(src: DataFrame, bk: str, sk: str, as_of: str | Column) -> DataFrame:
    """First load: every row is the current version."""
    return _versioned(full_keys(src, sk, bk), _moment(as_of))


def changed_rows(src: DataFrame, dim: DataFrame, bk: str, tracked: list[str]) -> DataFrame:
    """Business keys that are new or differ in a tracked column, with ``_new`` true for new ones."""
    current = dim.filter(F.col("is_current") == 1).select(bk, F.lit(1).alias("_seen"), *[F.col(c).alias(f"_old_{c}") for c in tracked])
    differs = reduce(lambda a, b: a | b, [~F.col(c).cast("string").eqNullSafe(F.col(f"_old_{c}").cast("string")) for c in tracked])
    joined = src.select(bk, *tracked).join(current, bk, "left")
    return joined.filter(F.col("_seen").isNull() | differs).select(bk, F.col("_seen").isNull().alias("_new")).distinct()


def scd2_merge(src: DataFrame, dim: DataFrame, bk: str, tracked: list[str], sk: str, as_of: str | Column) -> DataFrame:
    """Expire changed versions, add new ones; everything else stays as it is."""
    moment = _moment(as_of)
    changes = changed_rows(src, dim, bk, tracked)
    expired = changes.filter(~F.col("_new")).select(bk, F.lit(True).alias("_expire"))
    hit = F.coalesce(F.col("_expire"), F.lit(False)) & (F.col("is_current") == 1)
    history = dim.join(expired, bk, "left").withColumns({
        "effective_end_date": F.when(hit, moment).otherwise(F.col("effective_end_date")),
        "is_current": F.when(hit, F.lit(0)).otherwise(F.col("is_current")),
    }).drop("_expire")
    incoming = src.join(changes.select(bk), bk, "left_semi")
    inserted = _versioned(full_keys(incoming, sk, bk, max_key(dim, sk)), moment)
    return history.select(*dim.columns).unionByName(inserted, allowMissingColumns=True).select(*dim.columns)


def upsert(target: DataFrame, src: DataFrame, bk: str, keep: list[str]) -> DataFrame:
    """Rows of the source replace those of the target, except for the kept columns."""
    left = target.select(F.struct(*target.columns).alias("t"), F.col(bk))
    right = src.select(F.struct(*src.columns).alias("s"), F.col(bk))
    joined = left.join(right, bk, "full_outer")
    in_source = F.col("s").isNotNull()

    def pick(name: str) -> Column:
        if name == bk:
            return F.col(bk)
        old = F.col(f"t.{name}")
        if name not in src.columns:
            return old.alias(name)
        new = F.col(f"s.{name}")
        return (F.coalesce(old, new) if name in keep else F.when(in_source, new).otherwise(old)).alias(name)

    return joined.select(*[pick(c) for c in target.columns])


def dup_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def rebuild_if_duplicated(target: DataFrame, src: DataFrame, bk: str, keep: list[str]) -> DataFrame:
    """Upsert onto a target without duplicate keys.

    Of a duplicated key that the source has, the source's row counts; of one that it lacks, the
    target's last row by all columns stays.
    """
    twice = dup_keys(target, [bk]).select(bk)
    clean = target.join(twice, bk, "left_anti")
    kept = dedup_latest(target.join(twice, bk, "left_semi").join(src.select(bk), bk, "left_anti"), [bk], [])
    return upsert(clean.unionByName(kept), src, bk, keep)
