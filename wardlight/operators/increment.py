"""The incremental load: a drop of new and changed rows taken into tables stored by month.

A table is a folder of versions and a list of which version of each month counts. A drop writes
the months that it touches, also those that end up empty, as a new version, and the list last:
until then readers see the old state, whatever is lost on the way. What a drop changed (rows that
went, rows that came) is written before anything else and kept, so a load that stopped at any
point can be run again, and a second run of a drop changes nothing.

Aggregates follow in three ways: by month, where their groups lie in months; by signed sums,
where a group takes rows of all months; by touched groups, where figures can't be added up.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.keys import assign_keys
from wardlight.operators.scans import null_safe_join
from wardlight.session import cut_lineage
from wardlight.sources import files

MONTH = "_month"  # 199801; 0 for rows without a date
SIGN = "_sign"  # of a change: -1 for a row that went, 1 for one that came


def month_of_key(date_key: str) -> Column:
    return F.coalesce(F.floor(F.col(date_key) / 100).cast("int"), F.lit(0))


def month_of_date(date: str) -> Column:
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


def bucket_of(*keys: str, buckets: int = 256) -> Column:
    """A stand-in for the month where groups have none: groups of one bucket are written together."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# --- versions --------------------------------------------------------------------------------

def _finished(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that were written to their end, by name."""
    return sorted(p.rsplit("/", 2)[-2] for p in files.matching(spark, f"{pattern}/_SUCCESS"))


def _lists(spark: SparkSession, path: str) -> list[str]:
    return _finished(spark, f"{path}/current/*")


def applied(spark: SparkSession, path: str, drop_id: str) -> bool:
    """Has this drop been taken into the table?"""
    return any(name.split("-", 1)[1] == drop_id for name in _lists(spark, path))


def current(spark: SparkSession, path: str, after: str | None = None) -> dict[int, int]:
    """The version that counts of each month, now or after an earlier drop: twelve rows a year."""
    lists = [name for name in _lists(spark, path) if after is None or name.split("-", 1)[1] == after]
    return {r["month"]: r["version"] for r in spark.read.schema("month int, version int").parquet(f"{path}/current/{lists[-1]}").collect()} if lists else {}


def _publish(df: DataFrame, path: str, months: list[int] | None, drop_id: str) -> None:
    """Write the rows as a new version of their months, then the list in which they count."""
    spark = df.sparkSession
    version = max([int(name.split("-", 1)[0]) for name in _lists(spark, path)], default=-1) + 1
    into = f"{path}/data/version={version}"
    files.save_table(df, into, partition_by=[MONTH])
    written = [int(p.rsplit("=", 1)[1]) for p in files.matching(spark, f"{into}/{MONTH}=*")]
    kept = {m: v for m, v in current(spark, path).items() if months is not None and m not in months}
    rows = sorted((kept | dict.fromkeys(written, version)).items())
    spark.createDataFrame(rows, "month int, version int").coalesce(1).write.mode("overwrite").parquet(f"{path}/current/{version:06d}-{drop_id}")


def save_by_month(df: DataFrame, path: str, month: Column, drop_id: str = "first") -> None:
    _publish(df.withColumn(MONTH, month), path, None, drop_id)


def read_months(spark: SparkSession, path: str, months: list[int] | None = None, after: str | None = None) -> DataFrame:
    """The rows with their month, of all months or of those listed; files of others are not opened.

    ``after`` reads the table as an earlier drop left it, as long as its versions are not forgotten.
    """
    wanted = {m: v for m, v in current(spark, path, after).items() if months is None or m in months}
    everything = spark.read.option("basePath", f"{path}/data")
    if not wanted:
        return everything.parquet(f"{path}/data").filter(F.lit(False)).drop("version")
    return everything.parquet(*[f"{path}/data/version={v}/{MONTH}={m}" for m, v in sorted(wanted.items())]).drop("version")


def replace_months(df: DataFrame, path: str, months: list[int], drop_id: str | None = None) -> None:
    """The rows take the place of what is stored for the listed months."""
    _publish(df, path, months, drop_id or uuid.uuid4().hex)


def forget(spark: SparkSession, path: str) -> int:
    """Delete months of versions that count no more; safe to repeat. Gives how many there were."""
    counts = {f"version={v}/{MONTH}={m}" for m, v in current(spark, path).items()}
    old = [p for p in files.matching(spark, f"{path}/data/version=*/{MONTH}=*") if "/".join(p.rsplit("/", 2)[-2:]) not in counts]
    for folder in old:
        files.delete_folder(spark, folder)
    return len(old)


# --- drops -----------------------------------------------------------------------------------

def _months(df: DataFrame) -> list[int]:
    """Months in use: twelve a year, so the list is short whatever the number of rows."""
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())


def changes_of(spark: SparkSession, path: str, drop_id: str) -> DataFrame:
    """What a drop changed in a table: rows that went and rows that came, with their sign."""
    return spark.read.parquet(f"{path}/changes/{drop_id}")


def _write_changes(df: DataFrame, at: str, sign: int) -> DataFrame:
    files.save_table(df, f"{at}/{SIGN}={sign}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{at}/{SIGN}={sign}")


def merge_months(spark: SparkSession, path: str, drop: DataFrame, bk: str, month: Column, sk: str | None = None, drop_id: str | None = None,
                 ids: DataFrame | None = None) -> list[int]:
    """Rows of the drop, one per business key, replace those stored under their keys.

    With ``sk`` known keys keep their surrogate key and new ones follow the highest in use;
    ``ids`` may name a table that holds exactly the business keys of the drop and is cheaper
    to read. The drop is computed once, when the rows that came are written; what follows
    reads them, and of what is stored only months that hold their keys. Gives the months that are touched: those of the rows and those where they lay before.
    """
    drop_id = drop_id or uuid.uuid4().hex
    at = f"{path}/changes/{drop_id}"
    if len(_finished(spark, f"{at}/{SIGN}=*")) < 2:
        stored = read_months(spark, path)
        if sk:
            drop = assign_keys(drop.drop(sk), stored.select(bk, sk), sk, bk, ids)
        came = _write_changes(drop.withColumn(MONTH, month).select(*stored.columns), at, 1)
        taken = stored.select(bk, MONTH).join(came.select(F.col(bk).alias("_id")), F.col(bk).eqNullSafe(F.col("_id")), "left_semi")
        _write_changes(rows_at(spark, path, cut_lineage(taken.distinct()), bk, month=True), at, -1)
    changes = changes_of(spark, path, drop_id)
    touched = _months(changes)
    if touched and not applied(spark, path, drop_id):
        came = changes.filter(F.col(SIGN) > 0).drop(SIGN)
        gone = changes.filter(F.col(SIGN) < 0).select(F.col(bk).alias("_id"))  # the keys of the drop that were there: fewer than all of the drop
        kept = read_months(spark, path, touched).join(gone, F.col(bk).eqNullSafe(F.col("_id")), "left_anti")
        replace_months(kept.unionByName(came), path, touched, drop_id)
    return touched


def rows_of(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Stored rows under the given keys: their months are looked up in two columns, the rows read from these."""
    known = keys.select(F.col(key).alias("_id")).distinct()
    same = F.col(key).eqNullSafe(F.col("_id"))
    months = _months(read_months(spark, path).select(key, MONTH).join(known, same, "left_semi"))
    return read_months(spark, path, months).join(known, same, "left_semi").drop(MONTH)


def rows_at(spark: SparkSession, path: str, ids: DataFrame, bk: str, month: bool = False) -> DataFrame:
    """Stored rows under the given business keys, whose months are known: ``ids`` has both and is read twice."""
    known = ids.select(F.col(bk).alias("_id"))
    rows = read_months(spark, path, _months(ids)).join(known, F.col(bk).eqNullSafe(F.col("_id")), "left_semi")
    return rows if month else rows.drop(MONTH)


# --- aggregates ------------------------------------------------------------------------------

def refresh_months(spark: SparkSession, path: str, fact: str, months: list[int], build: Callable[[DataFrame], DataFrame], month: Column, drop_id: str | None = None) -> None:
    """Compute the listed months of an aggregate anew from the same months of its fact."""
    if months and not (drop_id and applied(spark, path, drop_id)):
        rows = read_months(spark, fact, months).drop(MONTH)
        replace_months(build(rows).withColumn(MONTH, month), path, months, drop_id)


@dataclass(frozen=True)
class SignedSums:
    """An aggregate whose columns follow from sums and counts: rows that came are added, rows that went taken off.

    ``rows`` prepares fact rows (and keeps their sign), ``keys`` are the groups, ``sums`` are exact
    numbers, ``finish`` gives the columns from ``n``, ``sum_x`` and ``n_x`` (rows with a value).
    """

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    sums: dict[str, str]  # column: decimal type
    finish: Callable[[DataFrame], DataFrame]

    def of(self, changes: DataFrame) -> DataFrame:
        sign = F.col(SIGN)
        sums = [F.sum(F.col(c).cast(kind) * sign).alias(f"sum_{c}") for c, kind in self.sums.items()]
        counts = [F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}") for c in self.sums]
        return self.rows(changes).groupBy(*self.keys).agg(F.sum(sign).alias("n"), *sums, *counts)

    def start(self, fact: DataFrame, path: str) -> None:
        self.of(fact.withColumn(SIGN, F.lit(1))).write.mode("overwrite").parquet(f"{path}/state/000000-first")

    def take(self, spark: SparkSession, path: str, changes: DataFrame, drop_id: str) -> None:
        """Add what a drop changed to the state; the state before it stays until the new one is whole."""
        states = _finished(spark, f"{path}/state/*")
        if any(name.split("-", 1)[1] == drop_id for name in states):
            return
        before = spark.read.parquet(f"{path}/state/{states[-1]}")
        parts = before.unionByName(self.of(changes))
        added = parts.groupBy(*self.keys).agg(*[F.sum(c).cast(before.schema[c].dataType).alias(c) for c in before.columns if c not in self.keys])
        added.filter(F.col("n") != 0).write.mode("overwrite").parquet(f"{path}/state/{len(states):06d}-{drop_id}")

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return self.finish(spark.read.parquet(f"{path}/state/{_finished(spark, f'{path}/state/*')[-1]}"))


def refresh_groups(spark: SparkSession, path: str, fact: str, changes: DataFrame, keys: list[str], build: Callable[[DataFrame], DataFrame], drop_id: str | None = None) -> None:
    """Compute the groups of changed rows anew from all their rows; other groups stay as they are.

    The aggregate is stored by buckets of its groups, and only buckets of touched groups are written.
    """
    if drop_id and applied(spark, path, drop_id):
        return
    groups = changes.select(*keys).distinct().withColumn(MONTH, bucket_of(*keys))
    touched = _months(groups)
    if not touched:
        return
    rows = null_safe_join(read_months(spark, fact).drop(MONTH), groups.drop(MONTH), keys, "left_semi")
    kept = null_safe_join(read_months(spark, path, touched), groups.drop(MONTH), keys, "left_anti")
    replace_months(kept.unionByName(build(rows).withColumn(MONTH, bucket_of(*keys))), path, touched, drop_id)
