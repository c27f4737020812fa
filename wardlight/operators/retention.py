"""Retention that removes data: whole days are dropped as folders, only the day of the cut is written anew.

A table lies in folders by day. Days wholly before the cut are deleted without opening a file of
theirs; of the day that holds the cut the rows that stay are written beside the table first and
then take the folder's place. Every step can be run again: what was deleted stays deleted, and a
day that was written but not yet put in place is put there by the next run. Files of later days
are not touched. Rows without a time have no age: they lie in a folder of their own and stay.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.events import DAY
from wardlight.sources import files

_ASIDE = "_staying"  # a name that readers of the table pass over


@dataclass(frozen=True)
class Dropped:
    """What a run did: days deleted, and the day that was written anew, if any."""

    days: list[str]
    cut: str | None


def save_by_day(df: DataFrame, path: str, ts: str) -> None:
    """Store rows by the day of their time."""
    files.save_table(df.withColumn(DAY, F.to_date(ts)), path, partition_by=[DAY])


def _days(spark: SparkSession, path: str) -> list[str]:
    """Names of the day folders: one a day, whatever the number of rows."""
    names = (p.rsplit("=", 1)[1] for p in files.matching(spark, f"{path}/{DAY}=*"))
    return sorted(n for n in names if n[:1].isdigit())


def _put_in_place(spark: SparkSession, path: str) -> None:
    """Put days that were written aside, to their end, in place of the stored ones."""
    for done in files.matching(spark, f"{path}/{_ASIDE}/{DAY}=*/_SUCCESS"):
        day = done.rsplit("/", 2)[-2]
        files.delete_folder(spark, f"{path}/{day}")
        files.move_folder(spark, f"{path}/{_ASIDE}/{day}", f"{path}/{day}")


def drop_before(spark: SparkSession, path: str, ts: str, cut: datetime.datetime) -> Dropped:
    """Remove the rows whose time lies before ``cut`` from a table stored by day."""
    _put_in_place(spark, path)
    day = cut.date().isoformat()
    stored = _days(spark, path)
    old = [d for d in stored if d < day]
    for d in old:
        files.delete_folder(spark, f"{path}/{DAY}={d}")
    if day not in stored:
        return Dropped(old, None)
    rows = spark.read.parquet(f"{path}/{DAY}={day}")
    stays = F.col(ts) >= F.lit(cut.isoformat(" ")).cast("timestamp")
    if rows.filter(~stays).isEmpty():
        return Dropped(old, None)
    rows.filter(stays).write.mode("overwrite").parquet(f"{path}/{_ASIDE}/{DAY}={day}")
    _put_in_place(spark, path)
    return Dropped(old, day)


def cut_of(as_of: str, days: int) -> datetime.datetime:
    """The first moment that a table kept for so many days still holds."""
    return datetime.datetime.fromisoformat(as_of) - datetime.timedelta(days=days)
