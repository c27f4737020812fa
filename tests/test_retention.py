"""Retention by folders: what goes, what stays untouched, runs that stopped and runs that are repeated."""

import datetime
import glob
import os

import pytest

from wardlight.operators import retention
from wardlight.sources import files

CUT = datetime.datetime(2024, 3, 3, 12, 0)


def _row(n, text):
    return (n, datetime.datetime.fromisoformat(text) if text else None)


ROWS = [_row(1, "2024-02-28 10:00"), _row(2, "2024-03-02 23:59:59"), _row(3, "2024-03-03 00:00"), _row(4, "2024-03-03 11:59:59"), _row(5, "2024-03-03 12:00"),
        _row(6, "2024-03-03 18:00"), _row(7, "2024-03-04 00:00"), _row(8, "2024-03-09 01:00"), _row(9, None)]
STAYING = [5, 6, 7, 8, 9]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "events")
    retention.save_by_day(spark.createDataFrame(ROWS, "id long, ts timestamp"), path, "ts")
    return path


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/_day=*/*.parquet")}


def test_old_days_go_and_kept_days_are_not_touched(spark, table):
    before = _files(table)
    done = retention.drop_before(spark, table, "ts", CUT)
    assert done == retention.Dropped(["2024-02-28", "2024-03-02"], "2024-03-03")
    assert _ids(spark, table) == STAYING
    after = _files(table)
    kept = {f: t for f, t in before.items() if "_day=2024-02" not in f and "_day=2024-03-02" not in f and "_day=2024-03-03" not in f}
    assert len(kept) == 3 and kept.items() <= after.items()
    assert all("_day=2024-03-03" in f for f in after.keys() - kept.keys())


def test_a_second_run_writes_nothing(spark, table):
    retention.drop_before(spark, table, "ts", CUT)
    before = _files(table)
    assert retention.drop_before(spark, table, "ts", CUT) == retention.Dropped([], None)
    assert _files(table) == before and _ids(spark, table) == STAYING


@pytest.mark.parametrize("step", ["delete_folder", "move_folder"])
def test_a_run_that_stops_on_the_way_is_finished_by_the_next(spark, table, monkeypatch, step):
    real, calls = getattr(files, step), []

    def stops(*arguments):
        calls.append(arguments)
        if len(calls) == (3 if step == "delete_folder" else 1):  # before the day of the cut is deleted, and before its rest is moved
            raise KeyboardInterrupt
        return real(*arguments)

    monkeypatch.setattr(files, step, stops)
    with pytest.raises(KeyboardInterrupt):
        retention.drop_before(spark, table, "ts", CUT)
    monkeypatch.setattr(files, step, real)
    retention.drop_before(spark, table, "ts", CUT)
    assert _ids(spark, table) == STAYING


def test_edges_of_the_cut(spark, table):
    assert retention.drop_before(spark, table, "ts", datetime.datetime(2024, 3, 3)) == retention.Dropped(["2024-02-28", "2024-03-02"], None)
    assert retention.drop_before(spark, table, "ts", datetime.datetime(2024, 3, 6)) == retention.Dropped(["2024-03-03", "2024-03-04"], None)
    assert retention.drop_before(spark, table, "ts", datetime.datetime(2024, 3, 9, 5)).cut == "2024-03-09"
    assert _ids(spark, table) == [9]


def test_cut_of_a_table(spark):
    assert retention.cut_of("2024-04-15 12:00:00", 90) == datetime.datetime(2024, 1, 16, 12)
