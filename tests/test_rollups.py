"""Look-backs put together from roll-ups: covers by brute force, late rows, repeated batches, folding."""

import datetime
import glob
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import rollups

NOW = datetime.datetime(2024, 3, 9, 14, 3, 41)
MINUTE = datetime.timedelta(minutes=1)
SPANS = {f"{m} minutes": m * MINUTE for m in (0.25, 1, 7, 60, 64, 300, 1440, 1500, 5000)}
ROLLUP = rollups.Rollup("ts", ("kind",), {"n": "bigint"}, ("n",), ("n",))


def _inside(t, pieces):
    return sum(a <= t < b for a, b in pieces)


@pytest.mark.parametrize("end", [NOW, NOW.replace(second=0), NOW.replace(minute=0, second=0), NOW.replace(hour=0, minute=0, second=0), NOW.replace(microsecond=999_999)])
@pytest.mark.parametrize("span", [*SPANS.values(), datetime.timedelta(microseconds=1), datetime.timedelta(days=3)])
def test_a_cover_holds_every_moment_once(end, span):
    start = end - span
    found = rollups.cover(start, end)
    rng = random.Random(1)
    tick = datetime.timedelta(microseconds=1)
    moments = {start, start + tick, end, end + tick, end - MINUTE} | {t + d for ps in found.values() for p in ps for t in p for d in (-tick, 0 * tick)}
    moments |= {start + (rng.random() * 1.2 - 0.1) * span for _ in range(200)}
    for t in moments:
        assert sum(_inside(t, pieces) for pieces in found.values()) == (start < t <= end), t
    for tier, size in rollups.SECONDS.items():
        assert all((x - datetime.datetime(1970, 1, 1)) % datetime.timedelta(seconds=size) == 0 * tick for p in found[tier] for x in p)
    assert sum((b - a for a, b in found["rows"]), 0 * tick) <= 2 * MINUTE


def _events(n, seed):
    rng = random.Random(seed)
    ends = [NOW - s for s in SPANS.values()] + [NOW]
    out = [(rng.choice(ends) if i % 9 == 0 else NOW - rng.random() ** 2 * 5500 * MINUTE + 5 * MINUTE, rng.choice("ab") if i % 11 else None, rng.randrange(100) if i % 7 else None) for i in range(n)]
    return [*out, (None, "a", 1)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, kind string, n long").withColumn("_day", F.to_date("ts"))


def _expected(rows, keys=True):
    groups = {} if keys else {(name,): [] for name in SPANS}
    for name, span in SPANS.items():
        for ts, kind, n in rows:
            if ts is not None and NOW - span < ts <= NOW:
                groups.setdefault((name, kind) if keys else (name,), []).append(n)
    out = []
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        figures = (sum(known), min(known), max(known)) if known else (None, None, None)
        out.append((*key, len(values), *figures))
    return sorted(out, key=repr)


def test_look_backs_over_batches_late_rows_and_a_repeated_batch(spark, rows, tmp_path):
    path = str(tmp_path / "r")
    first, second = _events(400, 1), _events(300, 2)
    for batch_id, events in ((0, first), (1, second), (1, second), (2, [])):
        rollups.add_batch(_frame(spark, events), ROLLUP, path, batch_id)
    everything = _frame(spark, first + second)

    def got():
        return rows(rollups.lookbacks(spark, path, ROLLUP, everything, NOW.isoformat(" "), SPANS))

    assert got() == _expected(first + second)
    assert rollups.fold(spark, path, ROLLUP) == 3
    assert got() == _expected(first + second)
    assert rollups.fold(spark, path, ROLLUP) == 0
    third = _events(100, 3)
    rollups.add_batch(_frame(spark, third), ROLLUP, path, 3)
    everything = _frame(spark, first + second + third)
    assert got() == _expected(first + second + third)
    assert rollups.fold(spark, path, ROLLUP) == 2 and got() == _expected(first + second + third)


def test_a_sum_that_was_not_finished_does_not_count(spark, rows, tmp_path, monkeypatch):
    path, events = str(tmp_path / "r"), _events(200, 4)
    rollups.add_batch(_frame(spark, events), ROLLUP, path, 0)
    real = rollups.files.save_table
    monkeypatch.setattr(rollups.files, "save_table", lambda df, to, **kw: (_ for _ in ()).throw(KeyboardInterrupt) if "tier=day" in to else real(df, to, **kw))
    with pytest.raises(KeyboardInterrupt):
        rollups.fold(spark, path, ROLLUP)
    monkeypatch.setattr(rollups.files, "save_table", real)
    assert glob.glob(f"{path}/part=through-0")
    wanted = _expected(events)
    look = rollups.lookbacks(spark, path, ROLLUP, _frame(spark, events), NOW.isoformat(" "), SPANS)
    assert rows(look) == wanted
    assert rollups.fold(spark, path, ROLLUP) == 1
    assert rows(rollups.lookbacks(spark, path, ROLLUP, _frame(spark, events), NOW.isoformat(" "), SPANS)) == wanted


def test_without_keys_an_empty_span_has_the_count_0(spark, rows, tmp_path):
    path, plain = str(tmp_path / "r"), rollups.Rollup("ts", (), {"n": "bigint"}, ("n",), ("n",))
    events = [(NOW - 70 * MINUTE, "a", 5)]
    rollups.add_batch(_frame(spark, events), plain, path, 0)
    assert rows(rollups.lookbacks(spark, path, plain, _frame(spark, events), NOW.isoformat(" "), SPANS)) == _expected(events, keys=False)
    empty = str(tmp_path / "none")
    rollups.add_batch(_frame(spark, events).filter("false"), plain, empty, 0)
    assert rows(rollups.lookbacks(spark, empty, plain, _frame(spark, events).filter("false"), NOW.isoformat(" "), SPANS)) == _expected([], keys=False)


def test_a_long_look_back_reads_few_days_of_rows(spark, tmp_path):
    path, events = str(tmp_path / "r"), _events(200, 5)
    rollups.add_batch(_frame(spark, events), ROLLUP, path, 0)
    stored = str(tmp_path / "rows")
    _frame(spark, events).write.partitionBy("_day").parquet(stored)
    look = rollups.lookbacks(spark, path, ROLLUP, spark.read.parquet(stored), NOW.isoformat(" "), {"4 days": datetime.timedelta(days=4)})
    plan = look._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("], ")[0] for part in plan.split("PartitionFilters: ")[1:]]
    assert len(filters) == 4 and all("_day" in f for f in filters)
