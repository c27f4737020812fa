"""The incremental load on hand-made rows: touched months, moved rows, reruns."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests import compare
from wardlight.operators import increment, metrics

KEY = "day"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _files(spark, path):
    """Files of each month that counts."""
    return {m: sorted(glob.glob(f"{path}/data/version={v}/_month={m}/*.parquet")) for m, v in increment.current(spark, path).items()}


def _rows(spark, rows, path, *columns):
    return rows(increment.read_months(spark, path), *(columns or ("id", "sk", "day", "v")))


@pytest.fixture
def stored(spark, tmp_path):
    rows = [("a", 1, 20200105, 10), ("b", 2, 20200106, 20), ("c", 3, 20200210, 30), ("d", 4, 20200311, 40), (None, 5, None, 50)]
    path = str(tmp_path / "fact")
    increment.save_by_month(spark.createDataFrame(rows, "id string, sk long, day int, v long"), path, increment.month_of_key(KEY))
    return path


def _merge(spark, path, rows, drop_id="d1"):
    drop = spark.createDataFrame(rows, "id string, day int, v long")
    return increment.merge_months(spark, path, drop, "id", increment.month_of_key(KEY), "sk", drop_id)


DROP = [("c", 20200120, 31), ("e", 20200401, 60)]  # c moves to January and leaves its month empty, e is new in April
AFTER = sorted([("a", 1, 20200105, 10), ("b", 2, 20200106, 20), ("c", 3, 20200120, 31), ("d", 4, 20200311, 40), ("e", 6, 20200401, 60), (None, 5, None, 50)], key=repr)


def test_a_drop_changes_only_its_months(spark, rows, stored):
    before = _files(spark, stored)
    assert _merge(spark, stored, DROP) == [202001, 202002, 202004]
    assert _rows(spark, rows, stored) == AFTER
    after = _files(spark, stored)
    assert after[202003] == before[202003] and after[0] == before[0]
    assert set(after) == {0, 202001, 202003, 202004}
    assert _rows(spark, rows, stored, "id", "v")[:2] == [("a", 10), ("b", 20)]


def test_a_second_run_of_a_drop_changes_nothing(spark, rows, stored):
    drop = [*DROP, (None, 20200311, 1)]
    _merge(spark, stored, drop)
    once = _rows(spark, rows, stored)
    files = _files(spark, stored)
    _merge(spark, stored, drop)
    assert _rows(spark, rows, stored) == once and _files(spark, stored) == files
    _merge(spark, stored, drop, "the same rows under another name")
    assert _rows(spark, rows, stored) == once


@pytest.mark.parametrize("step", ["save_table", "matching"])
def test_a_load_that_stops_is_run_again(spark, rows, stored, monkeypatch, step):
    """Stopped before the months are written, and between them and the list: readers see the old state."""
    before, real, calls = _rows(spark, rows, stored), getattr(increment.files, step), []

    def stop(*args, **kwargs):
        if step == "save_table" or "version=1/_month" in args[1]:
            calls.append(1)
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(increment.files, step, stop)
    with pytest.raises(RuntimeError):
        _merge(spark, stored, DROP)
    monkeypatch.setattr(increment.files, step, real)
    assert calls and _rows(spark, rows, stored) == before
    _merge(spark, stored, DROP)
    assert _rows(spark, rows, stored) == AFTER


def test_an_empty_drop_touches_nothing(spark, stored):
    before = _files(spark, stored)
    assert _merge(spark, stored, []) == []
    assert _files(spark, stored) == before


def test_a_drop_is_computed_once(spark, stored):
    """Rows of the drop cost a load of their own: keys, changes and months are made from what was written of them."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    drop = spark.createDataFrame(DROP, "id string, day int, v long")
    counted = drop.mapInArrow(count, drop.schema)
    increment.merge_months(spark, stored, counted, "id", increment.month_of_key(KEY), "sk", "d1", ids=drop)
    assert seen.value == len(DROP)


def test_a_load_that_stops_between_its_changes_is_run_again(spark, rows, stored, monkeypatch):
    real = increment._write_changes

    def stop(df, at, sign):
        if sign < 0:
            raise RuntimeError("lost")
        return real(df, at, sign)

    monkeypatch.setattr(increment, "_write_changes", stop)
    with pytest.raises(RuntimeError):
        _merge(spark, stored, [("x", 20200120, 1)])
    monkeypatch.setattr(increment, "_write_changes", real)
    _merge(spark, stored, DROP)
    assert _rows(spark, rows, stored) == AFTER


def test_repeated_keys_of_a_drop_share_their_number(spark, rows, stored):
    drop = [("c", 20200120, 31), ("c", 20200120, 32), ("e", 20200401, 60), ("e", 20200402, 61), (None, None, 51), (None, None, 52)]
    _merge(spark, stored, drop)
    assert _rows(spark, rows, stored, "id", "sk", "v") == sorted(
        [("a", 1, 10), ("b", 2, 20), ("c", 3, 31), ("c", 3, 32), ("d", 4, 40), ("e", 6, 60), ("e", 6, 61), (None, 5, 51), (None, 5, 52)], key=repr)


def test_old_versions_are_forgotten(spark, rows, stored):
    _merge(spark, stored, DROP)
    assert [r[0] for r in rows(increment.read_months(spark, stored, after="first"), "id") if r[0]] == ["a", "b", "c", "d"]
    assert increment.forget(spark, stored) == 2 and increment.forget(spark, stored) == 0  # January and February of the first load
    assert _rows(spark, rows, stored) == AFTER


def test_aggregates_equal_a_full_build(spark, rows, stored, tmp_path):
    def build(df):
        return df.groupBy(KEY).agg(F.sum("v").alias("total"))

    path = str(tmp_path / "agg")
    increment.save_by_month(build(increment.read_months(spark, stored)), path, increment.month_of_key(KEY))
    months = _merge(spark, stored, [("c", 20200105, 31), (None, 20200311, 1)])
    for _ in range(2):
        increment.refresh_months(spark, path, stored, months, build, increment.month_of_key(KEY), "d1")
    assert _rows(spark, rows, path, KEY, "total") == rows(build(increment.read_months(spark, stored)), KEY, "total")


def test_signed_sums_equal_a_full_build(spark, rows, stored, tmp_path):
    """Groups over all months: values that moved between groups, a group that ends, a second run."""
    sums = increment.SignedSums(lambda df: df.withColumn("g", F.floor(F.col("v") / 25)), ("g",), {"v": "decimal(20,0)"}, lambda df: df.select("g", "n", "sum_v", "n_v"))
    path = str(tmp_path / "sums")
    sums.start(increment.read_months(spark, stored), path)
    _merge(spark, stored, [("c", 20200120, 99), ("d", 20200311, 44), ("e", 20200401, None)])
    for _ in range(2):
        sums.take(spark, path, increment.changes_of(spark, stored, "d1"), "d1")
    full = str(tmp_path / "full")
    sums.start(increment.read_months(spark, stored), full)
    assert [(r[0], r[1], r[2] or 0, r[3]) for r in rows(sums.read(spark, path))] == [(r[0], r[1], r[2] or 0, r[3]) for r in rows(sums.read(spark, full))]


def test_touched_groups_equal_a_full_build(spark, rows, stored, tmp_path):
    def build(df):
        return df.groupBy("g").agg(F.max("v").alias("most"), F.count("*").alias("n"))

    grouped = increment.read_months(spark, stored).drop("_month").withColumn("g", F.when(F.col("sk") < 4, F.lit("x")).otherwise(F.col("id")))
    fact, path = str(tmp_path / "grouped"), str(tmp_path / "groups")
    increment.save_by_month(grouped, fact, increment.month_of_key(KEY))
    increment.save_by_month(build(grouped), path, increment.bucket_of("g"))
    before = _files(spark, path)
    drop = spark.createDataFrame([("c", 3, 20200707, 5, "y")], "id string, sk long, day int, v long, g string")
    increment.merge_months(spark, fact, drop, "id", increment.month_of_key(KEY), drop_id="d1")
    increment.refresh_groups(spark, path, fact, increment.changes_of(spark, fact, "d1"), ["g"], build, "d1")
    assert rows(increment.read_months(spark, path), "g", "most", "n") == rows(build(increment.read_months(spark, fact)), "g", "most", "n")
    after = _files(spark, path)
    assert sum(after.get(b) == f for b, f in before.items()) >= 2  # the groups d and null lie where they lay


def test_only_the_wanted_months_are_read(spark, stored):
    assert {f.rsplit("/", 2)[-2] for f in increment.read_months(spark, stored, [202001]).inputFiles()} == {"_month=202001"}


def test_a_group_that_only_one_table_has_is_kept(spark, rows):
    payer = spark.createDataFrame([(1, "P1"), (2, "P2")], "payer_key long, payer_name string")
    provider = spark.createDataFrame([(7, "Oncology")], "provider_key long, specialty string")
    claims = spark.createDataFrame([(1, 7), (1, 7)], "payer_key long, provider_key long")
    premiums = spark.createDataFrame([(1, 5.0), (2, 9.0)], "payer_key long, premium_amount double")
    tables = {"dim_payer": payer, "dim_provider": provider, "fact_claim": claims, "fact_premium": premiums}
    out = metrics.evaluate(tables, ["total_claims", "total_premium_revenue"], ["dim_payer.payer_name", "dim_provider.specialty"])
    assert [(r[0], r[1], r[2], float(r[3])) for r in rows(out)] == [("P1", "Oncology", 2, 5.0), ("P2", None, None, 9.0)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no source tables")
def test_claims_keep_the_key_of_their_encounter(spark):
    """Also where first load and drop give encounters other keys than a full build."""
    con, name = compare.connect(SF_DIR), "c23_increment_claims"
    got = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(got, con, entry.oracle_sql()[name]) is None
    assert got.filter("encounter_key IS NOT NULL").count() > 0
