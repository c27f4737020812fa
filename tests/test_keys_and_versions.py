"""Surrogate keys, versions, upserts: hand-computed frames and reruns."""

import random

from pyspark.sql import functions as F

from wardlight.operators import keys, latest, scd


def test_keys_are_dense_in_key_order(spark, rows):
    names = [f"K{i:05d}" for i in range(3000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "k string").repartition(7)
    assert rows(keys.full_keys(df, "sk", "k"), "k", "sk") == [(n, i + 1) for i, n in enumerate(sorted(names))]


def test_keys_of_an_empty_table(spark, rows):
    assert rows(keys.full_keys(spark.createDataFrame([], "k string"), "sk", "k")) == []


def test_known_keys_stay_and_new_ones_follow(spark, rows):
    existing = spark.createDataFrame([("b", 7, 1), ("b", 9, 1), ("x", 4, 0), ("d", 5, 1)], "k string, sk long, is_current int")
    src = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("x",)], "k string")
    keyed = keys.assign_keys(src, existing, "sk", "k")
    # b had two keys: the lowest stays; x is not current, so it counts as new
    assert rows(keyed, "k", "sk") == [("a", 10), ("b", 7), ("c", 11), ("d", 5), ("x", 12)]


def test_first_keys_when_nothing_exists(spark, rows):
    existing = spark.createDataFrame([], "k string, sk long")
    assert rows(keys.assign_keys(spark.createDataFrame([("b",), ("a",)], "k string"), existing, "sk", "k"), "k", "sk") == [("a", 1), ("b", 2)]


def _versions(spark):
    first = spark.createDataFrame([("p1", "A", "x"), ("p2", "B", "x"), ("p3", None, "x"), ("p4", "D", "x")], "id string, city string, note string")
    dim = scd.scd2_init(first, "id", "sk", "2020-01-01 00:00:00")
    # p1 changed, p2 differs only in an untracked column, p3 NULL -> value, p4 unchanged, p5 new
    now = spark.createDataFrame([("p1", "Z", "x"), ("p2", "B", "y"), ("p3", "C", "x"), ("p4", "D", "x"), ("p5", "E", "x")], "id string, city string, note string")
    return dim, now


def test_merge_keeps_history(spark, rows):
    dim, now = _versions(spark)
    merged = scd.scd2_merge(now, dim, "id", ["city"], "sk", "2020-02-01 00:00:00")
    got = rows(merged.withColumn("ended", F.col("effective_end_date").isNotNull()), "id", "city", "sk", "is_current", "ended")
    assert got == sorted([("p1", "A", 1, 0, True), ("p1", "Z", 5, 1, False), ("p2", "B", 2, 1, False), ("p3", None, 3, 0, True), ("p3", "C", 6, 1, False),
                          ("p4", "D", 4, 1, False), ("p5", "E", 7, 1, False)], key=repr)


def test_merge_twice_changes_nothing(spark, rows):
    dim, now = _versions(spark)
    once = scd.scd2_merge(now, dim, "id", ["city"], "sk", "2020-02-01 00:00:00")
    again = scd.scd2_merge(now, once, "id", ["city"], "sk", "2020-03-01 00:00:00")
    assert rows(once) == rows(again)


def test_upsert_updates_and_inserts(spark, rows):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "id string, sk long, status string")
    src = spark.createDataFrame([("b", 99, None), ("c", 3, "new")], "id string, sk long, status string")
    once = scd.upsert(target, src, "id", ["sk"])
    assert rows(once) == [("a", 1, "old"), ("b", 2, None), ("c", 3, "new")]
    assert rows(scd.upsert(once, src, "id", ["sk"])) == rows(once)


def test_duplicate_keys_are_found_and_rebuilt(spark, rows):
    target = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "id string, v string")
    assert rows(scd.dup_keys(target, ["id"])) == [("a", 2)]
    src = spark.createDataFrame([("a", "9")], "id string, v string")
    assert rows(scd.rebuild_if_duplicated(target, src, "id", [])) == [("a", "9"), ("b", "3")]


def test_latest_load_wins_and_equal_rows_collapse(spark, rows):
    df = spark.createDataFrame([("a", "2020-01-01", "old"), ("a", "2020-02-01", "new"), ("b", "2020-01-01", "x"), ("b", "2020-01-01", "x"), ("c", None, "n")], "id string, ts string, v string")
    assert rows(latest.dedup_latest(df, ["id"], ["ts"])) == [("a", "2020-02-01", "new"), ("b", "2020-01-01", "x"), ("c", None, "n")]


def test_latest_is_picked_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as ts", "id as tie")
    plan = latest.latest_by(df, ["k"], "ts", "tie")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
