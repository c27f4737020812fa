"""Trailing sums, previous instants, running totals: boundaries, hot keys, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import drift, fraud, highcost
from wardlight.operators.aggregates import pdc_exact
from wardlight.operators.scans import DAY, Trailing, previous_instant, running_by_value, trailing


def _brute(points, seconds):
    return sorted({(k, t, sum(v for k2, t2, v in points if k2 == k and t - seconds <= t2 <= t)) for k, t, _ in points}, key=repr)


def test_trailing_sum_equals_brute_force_with_a_hot_key(spark, rows):
    rnd = random.Random(3)
    # a third of all rows belongs to one key, many of them to one instant
    points = [("hot", 500_000 + rnd.choice([0, 0, 0, rnd.randint(0, 3 * DAY)]), rnd.randint(1, 9)) for _ in range(150)]
    points += [(f"k{rnd.randint(0, 9)}", rnd.randint(0, 5 * DAY), rnd.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame(points, "k string, t long, v long")
    for seconds in (0, 59, 3600, DAY, 2 * DAY):
        got = trailing(df, ["k"], "t", [Trailing("s", F.col("v"), seconds)], chunk=3600)
        assert rows(got, "k", "t", "s") == _brute(points, seconds)


def test_two_spans_in_one_pass(spark, rows):
    points = [("a", 0, 1), ("a", 30 * DAY, 2), ("a", 30 * DAY + 1, 4), ("a", 90 * DAY, 8), ("a", 90 * DAY + 1, 16)]
    df = spark.createDataFrame(points, "k string, t long, v long")
    got = trailing(df, ["k"], "t", [Trailing("m", F.col("v"), 30 * DAY), Trailing("q", F.col("v"), 90 * DAY)])
    # exactly 30 and 90 days apart still count
    assert rows(got, "t", "m", "q") == sorted([(0, 1, 1), (30 * DAY, 3, 3), (30 * DAY + 1, 6, 7), (90 * DAY, 8, 15), (90 * DAY + 1, 24, 30)], key=repr)


def _claims(spark, times, provider="p"):
    rows_ = [(f"e{i}", f"c{i}", provider, t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows_, "event_id string, claim_id string, provider_id string, at string").withColumn("event_timestamp", F.try_to_timestamp("at"))


def test_velocity_boundaries(spark, rows):
    base = [f"2024-01-01 10:00:{s:02d}" for s in (0, 0, 0, 0, 0)]  # five at one instant: no score yet
    df = _claims(spark, base + ["2024-01-01 11:00:00", "2024-01-01 11:00:01", "bad"])
    got = dict(rows(fraud.velocity_score(df), "event_id", "claims_in_window"))
    assert got == {"e0": 5, "e1": 5, "e2": 5, "e3": 5, "e4": 5, "e5": 6, "e6": 2, "e7": 0}
    scores = dict(rows(fraud.velocity_score(df), "event_id", "velocity_score"))
    assert (scores["e0"], scores["e5"]) == (0, 6)


def test_velocity_score_is_capped(spark, rows):
    df = _claims(spark, ["2024-01-01 10:00:00"] * 11)
    assert {r[0] for r in rows(fraud.velocity_score(df), "velocity_score")} == {30}


def test_amount_score_limits(spark, rows):
    data = [("a", 120.0, 100.0, 10.0), ("b", 145.0, 100.0, 10.0), ("c", 500.0, 100.0, 0.0), ("d", 500.0, 100.0, None), ("e", 121.0, 100.0, 10.0)]
    df = spark.createDataFrame(data, "id string, claim_amount double, hist_avg_amount double, hist_std_amount double")
    assert dict(rows(fraud.amount_score(df), "id", "amount_score")) == pytest.approx({"a": 0.0, "b": 25.0, "c": 0.0, "d": 0.0, "e": 1.0})


def test_readmissions_count_gaps_of_0_30_31_days(spark, rows):
    admits = [("a", "2024-01-01 08:00:00"), ("a", "2024-01-01 08:00:00"), ("b", "2024-01-01 23:00:00"), ("b", "2024-01-31 01:00:00"), ("c", "2024-01-01 00:00:00"),
              ("c", "2024-02-01 00:00:00"), ("d", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(admits, "patient_id string, at string").select("patient_id", F.lit("ADMIT").alias("event_type"), F.try_to_timestamp("at").alias("event_timestamp"))
    assert rows(highcost.readmissions(df)) == [("a", 1), ("b", 1), ("c", 0), ("d", 0)]


def test_previous_instant_crosses_empty_chunks(spark, rows):
    df = spark.sql("SELECT 'a' AS k, timestamp'2024-01-01' + make_interval(0,0,0,d) AS ts FROM VALUES (0),(0),(5),(40) AS t(d)")
    got = [(r[0].day, r[1], r[2] and r[2].day) for r in previous_instant(df, ["k"], "ts").select("ts", "n", "prev").orderBy("ts").collect()]
    assert got == [(1, 2, None), (6, 1, 1), (10, 1, 6)]


def test_running_totals_over_all_rows(spark, rows):
    values = list(range(500))
    random.Random(5).shuffle(values)
    df = spark.createDataFrame([(v, 1) for v in values], "v int, n int")
    assert rows(running_by_value(df, "v", ["n"]).orderBy("v"), "v", "run_n") == sorted([(v, v + 1) for v in values], key=repr)


def test_ks_and_psi_of_equal_samples_are_zero(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x")
    assert drift.ks(df, df, "x").first()["ks"] == 0.0
    assert drift.psi(df, df, "x", [25.0, 50.0]).first()["psi"] == 0.0
    shifted = spark.range(100).selectExpr("cast(id + 50 as double) as x")
    assert drift.ks(df, shifted, "x").first()["ks"] == 0.5


def test_days_covered_do_not_count_twice(spark, rows):
    fills = [("p", 1, "2024-01-01", 10), ("p", 1, "2024-01-06", 10), ("p", 1, "2024-01-06", 3), ("p", 2, "2024-01-01", 30), ("p", 2, "2024-01-11", 5), ("q", 1, "2024-01-30", 90)]
    df = spark.createDataFrame(fills, "patient_key string, medication_key int, f string, days_supply int").withColumn("fill_date", F.to_date("f"))
    got = rows(pdc_exact(df, "2024-01-31"), "patient_key", "medication_key", "covered_days", "days_in_period")
    # an inner fill adds nothing; supply after the period does not count
    assert got == [("p", 1, 15, 31), ("p", 2, 30, 31), ("q", 1, 2, 2)]
