"""Rows with missing keys, ids or times stay; queries read the given tables."""

import pytest
from pyspark.sql import functions as F

from wardlight.operators import events, fraud, highcost, scd

CLAIM = "event_id string, claim_id string, patient_id string, provider_id string, event_timestamp timestamp, claim_amount double, latitude double, longitude double"


@pytest.fixture(scope="module")
def claims(spark):
    rows = [("e1", "c1", None, None, "2024-01-01 10:00:00", 10.0), ("e2", "c2", None, None, "2024-01-01 10:10:00", 5.0), ("e3", "c3", "p", "d", None, 7.0), ("e4", "c4", "p", "d", "2024-01-02 00:00:00", 1.0)]
    typed = spark.createDataFrame([(*r, 0.0, 0.0) for r in rows], CLAIM.replace("timestamp timestamp", "timestamp string"))
    return typed.withColumn("event_timestamp", F.to_timestamp("event_timestamp"))


def test_velocity_keeps_claims_without_provider(claims, rows):
    assert rows(fraud.velocity_score(claims), "event_id", "claims_in_window") == [("e1", 1), ("e2", 2), ("e3", 0), ("e4", 1)]


def test_spend_keeps_claims_without_patient_or_time(claims, rows):
    assert rows(highcost.rolling_spend(claims), "event_id", "rolling_spend_30d") == [("e1", 10.0), ("e2", 15.0), ("e3", 0.0), ("e4", 1.0)]
    assert rows(highcost.latest_spend(claims), "patient_id", "rolling_spend_30d") == [("p", 1.0), (None, 15.0)] or rows(highcost.latest_spend(claims), "patient_id", "rolling_spend_30d") == [(None, 15.0), ("p", 1.0)]


def test_rebuild_keeps_duplicated_keys_the_source_lacks(spark, rows):
    target = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "old"), ("b", "older")], "k string, v string")
    src = spark.createDataFrame([("b", "new")], "k string, v string")
    assert rows(scd.rebuild_if_duplicated(target, src, "k", [])) == [("a", "y"), ("b", "new")]


def test_events_without_id_stay_and_the_last_arrival_counts(spark, rows):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), ("e", 1, "first"), ("e", 2, "last")], "event_id string, ingest_ts int, body string")
    assert rows(events.dedup_events(df), "event_id", "body") == [("e", "last"), (None, "a"), (None, "a")]
