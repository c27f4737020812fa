"""Rule boundaries on hand-built rows."""

import pytest
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import aggregates as agg
from wardlight.operators import alerts, caregaps, ods, quality, scores, views
from wardlight.operators.silver import clean_claims, clean_patients

NOW = "2024-01-01 12:00:00"


def test_scalars(spark):
    row = spark.createDataFrame([(" ann LEE ", "f", "00501-", "2024-13-01", "x", " Bob@X.ORG ")], "n string, g string, z string, d string, m string, e string").select(
        s.proper("n"), s.norm_gender("g"), s.digits("z"), s.to_d("d"), s.money("m"), s.email("e")).first()
    assert tuple(row) == ("Ann Lee", "Female", "00501", None, None, "bob@x.org")


@pytest.mark.parametrize(("day", "fiscal_year", "fiscal_quarter"), [("2024-06-30", 2024, 4), ("2024-07-01", 2025, 1), ("2024-02-29", 2024, 3), ("2023-12-31", 2024, 2)])
def test_fiscal_calendar(spark, day, fiscal_year, fiscal_quarter):
    from wardlight.operators.dims import dim_date

    facts = spark.createDataFrame([(day,)], "day string").select(F.to_date("day").alias("day"))
    row = dim_date(facts, "day").filter(F.col("full_date") == F.lit(day)).first()
    assert (row["fiscal_year"], row["fiscal_quarter"], row["date_key"]) == (fiscal_year, fiscal_quarter, int(day.replace("-", "")))


def test_denial_risk_by_amount(spark, rows):
    amounts = [0, None, 10000, 10000.01, 20000, 20000.01, 50000, 50000.01]
    df = spark.createDataFrame([(str(i), None if a is None else float(a)) for i, a in enumerate(amounts)], "id string, x double").select(
        "id", F.col("x").cast("decimal(18,2)").alias("billed_amount"), F.lit("Paid").alias("claim_status"))
    scored = scores.denial_risk(scores.assign_denial(df, "id", "billed_amount", hashed=False))
    assert [r[1] for r in rows(scored, "id", "denial_risk_score")] == [0.15, 0.15, 0.15, 0.30, 0.30, 0.40, 0.40, 0.55]


def test_payment_ratio_of_zero_and_missing_bills(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('a', 0, 5), ('b', null, 5), ('c', 10, null), ('d', 3, 1) AS t(claim_id, b, p)").select(
        "claim_id", F.col("b").cast("decimal(18,2)").alias("billed_amount"), F.col("p").cast("decimal(18,2)").alias("paid_amount"), F.to_date(F.lit("2020-01-01")).alias("claim_date"), F.lit("P").alias("payer_id"))
    payers = spark.createDataFrame([("P", "Payer", "Commercial")], "payer_id string, payer_name string, payer_type string")
    assert rows(ods.enrich_claims(df, payers, "2020-01-31"), "claim_id", "payment_ratio", "claim_age_days") == [("a", 0.0, 30), ("b", 0.0, 30), ("c", None, 30), ("d", 0.3333, 30)]


def test_payment_before_claim_is_found(spark):
    df = spark.createDataFrame([("1", "2020-01-02", "2020-01-01"), ("2", "2020-01-01", None), ("3", "2020-01-01", "2020-01-01")], "claim_id string, a string, b string")
    found = quality.dq_order(df.select(F.to_date("a").alias("claim_date"), F.to_date("b").alias("payment_date")), "claim_date", "payment_date").first()
    assert (found["row_count"], found["violations"]) == (3, 1)


def test_hard_checks_raise(spark):
    df = spark.createDataFrame([(None,), ("x",)], "k string")
    with pytest.raises(Exception, match="k_not_null"):
        quality.fail_if(quality.dq_not_null(df, ["k"])).collect()


def _fills(spark, fills):
    rx = spark.createDataFrame(fills, "patient_key long, medication_key long, fill_date_key int, days_supply int").withColumns(
        {c: F.lit(1).cast("decimal(18,2)") for c in ("total_cost", "payer_paid", "patient_copay")})
    med = spark.createDataFrame([(1, "C", "T", 1)], "medication_key long, drug_class string, therapeutic_area string, is_chronic int")
    return {r["patient_key"]: r for r in agg.pdc(rx, med).collect()}


def test_adherence_limits(spark):
    got = _fills(spark, [(1, 1, 20240101, 30), (2, 1, 20240101, 10), (2, 1, 20240105, 10), (3, 1, 20240101, 10), (3, 1, 20240121, 10), (4, 1, 20240101, 40), (4, 1, 20240121, 40), (5, 1, 20240101, 5), (5, 1, 20240101, 5)])
    assert (got[1]["pdc_score"], got[1]["adherence_category"]) == (1.0, "Adherent")
    assert (got[2]["days_in_period"], got[2]["covered_days"], got[2]["gap_days"]) == (24, 20, 4)
    assert (got[3]["pdc_score"], got[3]["adherence_category"]) == (0.5, "Partially Adherent")
    assert (got[4]["pdc_score"], got[4]["adherence_category"]) == (0.8, "Adherent")
    assert got[5]["pdc_score"] == 1.0


def test_loss_ratio_with_one_side_only(spark, rows):
    premium = spark.createDataFrame([(1, "2024-01", 100.0), (1, "2024-02", 0.0)], "payer_key long, year_month string, premium_amount double").withColumn("premium_amount", F.col("premium_amount").cast("decimal(18,2)"))
    claims = spark.createDataFrame([(1, 20240115, 50.0), (1, 20240215, 7.0), (1, 20240315, 9.0)], "payer_key long, claim_date_key int, x double").select(
        "payer_key", "claim_date_key", F.col("x").cast("decimal(18,2)").alias("paid_amount"), F.col("x").cast("decimal(18,2)").alias("billed_amount"))
    payer = spark.createDataFrame([(1, "P1", "Payer", "Commercial")], "payer_key long, payer_id string, payer_name string, payer_type string")
    assert rows(agg.agg_mlr(premium, claims, payer), "year_month", "premium_collected", "mlr_pct") == [("2024-01", 100.0, 0.5), ("2024-02", 0.0, None), ("2024-03", None, None)]


def _adjudications(spark, payer, denied, total):
    return [(f"{payer}{i}", payer, payer, "DENIED" if i < denied else "PAID", "Coding" if i % 2 else "Auth", 10.0) for i in range(total)]


def test_denial_spike_limits(spark, rows):
    data = [*_adjudications(spark, "p19", 10, 19), *_adjudications(spark, "p12", 12, 100), *_adjudications(spark, "p13", 13, 100), *_adjudications(spark, "p15", 15, 100), *_adjudications(spark, "p20", 20, 100)]
    df = spark.createDataFrame(data, "event_id string, payer_id string, payer_name string, adjudication_result string, denial_reason string, billed_amount double").withColumn("event_timestamp", F.to_timestamp(F.lit("2024-01-01 11:30:00")))
    got = rows(alerts.denial_spikes(df, NOW), "payer_id", "severity", "denial_reason")
    # 19 claims are too few, a rate of exactly .12 is no spike, equal counts go to the first name
    assert got == [("p13", "MEDIUM", "Auth"), ("p15", "HIGH", "Auth"), ("p20", "CRITICAL", "Auth")]


def test_authorization_limits(spark, rows):
    data = [("a0", "APPROVED", 0), ("a1", "APPROVED", 1), ("a7", "APPROVED", 7), ("a8", "APPROVED", 8), ("s30", "EXPIRING_SOON", 30), ("p2", "PENDING", 2), ("a3", "APPROVED", 3)]
    df = spark.createDataFrame([(k, k, st, d, 100.0, "", "", "", "", "") for k, st, d in data],
                               "event_id string, auth_id string, auth_status string, days_until_expiry int, estimated_charge double, payer_id string, payer_name string, patient_id string, procedure_code string, scheduled_procedure_date string")
    got = rows(alerts.auth_expiring(df.withColumn("event_timestamp", F.to_timestamp(F.lit(NOW)))), "claim_id", "severity")
    assert got == [("a1", "CRITICAL"), ("a3", "HIGH"), ("a7", "MEDIUM"), ("s30", "MEDIUM")]


def test_quality_drift_limits(spark, rows):
    data = [("l130", 1.30, "lower_is_better"), ("l131", 1.31, "lower_is_better"), ("l115", 1.15, "lower_is_better"), ("l116", 1.16, "lower_is_better"),
            ("h85", 0.85, "higher_is_better"), ("h84", 0.84, "higher_is_better"), ("h70", 0.70, "higher_is_better"), ("h69", 0.69, "higher_is_better")]
    df = spark.createDataFrame([(k, k, "m", v, 1.0, d) for k, v, d in data] + [("zero", "zero", "m", 9.0, 0.0, "lower_is_better")],
                               "event_id string, provider_id string, metric_name string, metric_value double, benchmark_value double, direction string").withColumns(
        {"event_timestamp": F.to_timestamp(F.lit(NOW)), "provider_name": F.lit("x"), "specialty": F.lit("y"), "facility_id": F.lit("f"), "denominator": F.lit(1)})
    assert rows(alerts.quality_drift(df), "provider_id", "severity") == [("h69", "CRITICAL"), ("h70", "HIGH"), ("h84", "HIGH"), ("l116", "HIGH"), ("l130", "HIGH"), ("l131", "CRITICAL")]


def _view_rows(spark, pairs):
    return spark.createDataFrame([(f"a{i}", p, t, 1.0, "txt") for i, (p, t) in enumerate(pairs)], "alert_id string, patient_id string, source_table string, score double, alert_text string").withColumn(
        "alert_timestamp", F.to_timestamp(F.lit("2024-01-01 11:00:00")))


def test_patients_of_several_streams(spark, rows):
    df = _view_rows(spark, [("one", "f"), ("one", "f"), ("two", "f"), ("two", "g"), ("three", "f"), ("three", "g"), ("three", "h"), ("three", "h")])
    got = rows(views.cross_stream_patients(df, NOW), "patient_id", "stream_count", "total_alerts", "severity_rank", "streams")
    assert got == [("three", 3, 4, "CRITICAL", "f, g, h"), ("two", 2, 2, "HIGH", "f, g")]


def test_closures_none_acknowledged_resolved_both_twice(spark, rows):
    alerts_ = spark.createDataFrame([(k, "CMO", "T") for k in ("none", "ack", "done", "both", "twice")], "alert_id string, persona string, alert_type string").withColumn(
        "alert_timestamp", F.to_timestamp(F.lit("2024-01-01 10:00:30")))
    data = [("ack", "ACKNOWLEDGED", "2024-01-01 10:05:10"), ("done", "RESOLVED", "2024-01-01 10:10:00"), ("both", "ACKNOWLEDGED", "2024-01-01 10:01:00"), ("both", "RESOLVED", "2024-01-01 10:20:00"),
            ("twice", "RESOLVED", "2024-01-01 10:40:00"), ("twice", "RESOLVED", "2024-01-01 10:30:00")]
    closures = spark.createDataFrame(data, "alert_id string, action_taken string, at string").withColumn("closure_timestamp", F.to_timestamp("at"))
    row = views.mttr_summary(alerts_, closures, NOW).first()
    assert (row["open_count"], row["ack_count"], row["resolved_count"]) == (1, 1, 3)
    # minute boundaries crossed: 10:00:30 -> 10:01:00 is one
    assert (row["p50_ack_minutes"], row["p90_close_minutes"], row["avg_close_minutes"]) == (1, 30, 20.0)


def test_care_gap_priorities_and_missing_names(spark, rows):
    adt = spark.createDataFrame([("e1", "ADMIT", "p1"), ("e2", "DISCHARGE", "p1"), ("e3", "OBSERVATION", "p2")], "event_id string, event_type string, patient_id string").withColumns(
        {"event_timestamp": F.to_timestamp(F.lit(NOW)), "facility_id": F.lit("F"), "admission_type": F.lit("x"), "primary_diagnosis": F.lit("y"), "facility_name": F.lit("n"), "latitude": F.lit(1.0), "longitude": F.lit(1.0)})
    gaps = spark.createDataFrame([("p1", "CDC", "Diabetes", "True", "181"), ("p1", "OMW", None, "true", "366"), ("p1", "SPC", "S", "true", "31"), ("p1", "PPC", "P", "False", "999"), ("p2", "CBP", "B", "True", "x")],
                                 "patient_id string, measure_id string, measure_name string, is_gap_open string, gap_days_overdue string")
    people = spark.createDataFrame([("p1", "Ann", None, 1)], "patient_id string, first_name string, last_name string, is_current int")
    places = spark.createDataFrame([], "facility_id string, facility_name string, latitude double, longitude double")
    got = caregaps.care_gap_alerts(adt, gaps, people, places)
    assert rows(got, "event_id", "measure_id", "measure_name", "alert_priority", "facility_name") == [
        ("e1", "CDC", "Diabetes", "CRITICAL", "Unknown"), ("e1", "OMW", "OMW", "CRITICAL", "Unknown"), ("e1", "SPC", "S", "MEDIUM", "Unknown"), ("e3", "CBP", "B", "LOW", "Unknown")]
    assert all(r[0] for r in rows(got, "alert_text"))


def test_alert_ids_repeat(spark, rows):
    df = spark.createDataFrame([("e1",)], "event_id string")
    assert rows(df.select(s.content_id("FRAUD", F.col("event_id")))) == rows(df.select(s.content_id("FRAUD", F.col("event_id"))))


def test_cleaning_keeps_the_later_load(spark, rows):
    raw = spark.createDataFrame([("p", "a", "1", "2020-01-01"), ("p", "b", "2", "2020-02-01")], "patient_id string, first_name string, zip_code string, _bronze_load_timestamp string")
    assert rows(clean_patients(raw), "patient_id", "first_name", "zip_code") == [("p", "B", "2")]


def test_bad_numbers_become_null(spark):
    raw = spark.createDataFrame([("c", "12,5", "abc", "2020-01-01", "2020-01-02")], "claim_id string, billed_amount string, denial_flag string, submit_date string, process_date string")
    row = clean_claims(raw).first()
    assert (row["billed_amount"], row["denial_flag"]) == (None, 0)


def test_rounding_does_not_depend_on_binary_noise(spark):
    row = spark.sql("SELECT 231.27D / 2 AS a, 0.1D + 0.2D AS b, 2.5D AS c, -2.5D AS d").select(s.rounded("a", 2), s.rounded("b", 16), s.rounded("c", 0), s.rounded("d", 0)).first()
    assert tuple(row) == (115.64, 0.3, 3.0, -3.0)
