"""Aggregate tables over the facts. Money sums are exact, rates are ratios of sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.ods import as_date
from wardlight.operators.scores import tier


def mean_score(col: str) -> Column:
    """Mean of a score or rate, to six places."""
    return s.rounded(F.avg(col), 6)


def quantile(col: str, p: float) -> Column:
    """Exact: the least value that a share p of the rows does not exceed.

    Rows are counted per distinct value before the shuffle. The columns are days, minutes, seconds
    and rounded scores, so what a group holds is bounded by their range, not by its rows.
    """
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {col})")


def _category_counts(col: str) -> list[Column]:
    return [F.count_if(F.col(col) == c).alias(f"{c.lower()}_risk_count") for c in ("High", "Medium", "Low")]


def _sum_if(cond: Column, col: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0)).cast("double")


def _payer_names(payer: DataFrame) -> DataFrame:
    return payer.select("payer_key", "payer_name", "payer_type")


def agg_readmission(fe: DataFrame) -> DataFrame:
    return fe.groupBy("encounter_date_key", "encounter_type").agg(
        F.count(F.lit(1)).alias("total_encounters"), *_category_counts("readmission_risk_category"),
        mean_score("readmission_risk_score").alias("avg_risk_score"), F.count_if(F.col("readmission_flag") == 1).alias("actual_readmissions"),
        s.total("total_charges").alias("total_charges"), mean_score("length_of_stay").alias("avg_length_of_stay"))


def agg_denial_date(fc: DataFrame) -> DataFrame:
    return fc.groupBy("claim_date_key", "claim_type").agg(
        F.count(F.lit(1)).alias("total_claims"), *_category_counts("denial_risk_category"),
        mean_score("denial_risk_score").alias("avg_risk_score"), F.count_if(F.col("denial_flag") == 1).alias("actual_denials"),
        s.total("billed_amount").alias("total_billed"), s.total("paid_amount").alias("total_paid"),
        _sum_if(F.col("denial_risk_category") == "High", "billed_amount").alias("at_risk_amount"))


def agg_denial_payer(fc: DataFrame, payer: DataFrame) -> DataFrame:
    denied = F.col("denial_flag") == 1
    grouped = fc.join(_payer_names(payer), "payer_key", "left").groupBy("claim_date_key", "payer_name", "payer_type", "primary_denial_reason").agg(
        F.count(F.lit(1)).alias("total_claims"), F.count_if(denied).alias("denied_claims"), s.total("billed_amount").alias("total_billed"),
        _sum_if(denied, "billed_amount").alias("denied_amount"), s.total("paid_amount").alias("total_paid"),
        mean_score("denial_risk_score").alias("avg_denial_risk_score"))
    return grouped.withColumn("denial_rate", s.ratio(F.col("denied_claims"), F.col("total_claims")))


def agg_drg(fe: DataFrame) -> DataFrame:
    money = {"charges": "total_charges", "cost_to_deliver": "total_cost", "expected_reimbursement": "expected_reimbursement"}
    grouped = fe.filter(F.col("drg_code").isNotNull()).groupBy("drg_code", "drg_description").agg(
        F.count(F.lit(1)).alias("encounter_count"), *[s.mean_money(c).alias(f"avg_{n}") for n, c in money.items()],
        mean_score("drg_weight").alias("avg_drg_weight"), mean_score("length_of_stay").alias("avg_los"),
        *[s.total(c).alias(f"total_{n}") for n, c in money.items()])
    margin = F.col("avg_expected_reimbursement") - F.col("avg_cost_to_deliver")
    pct = F.when(F.col("avg_cost_to_deliver") > 0, margin / F.col("avg_cost_to_deliver") * 100).otherwise(F.lit(0.0))
    return grouped.withColumns({"margin_per_case": s.rounded(margin, 4), "margin_pct": s.rounded(pct, 6)})


def agg_ar(fc: DataFrame, payer: DataFrame) -> DataFrame:
    rows = fc.filter(F.col("days_to_payment").isNotNull()).join(_payer_names(payer), "payer_key", "left")
    return rows.groupBy("claim_date_key", "payer_name", "payer_type").agg(
        F.count(F.lit(1)).alias("claim_count"), mean_score("days_to_payment").alias("avg_days_to_payment"),
        quantile("days_to_payment", 0.5).alias("median_days_to_payment"), quantile("days_to_payment", 0.9).alias("p90_days_to_payment"),
        s.total("billed_amount").alias("total_billed"), s.total("paid_amount").alias("total_paid"),
        mean_score("net_collection_rate").alias("avg_net_collection_rate"))


def agg_appeals(fc: DataFrame, payer: DataFrame) -> DataFrame:
    rows = fc.filter(F.col("appeal_outcome").isNotNull()).join(_payer_names(payer), "payer_key", "left")
    return rows.groupBy("payer_name", F.col("primary_denial_reason").alias("denial_reason"), "appeal_outcome").agg(
        F.count(F.lit(1)).alias("appeal_count"), s.total("billed_amount").alias("total_billed"),
        s.total("appeal_amount_recovered").alias("total_amount_recovered"), s.mean_money("appeal_amount_recovered").alias("avg_amount_recovered"))


def agg_mlr(premium: DataFrame, claims: DataFrame, payer: DataFrame) -> DataFrame:
    """Premium and claim payments per payer and month; months with only one side stay.

    Rows without a known payer match nothing and stay on their own side.
    """
    collected = premium.groupBy("payer_key", "year_month").agg(s.total("premium_amount").alias("premium_collected"))
    paid = claims.withColumn("year_month", s.ym_label("claim_date_key")).groupBy("payer_key", "year_month").agg(
        s.total("paid_amount").alias("medical_paid"), s.total("billed_amount").alias("billed"), F.count(F.lit(1)).alias("claim_count"))
    joined = collected.join(paid, ["payer_key", "year_month"], "full_outer")
    named = joined.join(payer.select("payer_key", "payer_id", "payer_name", "payer_type"), "payer_key", "left")
    return named.withColumn("mlr_pct", F.when(F.col("premium_collected") > 0, s.ratio(F.col("medical_paid"), F.col("premium_collected"))))


def agg_hedis(hedis: DataFrame, payer: DataFrame, plan: DataFrame) -> DataFrame:
    joined = hedis.join(payer.select("payer_id", "payer_key"), "payer_id", "left").join(plan.select("plan_id", "plan_key"), "plan_id", "left")
    return joined.select("compliance_id", "measurement_year", "payer_key", "plan_key", "measure_id", "measure_name",
                         "denominator_eligible", "numerator_met", "compliance_rate")


def agg_star(star: DataFrame, payer: DataFrame) -> DataFrame:
    return star.join(payer.select("payer_id", "payer_key"), "payer_id", "left").select(
        "star_id", "payer_key", "measurement_year", "star_measure_id", "star_measure_name", "domain", "weight", "star_score", "weighted_score", "national_avg")


def agg_star_overall(star: DataFrame) -> DataFrame:
    return star.groupBy("payer_key", "measurement_year").agg(
        s.rounded(s.ratio(F.sum("weighted_score"), F.sum("weight")), 6).alias("overall_star_score"),
        F.sum("weight").alias("total_weight"), F.count(F.lit(1)).alias("measure_count"))


def agg_raf(raf: DataFrame, patient: DataFrame, payer: DataFrame, plan: DataFrame) -> DataFrame:
    people = patient.filter(F.col("is_current") == 1).select(F.col("patient_id").alias("member_id"), F.col("patient_key").alias("member_key"))
    joined = raf.join(people, "member_id", "left").join(payer.select("payer_id", "payer_key"), "payer_id", "left").join(plan.select("plan_id", "plan_key"), "plan_id", "left")
    return joined.select("raf_id", "member_key", "payer_key", "plan_key", "measurement_year", "hcc_count", "hcc_codes", "demographic_score", "disease_score", "raf_score")


# --- adherence --------------------------------------------------------------------------

def pdc_category(score: Column) -> Column:
    return tier(score, (0.80, "Adherent"), (0.50, "Partially Adherent"), otherwise="Non-Adherent")


def pdc(rx: DataFrame, med: DataFrame) -> DataFrame:
    """Days covered per patient and drug; the period runs from first to last fill plus all supply."""
    drugs = med.select("medication_key", "drug_class", "therapeutic_area", F.col("is_chronic").alias("is_chronic"))
    known = rx.filter(F.col("patient_key").isNotNull() & F.col("medication_key").isNotNull() & F.col("fill_date_key").isNotNull())
    fills = known.join(drugs, "medication_key").withColumn("full_date", s.date_of_key("fill_date_key"))
    grouped = fills.groupBy("patient_key", "medication_key", "drug_class", "therapeutic_area").agg(
        F.datediff(F.max("full_date"), F.min("full_date")).alias("_span"),
        F.min("fill_date_key").alias("measurement_period_start"), F.max("fill_date_key").alias("measurement_period_end"),
        F.count(F.lit(1)).alias("total_fills"), F.sum("days_supply").alias("total_days_supply"),
        s.total("total_cost").alias("total_medication_cost"), s.total("payer_paid").alias("total_payer_cost"),
        s.total("patient_copay").alias("total_patient_cost"), F.max("is_chronic").alias("is_chronic"))
    supply, period = F.col("total_days_supply"), F.col("days_in_period")
    span = F.col("_span") + supply
    df = grouped.withColumn("days_in_period", F.when(span <= 0, supply).otherwise(span))
    df = df.withColumn("covered_days", F.least(supply, period))
    share = F.when(period > 0, s.ratio(F.col("covered_days"), period)).otherwise(F.lit(1.0))
    df = df.withColumn("pdc_score", F.least(share, F.lit(1.0)))
    return df.withColumns({
        "adherence_category": pdc_category(F.col("pdc_score")), "gap_days": F.greatest(period - F.col("covered_days"), F.lit(0)),
        "adherence_key": (F.col("patient_key") * 100000 + F.col("medication_key")).cast("bigint"),
    }).drop("_span")


def pdc_exact(rx: DataFrame, period_end: str | Column, fill: str = "fill_date", keys: tuple[str, ...] = ("patient_key", "medication_key")) -> DataFrame:
    """Days covered without counting overlapping supply twice, from first fill to period end.

    Fills of a day are merged first, so a group holds at most one row per day. A fill
    covers the days after the furthest end of all earlier fills.
    """
    end = as_date(period_end)
    daily = rx.groupBy(*keys, F.col(fill).alias("_start")).agg(F.max("days_supply").alias("_days"))
    daily = daily.withColumn("_end", F.least(F.date_add("_start", F.col("_days") - 1), end)).filter(F.col("_start") <= end)
    earlier = Window.partitionBy(*keys).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("_end").over(earlier)
    begin = F.greatest(F.col("_start"), F.date_add(F.coalesce(reach, F.date_sub("_start", 1)), 1))
    covered = F.greatest(F.datediff("_end", begin) + 1, F.lit(0))
    grouped = daily.withColumn("_covered", covered).groupBy(*keys).agg(
        F.min("_start").alias("first_fill_date"), F.sum("_covered").alias("covered_days"))
    grouped = grouped.withColumn("days_in_period", F.datediff(end, F.col("first_fill_date")) + 1)
    scored = grouped.withColumn("pdc_score", s.ratio(F.col("covered_days"), F.col("days_in_period")))
    return scored.withColumn("adherence_category", pdc_category(F.col("pdc_score")))


# --- bedside and alert facts ----------------------------------------------------------------

def vitals_hourly(readings: DataFrame) -> DataFrame:
    """Readings per patient and hour. A reading is critical by oxygen, pulse or pressure."""
    critical = (F.col("spo2") < 90) | (F.col("heart_rate") > 130) | (F.col("heart_rate") < 40) | (F.col("bp_systolic") > 180)
    grouped = readings.groupBy("patient_id", "location_id", s.date_key("reading_ts").alias("date_key"), F.hour("reading_ts").alias("hour_of_day")).agg(
        mean_score("heart_rate").alias("avg_heart_rate"), F.max("heart_rate").alias("max_heart_rate"), F.min("heart_rate").alias("min_heart_rate"),
        mean_score("bp_systolic").alias("avg_bp_systolic"), F.max("bp_systolic").alias("max_bp_systolic"), mean_score("bp_diastolic").alias("avg_bp_diastolic"),
        mean_score("spo2").alias("avg_spo2"), F.min("spo2").alias("min_spo2"), mean_score("temperature").alias("avg_temperature"), F.max("temperature").alias("max_temperature"),
        mean_score("respiratory_rate").alias("avg_respiratory_rate"), mean_score("risk_score").alias("avg_risk_score"), F.max("risk_score").alias("max_risk_score"),
        F.count_if(critical).alias("critical_reading_count"), F.count(F.lit(1)).alias("reading_count"))
    return grouped.withColumn("risk_flag", tier(F.col("max_risk_score"), (70, "High"), (40, "Medium"), otherwise="Low"))


def severity_rank(col: Column) -> Column:
    return F.when(col == "CRITICAL", 1).when(col == "HIGH", 2).when(col == "MEDIUM", 3).otherwise(4)


def alert_facts(alerts: DataFrame, closures: DataFrame) -> DataFrame:
    """Alerts with the first response and the minutes until it came."""
    first = closures.groupBy("alert_id").agg(F.min("closure_timestamp").alias("acknowledged_at"),
                                             F.min_by("resolved_by", F.struct("closure_timestamp", "closure_id")).alias("acknowledged_by"))
    seconds = F.timestamp_diff("SECOND", F.col("alert_timestamp"), F.col("acknowledged_at"))
    return alerts.join(first, "alert_id", "left").select(
        "alert_id", "patient_id", s.date_key("alert_timestamp").alias("date_key"), F.hour("alert_timestamp").alias("alert_hour"),
        F.col("alert_type").alias("alert_code"), "severity", severity_rank(F.col("severity")).alias("severity_rank"), F.col("score").alias("measured_value"),
        F.when(F.col("acknowledged_at").isNotNull(), 1).otherwise(0).alias("was_acknowledged"), "acknowledged_by", "acknowledged_at",
        s.rounded(seconds / F.lit(60.0), 4).alias("response_time_minutes"))


# --- finance questions with a shape of their own ------------------------------------------------

def ar_aging(fc: DataFrame, payer: DataFrame) -> DataFrame:
    """Claims and dollars by days to payment: 0-30, 31-60, 61-90, over 90, unknown."""
    days = F.col("days_to_payment")
    bucket = (F.when(days.isNull(), "unknown").when(days <= 30, "0-30").when(days <= 60, "31-60").when(days <= 90, "61-90").otherwise("90+"))
    return fc.join(_payer_names(payer), "payer_key", "left").groupBy(bucket.alias("age_bucket"), "payer_name").agg(
        F.count(F.lit(1)).alias("claim_count"), s.total("billed_amount").alias("total_billed"))


def expiring_contracts(contracts: DataFrame, as_of: str | Column, days: int) -> DataFrame:
    day = as_date(as_of)
    return contracts.filter(F.col("termination_date").between(day, F.date_add(day, days)))


def pa_outliers(auths: DataFrame, min_n: int) -> DataFrame:
    """Authorization denial rate of clinicians with enough decisions."""
    decided = auths.filter(F.coalesce(F.col("auth_outcome"), F.lit("")) != "")
    grouped = decided.groupBy("provider_key").agg(F.count(F.lit(1)).alias("decided"), F.count_if(F.col("auth_outcome") == "Denied").alias("denied"))
    return grouped.filter(F.col("decided") >= min_n).withColumn("denial_rate", s.ratio(F.col("denied"), F.col("decided")))


def payer_mix(fc: DataFrame, payer: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Claims and dollars per payer type with their share (of each month, if given)."""
    by = by or []
    grouped = fc.join(_payer_names(payer), "payer_key", "left").groupBy(*by, "payer_type").agg(
        F.count(F.lit(1)).alias("claim_count"), s.total("billed_amount").alias("total_billed"), s.total("paid_amount").alias("total_paid"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    return grouped.withColumns({"claim_share": s.rounded(s.ratio(F.col("claim_count"), F.sum("claim_count").over(whole)), 6),
                                "billed_share": s.rounded(s.ratio(F.col("total_billed"), F.sum("total_billed").over(whole)), 6)})
