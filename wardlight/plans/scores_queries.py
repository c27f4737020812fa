"""Queries for scores, aggregates and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import aggregates as agg
from wardlight.operators import drift, quality, scores
from wardlight.plans.registry import query
from wardlight.plans.warehouse import GOLD


@query("e01_readmission_risk")
def _(w):
    return scores.readmission_risk(w["encounters_clean"]).select("encounter_id", "readmission_risk_score", "readmission_flag", "readmission_risk_category")


@query("e02_readmission_score")
def _(w):
    return scores.readmission_score(w["encounters_clean"], w["ref_icd_codes"]).select("encounter_id", "readmission_score")


@query("e03_hashed_denials")
def _(w):
    marked = scores.assign_denial(w["claims_clean"], "claim_id", "billed_amount")
    return marked.select("claim_id", "claim_status", F.col("_is_denied").alias("is_denied"))


@query("e04_denial_risk")
def _(w):
    return scores.denial_risk(scores.assign_denial(w["claims_clean"], "claim_id", "billed_amount", hashed=False)).select("claim_id", "denial_risk_score", "denial_risk_category")


@query("e05_denial_score")
def _(w):
    return scores.denial_score(w["claims_enriched"]).select("claim_id", "denial_score", "denial_score_category")


@query("e06_denial_reason")
def _(w):
    marked = scores.denial_reason(scores.assign_denial(w["claims_clean"], "claim_id", "billed_amount"))
    return marked.filter("_is_denied").select("claim_id", "primary_denial_reason", "recommended_action")


@query("e07_payment_metrics")
def _(w):
    paid = scores.payment_metrics(w["claims_clean"].drop("days_to_payment", "net_collection_rate"))
    return paid.select("claim_id", "days_to_payment", s.rounded("net_collection_rate", 6).alias("net_collection_rate"))


@query("e08_vulnerability")
def _(w):
    return scores.svi_by_zip(w["ref_sdoh_zipcode"]).select("zip_code", "composite_svi_score", "risk_tier")


@query("e08_vulnerability_index")
def _(w):
    return scores.svi_index(w["sdoh_index_source"]).select("zip_code", "composite_svi_score", "risk_tier")


@query("e09_care_gap_eligible")
def _(w):
    return scores.care_gap_eligible(w["patients_clean"], w["diagnoses_clean"], w["hedis_measures"], w.as_of)


@query("e10_hedis_rollup")
def _(w):
    return scores.hedis_rollup(w["care_gaps"], w["member_enrollment_clean"], 2001)


@query("e11_raf_score")
def _(w):
    return scores.raf_score(w["patients_clean"], w["diagnoses_clean"], w["ref_hcc_codes"], w["member_enrollment_clean"], w.as_of)


@query("e12_drg_reimbursement")
def _(w):
    return scores.drg_reimbursement(w["encounters_clean"], w["ref_drg_codes"]).select("encounter_id", "drg_code", "drg_payment")


@query("e13_member_months")
def _(w):
    spans = w["orders"].groupBy(F.col("o_custkey").alias("member")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("coverage_from"), F.max(F.col("o_orderdate").cast("date")).alias("coverage_to"))
    return scores.member_months(spans)


@query("e14_latest_enrollment")
def _(w):
    return scores.latest_enrollment(w["member_enrollment_clean"])


@query("e15_revenue_variance")
def _(w):
    bare = w["net_revenue_variance_events"].drop("variance_dollars", "variance_pct")
    return scores.revenue_variance(bare).select("event_id", "expected_payment", "actual_payment", "variance_dollars", "variance_pct")


@query("e15_underpayments")
def _(w):
    return scores.underpayments(w["net_revenue_variance_events"]).select("event_id", "contract_type", "variance_pct", "variance_dollars")


@query("e16_staffing_gap")
def _(w):
    return scores.staffing_gap(w["staffing_acuity_events"]).select("event_id", "nurse_count", "patient_count", "acuity_score", "ratio_actual", "ratio_target", "staffing_gap")


@query("e17_rapid_response")
def _(w):
    return scores.rrt_flag(w["clinical_deterioration_events"]).select("event_id", "news2_score", "sirs_score", "deterioration_type", "requires_rrt")


@query("e17_hai_severity")
def _(w):
    return scores.hai_severity(w["mortality_hai_events"]).select("event_id", "cluster_size", "severity")


@query("e17_utilization")
def _(w):
    return scores.utilization(w["ops_capacity_events"]).select("event_id", "current_value", "threshold_value", "utilization_pct")


@query("e18_hrrp_penalty")
def _(w):
    return scores.hrrp_penalty(w["fact_encounter"], w["hrrp_expected"])


@query("e19_star_cutpoints")
def _(w):
    rated = scores.star_from_cutpoints(w["agg_star_rating"], ["star_measure_id", "measurement_year"], "star_score")
    return rated.select("star_id", "star_score", s.rounded("percentile", 6).alias("percentile"), "stars")


@query("e19_star_rollup")
def _(w):
    rated = scores.star_from_cutpoints(w["agg_star_rating"], ["star_measure_id", "measurement_year"], "star_score")
    return scores.star_rollup(rated, ["payer_key", "measurement_year"])


@query("e20_dq_violation")
def _(w):
    return scores.dq_violation(w["dq_violation_events"]).select("event_id", "expected_value", "actual_value", "violation_count", "violation_pct", "severity")


PSI_EDGES = [5000.0, 10000.0, 20000.0, 30000.0, 50000.0, 75000.0]


def _halves(w):
    fc = w["fact_claim"].select("claim_date_key", F.col("billed_amount").cast("double").alias("amount"))
    return fc.filter(F.col("claim_date_key") < 19980101), fc.filter(F.col("claim_date_key") >= 19980101)


@query("e21_psi")
def _(w):
    base, current = _halves(w)
    return drift.psi(base, current, "amount", PSI_EDGES)


@query("e21_ks")
def _(w):
    base, current = _halves(w)
    return drift.ks(base, current, "amount")


# --- aggregates ---------------------------------------------------------------------------------

_AGGREGATES = {
    "f01_readmission_by_date": lambda w: agg.agg_readmission(w["fact_encounter"]),
    "f02_denial_by_date": lambda w: agg.agg_denial_date(w["fact_claim"]),
    "f03_denial_by_payer": lambda w: agg.agg_denial_payer(w["fact_claim"], w["dim_payer"]),
    "f04_revenue_by_drg": lambda w: agg.agg_drg(w["fact_encounter"]),
    "f05_days_in_ar": lambda w: agg.agg_ar(w["fact_claim"], w["dim_payer"]),
    "f06_appeal_outcomes": lambda w: agg.agg_appeals(w["fact_claim"], w["dim_payer"]),
    "f07_mlr_by_payer_month": lambda w: agg.agg_mlr(w["fact_premium"], w["fact_claim"], w["dim_payer"]),
    "f08_hedis_compliance": lambda w: agg.agg_hedis(w["hedis_compliance_clean"], w["dim_payer"], w["dim_plan"]),
    "f09_star_rating": lambda w: agg.agg_star(w["star_ratings_clean"], w["dim_payer"]),
    "f09_star_rating_overall": lambda w: agg.agg_star_overall(w["agg_star_rating"]),
    "f10_raf_score": lambda w: agg.agg_raf(w["risk_adjustment_clean"], w["dim_patient"], w["dim_payer"], w["dim_plan"]),
    "f11_medication_adherence": lambda w: agg.pdc(w["fact_prescription"], w["dim_medication"]),
}
for _name, _build in _AGGREGATES.items():
    query(_name)(_build)


@query("f12_adherence_exact")
def _(w):
    fills = w["fact_prescription"].withColumn("fill_date", s.date_of_key("fill_date_key")).filter(F.col("fill_date").isNotNull())
    return agg.pdc_exact(fills, "2001-12-31")


@query("f13_vitals_hourly")
def _(w):
    return agg.vitals_hourly(w["vitals_readings"])


@query("f14_alert_facts")
def _(w):
    return agg.alert_facts(w["all_alerts"], w["alert_closure_events"])


@query("f15_ar_aging")
def _(w):
    return agg.ar_aging(w["fact_claim"], w["dim_payer"])


@query("f16_expiring_contracts")
def _(w):
    return agg.expiring_contracts(w["bridge_provider_contract"], w.as_of, 90)


@query("f17_authorization_outliers")
def _(w):
    return agg.pa_outliers(w["fact_authorization"], 5)


@query("f18_payer_mix")
def _(w):
    return agg.payer_mix(w["fact_claim"].filter(F.col("claim_date_key") >= 20000801), w["dim_payer"])


# --- checks -----------------------------------------------------------------------------------------

@query("r01_not_null")
def _(w):
    return quality.fail_if(quality.dq_not_null(w["claims_clean"], ["claim_id"])).unionByName(quality.dq_not_null(w["claims_clean"], ["payment_date", "allowed_amount", "denial_reason"]))


@query("r02_date_order")
def _(w):
    return quality.dq_order(w["claims_clean"], "claim_date", "payment_date")


@query("r03_non_negative")
def _(w):
    return quality.fail_if(quality.dq_nonneg(w["premiums_clean"], "premium_amount"))


@query("r04_table_counts")
def _(w):
    return quality.table_counts(w.pick(*GOLD))


FACT_KEYS = {
    "fact_encounter": ["patient_key", "provider_key", "facility_key"],
    "fact_claim": ["patient_key", "provider_key", "payer_key", "encounter_key", "facility_key"],
    "fact_prescription": ["patient_key", "provider_key", "payer_key", "medication_key", "encounter_key"],
    "fact_diagnosis": ["patient_key", "encounter_key", "diagnosis_key", "facility_key"],
}


@query("r05_key_coverage")
def _(w):
    parts = [quality.fk_coverage(w[fact], fks, fact) for fact, fks in FACT_KEYS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("r06_sanity_metrics")
def _(w):
    return quality.sanity_metrics(w["fact_claim"], w["agg_medication_adherence"], w["fact_diagnosis"], w["dim_sdoh"])


@query("r07_score_profile")
def _(w):
    raw = quality.profile(w["encounters_raw"], "readmission_risk", "encounter_type", "raw")
    gold = quality.profile(w["fact_encounter"], "readmission_risk_score", "readmission_risk_category", "gold")
    return raw.unionByName(gold)


@query("r08_routed_quality")
def _(w):
    return quality.routed_quality(w["claims_events"], "claim_type")


