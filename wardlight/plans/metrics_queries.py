"""One query per measure, and queries for the ways of evaluating measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlight.operators import metrics
from wardlight.plans.registry import query

PAYER, SPECIALTY, DRUG, ICD, AGE = "dim_payer.payer_type", "dim_provider.specialty", "dim_medication.drug_class", "dim_diagnosis.icd_category", "dim_patient.age_group"
YEAR, SDOH, PLAN = "dim_date.year", "dim_sdoh.risk_tier", "dim_plan.metal_tier"

# number -> (measure, group column)
BY_NUMBER: dict[int, tuple[str, str]] = {
    1: ("high_risk_denials", PAYER), 2: ("adherent_rate", DRUG), 3: ("avg_pdc_score", DRUG), 4: ("total_patients", AGE), 5: ("chronic_patients", AGE), 6: ("chronic_rate", AGE),
    7: ("avg_patient_age", "dim_patient.gender"), 8: ("female_patients", AGE), 9: ("male_patients", AGE), 10: ("avg_satisfaction_score", SPECIALTY), 11: ("avg_documentation_score", SPECIALTY),
    12: ("avg_ehr_adoption_score", SPECIALTY), 13: ("telehealth_enabled_rate", SPECIALTY), 14: ("board_certified_rate", SPECIALTY), 15: ("avg_panel_size", SPECIALTY), 16: ("avg_rvu_target", SPECIALTY),
    17: ("value_based_provider_rate", SPECIALTY), 18: ("avg_actual_rvu", SPECIALTY), 19: ("rvu_attainment_pct", SPECIALTY), 20: ("actual_panel_count", SPECIALTY), 21: ("panel_utilization_pct", SPECIALTY),
    22: ("total_claims", PAYER), 23: ("denial_rate", PAYER), 24: ("total_billed", PAYER), 25: ("total_paid", PAYER), 26: ("collection_rate", PAYER), 27: ("at_risk_revenue", PAYER), 28: ("avg_denial_risk", PAYER),
    29: ("avg_days_to_payment", PAYER), 30: ("net_collection_rate", PAYER), 31: ("appeal_success_rate", PAYER), 32: ("total_appeal_recovery", PAYER), 34: ("paid_by_payment_date", YEAR),
    35: ("unique_diagnoses", AGE), 36: ("chronic_diagnoses", AGE), 37: ("patients_with_chronic_conditions", ICD), 38: ("total_encounters", SPECIALTY), 39: ("readmission_rate", SPECIALTY),
    40: ("high_risk_readmissions", SPECIALTY), 41: ("medium_risk_readmissions", SPECIALTY), 42: ("low_risk_readmissions", SPECIALTY), 43: ("avg_length_of_stay", "fact_encounter.encounter_type"),
    44: ("avg_readmission_risk", SPECIALTY), 45: ("total_charges", YEAR), 49: ("total_cost", YEAR), 50: ("avg_drg_weight", "fact_encounter.drg_code"), 51: ("total_expected_reimbursement", "fact_encounter.drg_code"),
    52: ("drg_margin", "fact_encounter.drg_code"), 53: ("pmpm", AGE), 54: ("avg_cost_per_encounter", SPECIALTY), 55: ("inpatient_encounters", YEAR), 56: ("emergency_encounters", YEAR), 57: ("quality_score", AGE),
    58: ("total_fills", DRUG), 59: ("total_rx_cost", DRUG), 60: ("avg_rx_cost_per_fill", DRUG), 61: ("generic_fill_rate", DRUG), 62: ("payer_rx_cost", PAYER), 63: ("patient_copay_total", PAYER),
    64: ("hedis_compliance_pct", "agg_hedis_compliance.measure_id"), 65: ("hedis_eligible_members", "agg_hedis_compliance.measure_id"), 66: ("hedis_numerator_met", "agg_hedis_compliance.measure_id"),
    67: ("mlr_pct", PAYER), 68: ("premium_collected", PAYER), 69: ("medical_paid", PAYER), 70: ("avg_raf_score", PLAN), 71: ("avg_hcc_count", PLAN), 72: ("members_with_hccs", PLAN),
    73: ("avg_star_score", "agg_star_rating.domain"), 74: ("weighted_star_score", "agg_star_rating.domain"), 75: ("overall_star_score", PAYER), 76: ("contract_count", PAYER), 77: ("in_network_contract_rate", PAYER),
    78: ("total_payers", PAYER), 79: ("avg_reimbursement_rate", PAYER), 80: ("large_network_payers", PAYER), 81: ("commercial_payers", "dim_payer.plan_type"), 82: ("government_payers", "dim_payer.plan_type"),
    83: ("total_plans", PLAN), 84: ("capitated_plan_count", PLAN), 85: ("total_appeals", PAYER), 86: ("appeal_recovery", PAYER), 87: ("appeal_win_rate", PAYER), 88: ("total_auths", PAYER), 89: ("pa_approval_rate", PAYER),
    90: ("pa_denial_rate", SPECIALTY), 91: ("avg_decision_tat", SPECIALTY), 92: ("total_capitation_paid", SPECIALTY), 93: ("avg_capitation_pmpm", SPECIALTY), 94: ("avg_withhold_pct", SPECIALTY),
    95: ("collection_rate_of_totals", PAYER), 96: ("at_risk_revenue_high", PAYER), 97: ("appeal_success_rate_won", PAYER), 99: ("pmpm_charges", SPECIALTY), 101: ("total_premium_revenue", PLAN), 102: ("member_months", PLAN),
    103: ("premium_pmpm", PLAN), 104: ("total_subsidy", PLAN), 105: ("total_member_paid", PLAN), 106: ("total_providers", SPECIALTY), 107: ("full_time_providers", SPECIALTY), 108: ("avg_years_experience", SPECIALTY),
    109: ("high_risk_sdoh_patients", AGE), 110: ("avg_svi", SDOH), 111: ("provider_denial_count", SPECIALTY), 112: ("telehealth_encounters", YEAR), 113: ("telehealth_rate", YEAR),
    114: ("unique_medications_prescribed", SPECIALTY),
}

for _number, (_measure, _by) in BY_NUMBER.items():
    query(f"m{_number:03d}_{_measure}")(lambda w, m=_measure, b=_by: metrics.evaluate(w, [m], [b]))


def _monthly(w, measure: str):
    return metrics.evaluate(w, [measure], ["dim_date.year", "dim_date.month_number"])


def _daily_claims(w):
    return metrics.evaluate(w, ["total_claims"], ["dim_date.year", "dim_date.month_number", "dim_date.full_date"])


@query("m033_mtd_claims")
def _(w):
    return metrics.to_date(_daily_claims(w), "total_claims", ["year", "month_number"], "full_date", "mtd_claims")


@query("m098_mtd_claims_of_month")
def _(w):
    running = metrics.to_date(_daily_claims(w), "total_claims", ["year", "month_number"], "full_date", "mtd_claims")
    return running.filter(F.dayofmonth("full_date") <= 15).groupBy("year", "month_number").agg(F.max("mtd_claims").alias("mtd_claims"))


@query("m046_py_charges")
def _(w):
    return metrics.prior_year(_monthly(w, "total_charges"), "total_charges", keys=["month_number"]).drop("yoy_growth")


@query("m047_yoy_charge_growth")
def _(w):
    return metrics.prior_year(metrics.evaluate(w, ["total_charges"], [YEAR]), "total_charges").select("year", "yoy_growth")


@query("m048_ytd_charges")
def _(w):
    return metrics.to_date(_monthly(w, "total_charges"), "total_charges", ["year"], "month_number", "ytd_charges")


@query("m100_ytd_charges_by_quarter")
def _(w):
    quarterly = metrics.evaluate(w, ["total_charges"], [YEAR, "dim_date.quarter"])
    return metrics.to_date(quarterly, "total_charges", ["year"], "quarter", "ytd_charges")


# --- ways of evaluating ------------------------------------------------------------------------

@query("l01_measures_by_columns")
def _(w):
    return metrics.evaluate(w, ["total_claims", "denial_rate", "total_premium_revenue", "total_auths", "total_patients"], ["dim_payer.payer_name", PAYER])


@query("l02_scalar_measures")
def _(w):
    return metrics.evaluate(w, ["total_claims", "total_billed", "denial_rate", "at_risk_revenue", "total_patients", "avg_pdc_score", "mlr_pct", "hedis_compliance_pct"])


@query("l03_top_measures")
def _(w):
    return metrics.evaluate(w, ["denial_rate"], ["dim_payer.payer_name"], top=1, order="denial_rate")


@query("l04_filtered_measure")
def _(w):
    return metrics.evaluate(w, ["approved_billed", "at_risk_revenue"], [SPECIALTY])


@query("l05_safe_ratio")
def _(w):
    return metrics.evaluate(w, ["appeal_success_rate", "net_collection_ratio", "collection_rate_of_totals"], ["fact_claim.claim_status"])


@query("l06_distinct_with_blank")
def _(w):
    return metrics.evaluate(w, ["unique_diagnoses", "chronic_diagnoses"])


@query("l07_time_comparison")
def _(w):
    ytd = metrics.to_date(_monthly(w, "total_charges"), "total_charges", ["year"], "month_number", "ytd_charges")
    return metrics.prior_year(ytd, "total_charges", keys=["month_number"])


@query("l08_other_date")
def _(w):
    return metrics.evaluate(w, ["total_paid", "paid_by_payment_date"], [YEAR, "dim_date.quarter"])


@query("l09_snowflake_filter")
def _(w):
    return metrics.evaluate(w, ["total_patients", "readmission_rate", "denial_rate"], [AGE], filters=[(SDOH, lambda c: c == "High")])


@query("l10_blank_member")
def _(w):
    return metrics.evaluate(w, ["total_claims", "total_billed"], ["dim_facility.facility_type"])


@query("l11_benchmark_bands")
def _(w):
    return metrics.band(metrics.evaluate(w, ["denial_rate"], ["dim_payer.payer_name"]), "denial_rate")


@query("l11_benchmark_bands_adherence")
def _(w):
    return metrics.band(metrics.evaluate(w, ["adherent_rate"], [DRUG]), "adherent_rate")


@query("l12_inpatient_readmissions")
def _(w):
    return metrics.evaluate(w, ["inpatient_readmission_rate", "readmission_rate"], [SPECIALTY])


@query("l12_revenue_leakage")
def _(w):
    return metrics.evaluate(w, ["revenue_leakage"], [PAYER])


@query("l12_high_risk_readmissions")
def _(w):
    return metrics.evaluate(w, ["readmission_rate"], ["fact_encounter.encounter_type"], filters=[(SDOH, lambda c: c == "High")])


@query("l13_calibrated_accuracy")
def _(w):
    judged = w["labels"].select("doc_id", F.when(F.col("toxic") == 0, "pass").otherwise("fail").alias("judge_label"), F.when(F.col("quality") == 1, "pass").otherwise("fail").alias("expected_label"))
    return metrics.calibrated_accuracy(judged, judged)
