"""Cleaning of the raw tables: names, codes, dates, money, one row per business key."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.latest import dedup_latest

LOAD_TS = "_bronze_load_timestamp"
Rule = Callable[[str], Column]

# Key of each table and the rule of each column that is changed.
KEYS: dict[str, str] = {
    "patients": "patient_id", "providers": "provider_id", "encounters": "encounter_id", "claims": "claim_id",
    "prescriptions": "prescription_id", "diagnoses": "diagnosis_id", "member_enrollment": "enrollment_id",
    "premiums": "premium_id", "authorizations": "auth_id", "capitation": "capitation_id",
    "provider_contracts": "contract_id", "hedis_compliance": "compliance_id", "star_ratings": "star_id",
    "risk_adjustment": "raf_id", "claim_appeals": "appeal_id",
}

RULES: dict[str, dict[str, Rule]] = {
    "patients": {"first_name": s.proper, "last_name": s.proper, "gender": s.norm_gender, "state": s.code,
                 "zip_code": s.digits, "phone": s.digits, "email": s.email, "date_of_birth": s.to_d},
    "providers": {"first_name": s.proper, "last_name": s.proper, "specialty": s.proper, "department": s.proper,
                  "npi": s.digits, "email": s.email, "hire_date": s.to_d},
    "encounters": {"encounter_type": s.proper, "admission_type": s.proper, "discharge_disposition": s.proper,
                   "discharge_date": s.to_d, "total_charges": s.money, "readmission_risk": s.number},
    "claims": {"claim_type": s.proper, "claim_status": s.proper, "service_date": s.to_d, "billed_amount": s.money,
               "allowed_amount": s.money, "paid_amount": s.money, "denial_flag": s.flag0,
               "denial_risk_score": s.number, "denial_risk_category": s.proper, "days_to_payment": s.whole,
               "net_collection_rate": s.number, "appeal_outcome": s.proper, "appeal_amount_recovered": s.money},
    "prescriptions": {"medication_name": s.proper, "fill_date": s.to_d, "days_supply": s.whole, "quantity": s.whole,
                      "refill_number": s.whole, "is_generic": s.whole, "total_cost": s.money, "copay_amount": s.money},
    "diagnoses": {"icd_code": s.code, "diagnosis_type": s.proper, "present_on_admission": s.code,
                  "sequence_number": s.whole, "diagnosis_date": s.to_d},
    "member_enrollment": {"year_month": s.trimmed, "coverage_start": s.to_d, "coverage_end": s.to_d,
                          "enrollment_status": s.proper, "pmpm_premium": s.money, "is_capitated": s.flag},
    "premiums": {"year_month": s.trimmed, "premium_amount": s.money, "subsidy_amount": s.money, "member_paid": s.money},
    "authorizations": {"submit_date": s.to_d, "decision_date": s.to_d, "decision_tat_hours": s.number,
                       "auth_outcome": s.proper, "auth_units_requested": s.whole, "auth_units_approved": s.whole},
    "capitation": {"year_month": s.trimmed, "capitation_pmpm": s.money, "withhold_pct": s.number, "bonus_eligible": s.flag},
    "provider_contracts": {"contract_type": s.proper, "effective_date": s.to_d, "termination_date": s.to_d,
                           "fee_schedule_pct_medicare": s.number, "withhold_pct": s.number,
                           "quality_bonus_pct": s.number, "is_in_network": s.flag},
    "hedis_compliance": {"measurement_year": s.whole, "denominator_eligible": s.whole, "numerator_met": s.whole,
                         "compliance_rate": s.number},
    "star_ratings": {"measurement_year": s.whole, "weight": s.whole, "star_score": s.number,
                     "weighted_score": s.number, "national_avg": s.number},
    "risk_adjustment": {"measurement_year": s.whole, "hcc_count": s.whole, "demographic_score": s.number,
                        "disease_score": s.number, "raf_score": s.number},
    "claim_appeals": {"appeal_level": s.trimmed, "appeal_level_num": s.whole, "submit_date": s.to_d,
                      "decision_date": s.to_d, "appeal_outcome": s.proper, "appeal_amount_recovered": s.money,
                      "appeal_reason": s.trimmed},
}


def _business_columns(df: DataFrame, table: str) -> DataFrame:
    """Columns that do not exist under that name in the raw table."""
    if table == "providers":
        return df.withColumn("is_active", s.is_active("status"))
    if table == "encounters":
        df = df.withColumn("encounter_date", s.to_d("admit_date"))
        return df.withColumn("length_of_stay", s.length_of_stay())
    if table == "claims":
        return df.withColumns({"claim_date": s.to_d("submit_date"), "payment_date": s.to_d("process_date")})
    return df


def clean(df: DataFrame, table: str, stamp: Column | None = None) -> DataFrame:
    """Clean one table. Columns named in the rules but absent from the input are skipped."""
    one = dedup_latest(df, [KEYS[table]], [c for c in [LOAD_TS] if c in df.columns])
    rules = {c: rule(c) for c, rule in RULES[table].items() if c in df.columns}
    cleaned = _business_columns(one.withColumns(rules), table)
    return cleaned.withColumn("_silver_load_timestamp", F.current_timestamp() if stamp is None else stamp)


clean_patients = partial(clean, table="patients")
clean_providers = partial(clean, table="providers")
clean_encounters = partial(clean, table="encounters")
clean_claims = partial(clean, table="claims")
clean_prescriptions = partial(clean, table="prescriptions")
clean_diagnoses = partial(clean, table="diagnoses")
clean_member_enrollment = partial(clean, table="member_enrollment")
clean_premiums = partial(clean, table="premiums")
clean_authorizations = partial(clean, table="authorizations")
clean_capitation = partial(clean, table="capitation")
clean_provider_contracts = partial(clean, table="provider_contracts")
clean_hedis_compliance = partial(clean, table="hedis_compliance")
clean_star_ratings = partial(clean, table="star_ratings")
clean_risk_adjustment = partial(clean, table="risk_adjustment")
clean_claim_appeals = partial(clean, table="claim_appeals")
