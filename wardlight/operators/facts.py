"""Fact tables: business rows with the surrogate keys of their dimensions.

Money stays decimal(18,2): sums are exact whatever the order of the rows. Surrogate
keys of the facts themselves are added by ``keys`` when the table is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import scores

Dims = dict[str, DataFrame]


def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str] | str, keys: list[str], current: bool = True, how: str = "left") -> DataFrame:
    """Bring in key columns of a dimension; with ``current`` only of its current rows.

    No broadcast is forced: a member or claim table can be as large as the fact. Spark
    broadcasts the small ones by their size.
    """
    pairs = {on: on} if isinstance(on, str) else on
    if current and "is_current" in dim.columns:
        dim = dim.filter(F.col("is_current") == 1)
    right = dim.select(*[F.col(d).alias(f"_on_{d}") for d in pairs.values()], *keys)
    cond = [fact[f] == right[f"_on_{d}"] for f, d in pairs.items()]
    return fact.join(right, cond, how).drop(*[f"_on_{d}" for d in pairs.values()])


def _cents(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def fact_encounter(enc: DataFrame, dims: Dims) -> DataFrame:
    df = lookup(enc, dims["patient"], "patient_id", ["patient_key"])
    df = lookup(df, dims["provider"], "provider_id", ["provider_key"])
    df = lookup(df, dims["facility"], "facility_id", ["facility_key"])
    discharge = F.coalesce("discharge_date", "encounter_date")
    charges = F.col("total_charges")
    df = scores.readmission_risk(df)
    return df.select(
        "encounter_id", s.date_key("encounter_date").alias("encounter_date_key"), s.date_key(discharge).alias("discharge_date_key"),
        "patient_key", "provider_key", "facility_key",
        F.coalesce("encounter_type", F.lit("Outpatient")).alias("encounter_type"), F.coalesce("admission_type", F.lit("Elective")).alias("admission_type"),
        F.coalesce("discharge_disposition", F.lit("Home")).alias("discharge_disposition"), F.coalesce("length_of_stay", F.lit(1)).alias("length_of_stay"),
        _cents(F.coalesce(charges, F.lit(0))).alias("total_charges"),
        _cents(F.coalesce(_optional(df, "cost_to_deliver", "decimal(18,2)"), charges * F.lit(0.7).cast("decimal(2,1)"), F.lit(0))).alias("total_cost"),
        _optional(df, "primary_diagnosis_code").alias("primary_diagnosis_code"),
        _optional(df, "drg_code").alias("drg_code"), _optional(df, "drg_description").alias("drg_description"), _optional(df, "drg_weight", "double").alias("drg_weight"),
        _optional(df, "expected_reimbursement", "decimal(18,2)").alias("expected_reimbursement"),
        "readmission_flag", "readmission_risk_score", "readmission_risk_category",
    )


def fact_claim(claims: DataFrame, dims: Dims, enc: DataFrame, ml: DataFrame | None = None, hashed_denials: bool = False) -> DataFrame:
    """Claims with denial, risk, payment and appeal columns.

    ``enc`` gives encounter and facility keys by encounter id, ``ml`` optional model
    scores by claim id. ``hashed_denials`` adds the bucketed denials to the stated ones.
    """
    df = lookup(claims, dims["patient"], "patient_id", ["patient_key"])
    df = lookup(df, dims["provider"], "provider_id", ["provider_key"])
    df = lookup(df, dims["payer"], "payer_id", ["payer_key"])
    df = lookup(df, enc, "encounter_id", ["encounter_key", "facility_key"])
    if ml is not None:
        df = df.join(ml.select("claim_id", F.col("denial_risk_score").alias("_ml_score"), F.col("primary_denial_reason").alias("_ml_reason"),
                               F.col("recommended_action").alias("_ml_action")), "claim_id", "left")
    df = scores.denial_risk(scores.assign_denial(df, "claim_id", "billed_amount", hashed=hashed_denials))
    df = scores.denial_reason(df)
    billed, allowed, paid = F.col("billed_amount"), F.col("allowed_amount"), F.col("paid_amount")
    df = scores.payment_metrics(df)
    denied = F.col("_is_denied")
    return df.select(
        "claim_id", s.date_key("claim_date").alias("claim_date_key"), s.date_key(F.coalesce("payment_date", "claim_date")).alias("payment_date_key"),
        "patient_key", "provider_key", "payer_key", "encounter_key", "facility_key",
        F.coalesce("claim_type", F.lit("Professional")).alias("claim_type"),
        F.when(denied, "Denied").otherwise(F.coalesce("claim_status", F.lit("Paid"))).alias("claim_status"),
        _optional(df, "primary_diagnosis_code").alias("primary_diagnosis_code"),
        _cents(F.coalesce(billed, F.lit(0))).alias("billed_amount"),
        _cents(F.coalesce(allowed, billed * F.lit(0.85).cast("decimal(3,2)"), F.lit(0))).alias("allowed_amount"),
        _cents(F.coalesce(paid, billed * F.lit(0.80).cast("decimal(3,2)"), F.lit(0))).alias("paid_amount"),
        F.when(denied, 1).otherwise(0).alias("denial_flag"), "denial_risk_score", "denial_risk_category",
        "primary_denial_reason", "recommended_action", "days_to_payment", "net_collection_rate",
        _optional(df, "appeal_date").alias("appeal_date"), _optional(df, "appeal_outcome").alias("appeal_outcome"),
        _optional(df, "appeal_amount_recovered", "decimal(18,2)").alias("appeal_amount_recovered"),
    )


def encounter_payer(claims: DataFrame, payer: DataFrame) -> DataFrame:
    """One payer per encounter: that of the encounter's first claim with a known payer."""
    known = claims.join(payer.select("payer_id", "payer_key"), "payer_id", "inner")
    return known.groupBy("encounter_id").agg(F.min_by("payer_key", "claim_id").alias("payer_key"))


def fact_prescription(rx: DataFrame, dims: Dims, claims: DataFrame, enc: DataFrame | None) -> DataFrame:
    """Fills with a known patient and clinician; the payer comes through the encounter's claim."""
    df = lookup(rx, dims["patient"], "patient_id", ["patient_key"], how="inner")
    df = lookup(df, dims["provider"], "provider_id", ["provider_key"], how="inner")
    df = lookup(df, dims["medication"], "rxnorm_code", ["medication_key"])
    if enc is None:
        df = df.withColumns({"encounter_key": F.lit(None).cast("bigint"), "facility_key": F.lit(None).cast("bigint")})
    else:
        df = lookup(df, enc, "encounter_id", ["encounter_key", "facility_key"])
    df = df.join(encounter_payer(claims, dims["payer"]), "encounter_id", "left")
    cost, copay = F.col("total_cost"), F.col("copay_amount")
    null = F.lit(None)
    return df.select(
        "prescription_id", null.cast("string").alias("prescription_group_id"), s.date_key("fill_date").alias("fill_date_key"),
        "patient_key", "provider_key", "payer_key", "encounter_key", "medication_key", "facility_key", F.col("refill_number").alias("fill_number"), "days_supply",
        F.col("quantity").alias("quantity_dispensed"), null.cast("int").alias("refills_authorized"), "is_generic", null.cast("int").alias("is_chronic_medication"),
        null.cast("string").alias("pharmacy_type"), cost, _cents(F.coalesce(cost, F.lit(0)) - F.coalesce(copay, F.lit(0))).alias("payer_paid"),
        copay.alias("patient_copay"), null.cast("string").alias("prescribing_reason_code"),
    )


def fact_diagnosis(dx: DataFrame, dims: Dims, enc: DataFrame) -> DataFrame:
    df = lookup(dx.drop("facility_id"), dims["patient"], "patient_id", ["patient_key"])
    df = lookup(df, dims["diagnosis"], "icd_code", ["diagnosis_key"])
    df = lookup(df, enc, "encounter_id", ["encounter_key", "facility_key", "encounter_date_key"])
    return df.select("diagnosis_id", "encounter_key", F.col("encounter_date_key").alias("diagnosis_date_key"), "patient_key", "diagnosis_key", "facility_key",
                     "icd_code", F.col("sequence_number").alias("diagnosis_sequence"), "diagnosis_type", "present_on_admission")


def _member_keys(df: DataFrame, dims: Dims, member: str, *others: str) -> DataFrame:
    """Member key under its own name, then the keys of the other dimensions."""
    people = dims["patient"].withColumnRenamed("patient_key", "member_key")
    df = lookup(df, people, {member: "patient_id"}, ["member_key"])
    for name in others:
        df = lookup(df, dims[name], f"{name}_id", [f"{name}_key"])
    return df


def fact_premium(premiums: DataFrame, dims: Dims) -> DataFrame:
    df = _member_keys(premiums, dims, "member_id", "plan", "payer")
    return df.select("premium_id", "year_month", s.month_key("year_month").alias("year_month_key"), "member_key", "plan_key", "payer_key",
                     "premium_amount", "subsidy_amount", "member_paid")


def fact_authorization(auths: DataFrame, dims: Dims) -> DataFrame:
    df = _member_keys(auths, dims, "patient_id", "provider", "payer")
    return df.select("auth_id", s.date_key("submit_date").alias("submit_date_key"), s.date_key("decision_date").alias("decision_date_key"), "member_key", "provider_key", "payer_key",
                     "claim_id", "cpt_code", "primary_diagnosis_code", "auth_outcome", "decision_tat_hours", "auth_units_requested", "auth_units_approved")


def fact_capitation(capitation: DataFrame, dims: Dims) -> DataFrame:
    df = _member_keys(capitation, dims, "member_id", "provider", "payer", "plan")
    return df.select("capitation_id", "year_month", "member_key", "provider_key", "payer_key", "plan_key", "capitation_pmpm", "withhold_pct", "bonus_eligible")


def fact_appeal(appeals: DataFrame, dims: Dims, claims: DataFrame) -> DataFrame:
    df = _member_keys(appeals, dims, "patient_id", "payer")
    df = lookup(df, claims, "claim_id", ["claim_key"])
    return df.select("appeal_id", "claim_key", "claim_id", "member_key", "payer_key", s.date_key("submit_date").alias("submit_date_key"),
                     s.date_key("decision_date").alias("decision_date_key"), "appeal_level", "appeal_level_num", "appeal_outcome", "appeal_amount_recovered", "appeal_reason")


def bridge_provider_contract(contracts: DataFrame, dims: Dims) -> DataFrame:
    df = lookup(contracts, dims["provider"], "provider_id", ["provider_key"])
    df = lookup(df, dims["payer"], "payer_id", ["payer_key"])
    return df.select("contract_id", "provider_key", "payer_key", "contract_type", "effective_date", "termination_date",
                     "fee_schedule_pct_medicare", "withhold_pct", "quality_bonus_pct", "is_in_network")
