"""The business questions, one named query each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import aggregates as agg
from wardlight.operators import events, fraud, graph, metrics, scores, tiles, views
from wardlight.operators.events import TS, lookback, union_all
from wardlight.operators.increment import MONTH as STORED_MONTH
from wardlight.operators.star import star
from wardlight.plans.registry import query
from wardlight.plans.warehouse import WEEK, Warehouse, cto_limits

THIS_MONTH, THIS_QUARTER, LAST_QUARTER, LAST_YEAR = (20010701, 20010731), (20010701, 20010930), (20010401, 20010630), (20000801, 20010731)
PAYER, SPECIALTY, SDOH, DRUG = "dim_payer.payer_name", "dim_provider.specialty", "dim_sdoh.risk_tier", "dim_medication.drug_class"
MONTH = ["dim_date.year", "dim_date.month_number", "dim_date.month_name"]


def _denied() -> Column:
    return F.col("denial_flag") == 1


def _n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def _in(col: str, span: tuple[int, int]) -> Column:
    """Days of a span on a fact that lies by month of this date: other months are not read."""
    return F.col(col).between(*span) & F.col(STORED_MONTH).between(span[0] // 100, span[1] // 100)


def _within(span: tuple[int, int], key: str = "dim_date.date_key"):
    return [(key, lambda c: c.between(*span)), (STORED_MONTH, lambda c: c.between(span[0] // 100, span[1] // 100))]


def _rate(cond: Column, name: str) -> Column:
    return s.ratio(F.count_if(cond), F.count(F.lit(1))).alias(name)


def _long(w: Warehouse, names: list[str]) -> DataFrame:
    """Measures as (metric, value) rows."""
    wide = metrics.evaluate(w, names)
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def _evaluated(name: str, measures: list[str], by: list[str], **more) -> None:
    query(name)(lambda w: metrics.evaluate(w, measures, by, **more))


def _high_risk(w: Warehouse) -> DataFrame:
    """Patients with a high-risk encounter and their highest score."""
    rows = w["fact_encounter"].filter(F.col("readmission_risk_category") == "High")
    return rows.groupBy("patient_key").agg(F.max("readmission_risk_score").alias("max_risk"), _n("high_risk_encounters"))


def _non_adherent(w: Warehouse) -> DataFrame:
    return w["agg_medication_adherence"].filter(F.col("adherence_category") == "Non-Adherent")


def _non_adherent_patients(w: Warehouse) -> DataFrame:
    return _non_adherent(w).groupBy("patient_key").agg(_n("non_adherent_drugs"), s.rounded(F.avg("pdc_score"), 6).alias("avg_pdc"))


def _chronic_of_encounter(w: Warehouse) -> DataFrame:
    """Each chronic condition once per encounter."""
    chronic = w["dim_diagnosis"].filter(F.col("is_chronic") == 1).select("diagnosis_key", "icd_description")
    return w["fact_diagnosis"].select("encounter_key", "diagnosis_key").distinct().join(chronic, "diagnosis_key")


# --- CMO ---------------------------------------------------------------------------------

@query("q001_cmo_today")
def _(w):
    return _long(w, ["readmission_rate", "high_risk_readmissions", "adherent_rate", "avg_pdc_score", "high_risk_sdoh_patients", "chronic_patients"])


@query("q002_readmission_vs_benchmark")
def _(w):
    month = metrics.evaluate(w, ["readmission_rate"], filters=_within(THIS_MONTH)).withColumn("benchmark", F.lit(0.15))
    per = w["fact_encounter"].groupBy("patient_key").agg(F.max(F.when(F.col("readmission_risk_category") == "High", 1).otherwise(0)).alias("high"), F.max("readmission_flag").alias("back"))
    return month.withColumn("high_risk_not_readmitted", per.filter((F.col("high") == 1) & (F.col("back") == 0)).agg(_n()).scalar())


@query("q003_readmission_drivers")
def _(w):
    back = w["fact_encounter"].filter(F.col("readmission_flag") == 1).select("encounter_key")
    return _chronic_of_encounter(w).join(back, "encounter_key").groupBy("icd_description").agg(_n("readmissions"))


def _candidates(w: Warehouse) -> DataFrame:
    people = graph.patients(w)
    return _high_risk(w).join(_non_adherent_patients(w), "patient_key").join(people, "patient_key").select("patient_id", "max_risk", "high_risk_encounters", "non_adherent_drugs", "avg_pdc")


query("q004_intervention_candidates")(_candidates)
_evaluated("q005_sdoh_equity", ["total_patients", "total_encounters", "readmission_rate"], [SDOH])


@query("q006_peer_review")
def _(w):
    claims = w["fact_claim"].groupBy("provider_key").agg(_n("claims"), _rate(_denied(), "denial_rate"))
    doctors = w["dim_provider"].select("provider_key", "provider_id", "display_name", "specialty", "documentation_score")
    return doctors.join(claims, "provider_key", "left").filter((F.col("denial_rate") > 0.2) | (F.col("documentation_score") < 70)).drop("provider_key")


# --- provider measures ------------------------------------------------------------------------

query("q007_readmission_rate")(lambda w: metrics.evaluate(w, ["readmission_rate"]))
_evaluated("q008_readmission_by_type", ["total_encounters", "readmission_rate", "high_risk_readmissions"], ["fact_encounter.encounter_type"])
_evaluated("q009_readmission_trend", ["total_encounters", "readmission_rate"], MONTH, filters=_within(LAST_YEAR))
_evaluated("q010_adherence_by_class", ["avg_pdc_score", "adherent_rate"], [DRUG])
_evaluated("q011_rvu_leaders", ["avg_rvu_target", "avg_actual_rvu", "rvu_attainment_pct"], ["dim_provider.provider_id", "dim_provider.display_name", SPECIALTY], top=20, order="rvu_attainment_pct")
_evaluated("q012_specialty_scorecard", ["total_providers", "board_certified_rate", "avg_satisfaction_score", "avg_documentation_score", "value_based_provider_rate"], [SPECIALTY])
_DRG = ["fact_encounter.drg_code", "fact_encounter.drg_description"]
_evaluated("q013_worst_drg_margins", ["total_encounters", "total_charges", "total_cost", "drg_margin"], _DRG, top=15, order="drg_margin", ascending=True)


@query("q014_telehealth_by_year")
def _(w):
    years = metrics.evaluate(w, ["total_encounters", "telehealth_encounters", "telehealth_rate", "total_charges"], ["dim_date.year"])
    return metrics.prior_year(years, "total_charges").drop("py_total_charges")


_evaluated("q015_sdoh_readmissions", ["total_patients", "high_risk_sdoh_patients", "readmission_rate", "total_charges"], [SDOH])
query("q016_chronic_burden")(lambda w: metrics.evaluate(w, ["total_patients", "chronic_patients", "chronic_rate", "patients_with_chronic_conditions", "avg_pdc_score"]))
_evaluated("q017_panel_capacity", ["total_providers", "avg_panel_size", "actual_panel_count", "panel_utilization_pct"], [SPECIALTY])
_evaluated("q018_common_chronic_diagnoses", ["unique_diagnoses", "patients_with_chronic_conditions"], ["dim_diagnosis.icd_code", "dim_diagnosis.icd_description", "dim_diagnosis.icd_category"],
           top=15, order="patients_with_chronic_conditions")

# --- CFO ---------------------------------------------------------------------------------------

query("q019_cfo_today")(lambda w: _long(w, ["denial_rate", "collection_rate", "avg_days_to_payment", "at_risk_revenue", "appeal_success_rate", "mlr_pct"]))


@query("q020_cfo_vs_benchmarks")
def _(w):
    df = metrics.evaluate(w, ["denial_rate", "collection_rate", "avg_days_to_payment"])
    return df.withColumns({"denial_over": F.col("denial_rate") > 0.08, "collection_under": F.col("collection_rate") < 0.95, "ar_over": F.col("avg_days_to_payment") > 45})


@query("q021_top_denying_payers")
def _(w):
    reasons = star(w, "fact_claim", "payer").filter(F.col("payer_name").isNotNull()).groupBy("payer_name", "primary_denial_reason").agg(_n("c"), F.count_if(_denied()).alias("d"))
    main = F.min_by("primary_denial_reason", F.when(F.col("primary_denial_reason").isNotNull(), F.struct(-F.col("c"), F.col("primary_denial_reason"))))
    grouped = reasons.groupBy("payer_name").agg(F.sum("d").alias("denied"), s.ratio(F.sum("d"), F.sum("c")).alias("denial_rate"), main.alias("main_reason"))
    return grouped.orderBy(F.col("denial_rate").desc(), "payer_name").limit(3)


@query("q022_quarter_denials")
def _(w):
    quarter = w["fact_claim"].filter(_in("claim_date_key", THIS_QUARTER))
    pending = F.col("claim_status") == "Pending"
    return quarter.agg(F.coalesce(F.sum(F.when(_denied(), F.col("billed_amount"))), F.lit(0)).cast("double").alias("denied_dollars"),
                       F.coalesce(F.sum(F.when(pending & F.col("denial_risk_category").isin("High", "Medium"), F.col("billed_amount"))), F.lit(0)).cast("double").alias("pending_at_risk"))


@query("q023_appeal_return_by_reason")
def _(w):
    rows = w["fact_claim"].filter(F.col("appeal_outcome").isNotNull())
    return rows.groupBy(F.col("primary_denial_reason").alias("denial_reason")).agg(
        _n("appeals"), s.total("appeal_amount_recovered").alias("recovered"), s.ratio(F.sum("appeal_amount_recovered"), F.sum("billed_amount")).alias("recovered_share"))


@query("q024_payer_mix_shift")
def _(w):
    rows = w["fact_claim"].filter(_in("claim_date_key", LAST_YEAR)).withColumn("year_month", s.ym_label("claim_date_key"))
    return agg.payer_mix(rows, w["dim_payer"], ["year_month"])


query("q025_overall_denials")(lambda w: metrics.evaluate(w, ["total_claims", "total_billed", "denial_rate", "at_risk_revenue_high"]))
_evaluated("q026_denials_by_payer", ["total_claims", "denial_rate", "avg_denial_risk"], [PAYER, "dim_payer.payer_type"])
_evaluated("q027_collection_by_payer", ["total_billed", "total_paid", "collection_rate", "net_collection_rate"], [PAYER, "dim_payer.payer_type"])
_evaluated("q028_revenue_at_risk", ["at_risk_revenue", "high_risk_denials"], [PAYER])
_evaluated("q029_billed_vs_paid", ["total_billed", "total_paid", "collection_rate", "total_claims"], MONTH, filters=_within(LAST_YEAR))
_evaluated("q030_slow_payers", ["total_claims", "avg_days_to_payment", "collection_rate"], [PAYER, "dim_payer.payer_type"])
query("q031_ar_aging")(lambda w: agg.ar_aging(w["fact_claim"], w["dim_payer"]))


@query("q032_appeal_return_by_payer")
def _(w):
    won = F.col("appeal_outcome").isin("Overturned", "Partial")
    return w["agg_appeal_outcomes"].groupBy("payer_name").agg(F.sum("appeal_count").alias("appeals"), F.coalesce(F.sum(F.when(won, F.col("appeal_count"))), F.lit(0)).alias("won"),
                                                             fraud.money_of("total_amount_recovered").alias("recovered"))


_evaluated("q033_payer_mix", ["total_payers", "total_claims", "total_billed", "total_paid", "collection_rate"], ["dim_payer.payer_type"])
_evaluated("q034_drg_costs", ["total_encounters", "total_charges", "total_cost", "total_expected_reimbursement"], _DRG, top=15, order="total_cost")


@query("q035_ytd_vs_prior_year")
def _(w):
    months = metrics.evaluate(w, ["total_charges", "total_encounters"], ["dim_date.year", "dim_date.month_number"], filters=[("dim_date.month_number", lambda c: c <= 7)])
    years = months.groupBy("year").agg(fraud.money_of("total_charges").alias("ytd_charges"), F.sum("total_encounters").alias("total_encounters"))
    return metrics.prior_year(years, "ytd_charges").filter(F.col("year") == 2001)


_evaluated("q036_reasons_at_risk", ["total_claims", "at_risk_revenue_high", "avg_denial_risk"], ["fact_claim.primary_denial_reason"], filters=_within(LAST_QUARTER), top=10, order="at_risk_revenue_high")

# --- denials ---------------------------------------------------------------------------------------


@query("q037_denials_overall_and_by_payer")
def _(w):
    names = ["total_claims", "denial_rate"]
    return metrics.evaluate(w, names).select(F.lit("(all)").alias("payer_name"), *names).unionByName(metrics.evaluate(w, names, [PAYER]))


@query("q038_top_denial_reasons")
def _(w):
    rows = w["fact_claim"].filter(_denied()).groupBy("primary_denial_reason").agg(_n("claims"), s.total("billed_amount").alias("billed"))
    return rows.orderBy(F.col("claims").desc(), "primary_denial_reason").limit(5)


@query("q039_provider_denial_rates")
def _(w):
    rows = w["fact_claim"].groupBy("provider_key").agg(_n("claims"), _rate(_denied(), "denial_rate")).join(graph.providers(w), "provider_key")
    return rows.orderBy(F.col("denial_rate").desc(), "provider_id").limit(10).select("provider_id", "display_name", "specialty", "claims", "denial_rate")


@query("q040_large_denied_claims")
def _(w):
    rows = w["fact_claim"].filter(_denied() & (F.col("billed_amount") > 50000))
    return star(w, rows, "patient", "payer").select("claim_id", "patient_id", "payer_name", "primary_denial_reason", F.col("billed_amount").cast("double").alias("billed_amount"))


def _scored_claims(w: Warehouse) -> DataFrame:
    """Claims with the risk given before adjudication."""
    return w["claims_clean"].filter(F.col("denial_risk_category") == "High")


@query("q041_risk_not_denied")
def _(w):
    return _scored_claims(w).filter(F.col("denial_flag") == 0).agg(_n("claims"), s.total("billed_amount").alias("revenue_at_risk"))


@query("q042_risk_pending")
def _(w):
    return _scored_claims(w).filter(F.col("claim_status") == "Pending").select("claim_id", "patient_id", "payer_id", "denial_risk_score", F.col("billed_amount").cast("double").alias("billed_amount"))


query("q043_risk_categories")(lambda w: w["fact_claim"].groupBy("denial_risk_category").agg(_n("claims")))

# --- readmission -------------------------------------------------------------------------------------

_evaluated("q044_readmission_by_month", ["readmission_rate", "total_encounters"], MONTH[:2])


@query("q045_riskiest_patients")
def _(w):
    top = w["fact_encounter"].groupBy("patient_key").agg(F.max("readmission_risk_score").alias("max_risk")).join(w["dim_patient"], "patient_key")
    return top.orderBy(F.col("max_risk").desc(), "patient_id").limit(10).select("patient_id", "max_risk", "age", "insurance_type")


_evaluated("q046_rate_by_type", ["readmission_rate"], ["fact_encounter.encounter_type"])
_evaluated("q047_rate_by_facility", ["total_encounters", "readmission_rate"], ["dim_facility.facility_name"])


@query("q048_stay_by_risk")
def _(w):
    return w["fact_encounter"].filter(F.col("readmission_risk_category").isin("High", "Low")).groupBy("readmission_risk_category").agg(agg.mean_score("length_of_stay").alias("avg_los"))


query("q049_encounters_by_risk")(lambda w: w["fact_encounter"].groupBy("readmission_risk_category").agg(_n("encounters")))

# --- adherence ------------------------------------------------------------------------------------------


@query("q050_non_adherent_members")
def _(w):
    return star(w, _non_adherent(w), "patient").select("patient_id", "drug_class", "gap_days", s.rounded("pdc_score", 6).alias("pdc_score"))


@query("q051_adherence_rates")
def _(w):
    return w["agg_medication_adherence"].groupBy("drug_class", "therapeutic_area").agg(_rate(F.col("adherence_category") == "Adherent", "adherent_rate"), agg.mean_score("pdc_score").alias("avg_pdc"))


@query("q052_chronic_non_adherent")
def _(w):
    ill = w["fact_diagnosis"].join(w["dim_diagnosis"].filter(F.col("is_chronic") == 1).select("diagnosis_key"), "diagnosis_key").select("patient_key").distinct()
    return _non_adherent_patients(w).join(ill, "patient_key").join(graph.patients(w), "patient_key").select("patient_id", "non_adherent_drugs", "avg_pdc")


@query("q053_patients_by_adherence")
def _(w):
    return w["agg_medication_adherence"].groupBy("adherence_category").agg(F.countDistinct("patient_key").alias("patients"), _n("pairs"))


@query("q054_rx_cost_by_class")
def _(w):
    return star(w, "fact_prescription", "medication").groupBy("drug_class", "therapeutic_area").agg(_n("fills"), s.total("total_cost").alias("total_cost"), s.total("patient_copay").alias("copay"))


# --- social risk --------------------------------------------------------------------------------------------

@query("q055_vulnerable_members")
def _(w):
    places = graph.communities(w).filter(F.col("sdoh_tier") == "High")
    return graph.patients(w, "zip_code").join(places, "zip_code").select("patient_id", "zip_code", "social_vulnerability_index", "poverty_rate", "food_desert_flag")


_evaluated("q056_sdoh_risk", ["avg_readmission_risk", "readmission_rate"], [SDOH])
query("q057_readmission_by_payer")(graph.readmission_by_payer)


@query("q058_readmitted_social_risk")
def _(w):
    back = w["fact_encounter"].filter(F.col("readmission_flag") == 1).groupBy("patient_key").agg(_n("readmissions"))
    care = w["agg_medication_adherence"].groupBy("patient_key").agg(agg.mean_score("pdc_score").alias("avg_pdc"))
    return star(w, back, "patient", "sdoh").join(care, "patient_key", "left").select("patient_id", "readmissions", "sdoh_tier", "social_vulnerability_index", "avg_pdc")


_evaluated("q059_stay_by_type", ["avg_length_of_stay"], ["fact_encounter.encounter_type"])


@query("q060_top_diagnoses")
def _(w):
    rows = star(w, "fact_diagnosis", "diagnosis").groupBy("icd_code", "icd_description").agg(_n("diagnoses"))
    return rows.orderBy(F.col("diagnoses").desc(), "icd_code").limit(10)


_evaluated("q061_chronic_prevalence", ["patients_with_chronic_conditions"], ["dim_diagnosis.icd_description"])


@query("q062_top_rx_patients")
def _(w):
    rows = w["fact_prescription"].groupBy("patient_key").agg(s.total("total_cost").alias("rx_cost"), _n("fills")).join(graph.patients(w), "patient_key")
    return rows.orderBy(F.col("rx_cost").desc(), "patient_id").limit(10).select("patient_id", "rx_cost", "fills")


_evaluated("q063_age_groups", ["total_patients"], ["dim_patient.age_group"])

# --- prescriptions by payer -----------------------------------------------------------------------------------


def _rx_money() -> list[Column]:
    return [_n("fills"), s.total("total_cost").alias("total_cost"), s.total("payer_paid").alias("payer_paid"), s.total("patient_copay").alias("copay")]


@query("q064_rx_cost_by_payer")
def _(w):
    rows = star(w, "fact_prescription", "payer").groupBy("payer_name").agg(*_rx_money())
    return rows.withColumn("copay_share", s.rounded(s.ratio(F.col("copay"), F.col("total_cost")), 6))


@query("q065_copay_by_payer_and_class")
def _(w):
    return star(w, "fact_prescription", "payer", "medication").groupBy("payer_name", "drug_class").agg(s.mean_money("patient_copay").alias("avg_copay"))


@query("q066_chronic_rx_burden")
def _(w):
    return star(w, "fact_prescription", "payer", "medication").filter(F.col("chronic_med") == 1).groupBy("payer_name").agg(s.total("payer_paid").alias("payer_paid"), _n("fills"))


@query("q067_rx_network")
def _(w):
    rows = w["fact_prescription"].groupBy("provider_key", "payer_key").agg(_n("prescriptions"), s.total("payer_paid").alias("payer_paid"))
    return rows.join(graph.providers(w), "provider_key").join(graph.payers(w), "payer_key").select("provider_id", "payer_name", "prescriptions", "payer_paid")


@query("q068_reimbursement_gap")
def _(w):
    df = metrics.evaluate(w, ["total_billed", "total_paid", "collection_rate"], [PAYER])
    return df.withColumn("gap", s.rounded(F.col("total_billed") - F.col("total_paid"), 2))


# --- across domains -------------------------------------------------------------------------------------------

@query("q069_readmitted_non_adherent")
def _(w):
    back = w["fact_encounter"].filter(F.col("readmission_flag") == 1).groupBy("patient_key").agg(F.max("readmission_risk_score").alias("max_risk"))
    rows = _non_adherent(w).select("patient_key", "drug_class", "gap_days").join(back, "patient_key")
    return star(w, rows, "patient").select("patient_id", "max_risk", "drug_class", "gap_days")


@query("q070_denied_with_diagnosis")
def _(w):
    icd = w["dim_diagnosis"].select(F.col("icd_code").alias("primary_diagnosis_code"), "icd_description")
    return w["fact_claim"].filter(_denied()).join(icd, "primary_diagnosis_code", "left").select("claim_id", "primary_diagnosis_code", "icd_description", "primary_denial_reason")


@query("q071_encounters_with_denials")
def _(w):
    denied = w["fact_claim"].filter(_denied() & F.col("encounter_key").isNotNull()).groupBy("encounter_key").agg(_n("denied_claims"), s.total("billed_amount").alias("denied_billed"))
    return denied.join(w["fact_encounter"].select("encounter_key", "encounter_id", "encounter_type"), "encounter_key").drop("encounter_key")


@query("q072_poverty_denials")
def _(w):
    poor = star(w, "fact_claim", "patient", "sdoh").filter(F.col("poverty_rate") > 0.25)
    return union_all([df.agg(F.lit(name).alias("population"), _n("claims"), _rate(_denied(), "denial_rate")) for name, df in (("high_poverty", poor), ("all", w["fact_claim"]))])


@query("q073_candidates_by_payer")
def _(w):
    people = _high_risk(w).join(_non_adherent_patients(w), "patient_key").select("patient_key")
    rows = w["fact_claim"].join(people, "patient_key")
    return star(w, rows, "payer").groupBy("payer_name").agg(F.countDistinct("patient_key").alias("patients"), s.total("billed_amount").alias("billed"), s.total("paid_amount").alias("paid"))


# --- graph: providers ----------------------------------------------------------------------------------------------

ONE_PROVIDER, ONE_PAYER, ONE_PATIENT, ONE_MEDICATION, ONE_ENCOUNTER = "PRV000000000003", "Medicaid Plan 3", "PAT000000000007", "Med Brand#7 10 MG", "ENC000000000100"
query("q074_provider_profile")(lambda w: graph.profile_counts(w, ONE_PROVIDER))


@query("q075_denied_by_provider")
def _(w):
    return star(w, w["fact_claim"].filter(_denied()), "provider", "payer", "patient").select("provider_id", "display_name", "claim_id", "primary_denial_reason", "payer_name", "patient_id")


@query("q076_patient_panel")
def _(w):
    panel = w["fact_encounter"].join(graph.providers(w).filter(F.col("provider_id") == ONE_PROVIDER), "provider_key")
    dx = w["fact_diagnosis"].join(panel.select("encounter_key"), "encounter_key", "left_semi").groupBy("encounter_key").agg(_n("diagnoses"))
    return star(w, panel, "patient").join(dx, "encounter_key", "left").select("patient_id", "encounter_id", "encounter_type", "readmission_flag", "diagnoses")


@query("q077_specialty_prescribing")
def _(w):
    rows = star(w, "fact_prescription", "provider").filter(F.col("specialty") == "Cardiology")
    return star(w, rows, "medication", "payer").groupBy("medication_name", "payer_name").agg(_n("prescriptions"), F.countDistinct("patient_key").alias("patients"))


@query("q078_high_risk_by_provider")
def _(w):
    risky = w["fact_encounter"].filter(F.col("readmission_risk_category") == "High").select("encounter_key", "provider_key", "patient_key")
    conditions = _chronic_of_encounter(w).join(risky, "encounter_key").groupBy("provider_key").agg(F.countDistinct("diagnosis_key").alias("conditions"))
    people = risky.groupBy("provider_key").agg(F.countDistinct("patient_key").alias("high_risk_patients"))
    return people.join(conditions, "provider_key", "left").join(graph.providers(w), "provider_key").select("provider_id", "display_name", "high_risk_patients", "conditions")


@query("q079_providers_in_vulnerable_areas")
def _(w):
    rows = star(w, "fact_encounter", "patient", "sdoh").filter(F.col("sdoh_tier") == "High")
    return star(w, rows, "provider").filter(F.col("provider_id").isNotNull()).groupBy("provider_id", "specialty").agg(
        F.countDistinct("patient_key").alias("patients"), agg.mean_score("social_vulnerability_index").alias("avg_svi"))


# --- graph: payers ---------------------------------------------------------------------------------------------------

def _claims_of(w: Warehouse, payer: str) -> DataFrame:
    return w["fact_claim"].join(w["dim_payer"].filter(F.col("payer_name") == payer).select("payer_key", "payer_name"), "payer_key")


@query("q080_claims_of_payer")
def _(w):
    return star(w, _claims_of(w, ONE_PAYER), "provider", "patient").select("claim_id", "provider_id", "patient_id", "claim_status", "primary_denial_reason")


@query("q081_denials_by_payer")
def _(w):
    rows = star(w, w["fact_claim"].filter(_denied()), "payer")
    return rows.groupBy("payer_name", "primary_denial_reason").agg(_n("denied"), F.countDistinct("provider_key").alias("providers"), F.countDistinct("patient_key").alias("patients"),
                                                                   F.countDistinct("encounter_key").alias("encounters"))


@query("q082_rx_by_payer")
def _(w):
    rows = star(w, "fact_prescription", "payer", "medication")
    return rows.groupBy("payer_name", "medication_name").agg(_n("prescriptions"), F.countDistinct("provider_key").alias("providers"), F.countDistinct("patient_key").alias("patients"))


@query("q083_network_of_payer")
def _(w):
    kinds = w["fact_encounter"].select("encounter_key", "encounter_type")
    rows = _claims_of(w, ONE_PAYER).join(kinds, "encounter_key", "left")
    return star(w, rows, "provider").groupBy("provider_id", "encounter_type").agg(_n("claims"))


@query("q084_payers_in_vulnerable_areas")
def _(w):
    rows = star(w, "fact_claim", "patient", "sdoh").filter(F.col("sdoh_tier") == "High")
    return star(w, rows, "payer").groupBy("payer_name").agg(F.countDistinct("patient_key").alias("patients"), _n("claims"), agg.mean_score("poverty_rate").alias("avg_poverty"))


# --- graph: tracing ------------------------------------------------------------------------------------------------------

def _story(w: Warehouse, claims: DataFrame) -> DataFrame:
    visits = w["fact_encounter"].select("encounter_key", "encounter_id", "encounter_type", "readmission_risk_category")
    rows = star(w, claims, "patient", "provider", "payer").join(visits, "encounter_key", "left")
    return rows.select("claim_id", "patient_id", "encounter_id", "encounter_type", "provider_id", "payer_name", "claim_status", "primary_denial_reason", F.col("billed_amount").cast("double").alias("billed_amount"))


@query("q085_trace_claim")
def _(w):
    first = w["fact_claim"].filter(_denied()).agg(F.min("claim_id").alias("claim_id"))
    return _story(w, w["fact_claim"].join(first, "claim_id", "left_semi"))


query("q086_denied_story")(lambda w: _story(w, w["fact_claim"].filter(_denied())))


@query("q087_claims_of_encounter")
def _(w):
    visit = w["fact_encounter"].filter(F.col("encounter_id") == ONE_ENCOUNTER).select("encounter_key")
    return _story(w, w["fact_claim"].join(visit, "encounter_key", "left_semi"))


@query("q088_denied_of_high_risk")
def _(w):
    return _story(w, w["fact_claim"].filter(_denied()).join(_high_risk(w).select("patient_key"), "patient_key", "left_semi"))


@query("q089_costly_encounters")
def _(w):
    claims = w["fact_claim"].groupBy("encounter_key").agg(_n("claims"), F.max("denial_flag").alias("any_denied"))
    dx = w["fact_diagnosis"].groupBy("encounter_key").agg(_n("diagnoses"))
    rows = w["fact_encounter"].filter(F.col("total_charges") > 400000).join(claims, "encounter_key", "left").join(dx, "encounter_key", "left")
    return star(w, rows, "provider").select("encounter_id", "provider_id", F.col("total_charges").cast("double").alias("total_charges"), "claims", "any_denied", "diagnoses")


query("q090_claims_network")(graph.provider_payer_network)


@query("q091_chronic_rx_network")
def _(w):
    rows = star(w, "fact_prescription", "medication", "payer").filter(F.col("chronic_med") == 1)
    return rows.groupBy("medication_name", "payer_name").agg(F.countDistinct("provider_key").alias("providers"), s.total("payer_paid").alias("payer_paid"))


@query("q092_denials_by_diagnosis")
def _(w):
    icd = w["dim_diagnosis"].select(F.col("icd_code").alias("primary_diagnosis_code"), "icd_category")
    return w["fact_claim"].join(icd, "primary_diagnosis_code", "left").groupBy("icd_category").agg(_n("claims"), F.count_if(_denied()).alias("denied"), _rate(_denied(), "denial_rate"))


@query("q093_rx_burden")
def _(w):
    return star(w, "fact_prescription", "payer", "medication").groupBy("payer_name", "drug_class").agg(*_rx_money())


# --- graph: interventions ---------------------------------------------------------------------------------------------------

@query("q094_poor_adherence_network")
def _(w):
    people = _non_adherent_patients(w).select("patient_key")
    rows = w["fact_prescription"].join(people, "patient_key", "left_semi").groupBy("patient_key").agg(F.countDistinct("provider_key").alias("providers"), F.countDistinct("payer_key").alias("payers"))
    return rows.join(graph.patients(w), "patient_key").select("patient_id", "providers", "payers")


@query("q095_cover_by_class")
def _(w):
    return star(w, "fact_prescription", "medication", "payer").groupBy("drug_class", "payer_name").agg(*_rx_money())


@query("q096_most_vulnerable")
def _(w):
    people = _high_risk(w).join(_non_adherent_patients(w).select("patient_key"), "patient_key", "left_semi")
    chosen = star(w, people, "patient", "sdoh").filter(F.col("sdoh_tier") == "High")
    claims = w["fact_claim"].join(chosen.select("patient_key"), "patient_key", "left_semi").groupBy("patient_key").agg(F.countDistinct("provider_key").alias("providers"), F.countDistinct("payer_key").alias("payers"))
    return chosen.join(claims, "patient_key", "left").select("patient_id", "max_risk", "social_vulnerability_index", "providers", "payers")


@query("q097_network_averages")
def _(w):
    denials = metrics.evaluate(w, ["denial_rate"], [PAYER]).select(F.lit("denial_rate").alias("metric"), F.col("payer_name").alias("name"), F.col("denial_rate").alias("value"))
    costs = metrics.evaluate(w, ["avg_cost_per_encounter"], ["dim_provider.provider_id"]).select(F.lit("avg_cost").alias("metric"), F.col("provider_id").alias("name"), F.col("avg_cost_per_encounter").alias("value"))
    return denials.unionByName(costs)


# --- prescription lifecycle -----------------------------------------------------------------------------------------------------

def _rx_trail(w: Warehouse, rx: DataFrame) -> DataFrame:
    rows = star(w, rx, "patient", "provider", "payer", "medication")
    return rows.select("prescription_id", "patient_id", "medication_name", "provider_id", "payer_name", *[F.col(c).cast("double").alias(c) for c in ("total_cost", "payer_paid", "patient_copay")])


@query("q098_patient_prescriptions")
def _(w):
    return _rx_trail(w, w["fact_prescription"].join(graph.patients(w).filter(F.col("patient_id") == ONE_PATIENT).select("patient_key"), "patient_key", "left_semi"))


@query("q099_costliest_prescriptions")
def _(w):
    return _rx_trail(w, w["fact_prescription"].orderBy(F.col("total_cost").desc(), "prescription_id").limit(20))


@query("q100_medication_lifecycle")
def _(w):
    drug = w["dim_medication"].filter(F.col("medication_name") == ONE_MEDICATION).select("medication_key")
    return _rx_trail(w, w["fact_prescription"].join(drug, "medication_key", "left_semi"))


@query("q101_brand_prescribing")
def _(w):
    rows = w["fact_prescription"].filter(F.col("is_generic") == 0).groupBy("provider_key", "payer_key").agg(_n("prescriptions"), s.total("payer_paid").alias("payer_paid"))
    return rows.join(graph.providers(w), "provider_key").join(graph.payers(w), "payer_key", "left").select("provider_id", "payer_name", "prescriptions", "payer_paid")


@query("q102_food_desert_rx")
def _(w):
    rows = star(w, "fact_prescription", "patient", "sdoh", "medication").filter((F.col("food_desert_flag") == 1) & (F.col("chronic_med") == 1))
    return star(w, rows, "payer").groupBy("payer_name").agg(*_rx_money())


# --- live: fraud, gaps, cost ----------------------------------------------------------------------------------------------------------

@query("q103_top_fraud_providers")
def _(w):
    rows = w["fraud_scores"].groupBy("provider_id").agg(
        F.max("fraud_score").alias("max_score"), F.array_join(F.sort_array(F.collect_set(F.when(F.col("fraud_flags") != "", F.col("fraud_flags")))), ",").alias("flags"),
        F.coalesce(F.sum(F.when(F.col("fraud_flags") != "", F.col("claim_amount").cast("decimal(18,2)"))), F.lit(0)).cast("double").alias("flagged_amount"))
    return rows.orderBy(F.col("max_score").desc(), "provider_id").limit(10)


query("q104_claims_by_fraud_tier")(lambda w: w["fraud_scores"].groupBy("risk_tier").agg(_n("claims")))
query("q105_gaps_by_facility")(lambda w: w["care_gap_alerts"].groupBy("facility_name", "measure_id").agg(_n("alerts")))


@query("q106_critical_gaps")
def _(w):
    return w["care_gap_alerts"].filter(F.col("alert_priority") == "CRITICAL").groupBy("measure_id").agg(F.countDistinct("patient_id").alias("patients"), F.max("gap_days_overdue").alias("max_overdue"))


def _accelerating(w: Warehouse) -> DataFrame:
    return w["highcost_alerts"].filter(F.col("cost_trend") == "ACCELERATING").select("patient_id", "rolling_spend_30d", "ed_visits_30d", "readmission_flag", "risk_tier")


query("q107_accelerating_members")(_accelerating)


@query("q108_geo_anomaly_amount")
def _(w):
    return w["fraud_scores"].filter(F.col("fraud_flags").contains("geo_anomaly")).agg(_n("claims"), fraud.money_of("claim_amount").alias("flagged_amount"))


@query("q109_cost_and_gaps")
def _(w):
    gaps = w["care_gap_alerts"].groupBy("patient_id").agg(F.countDistinct("measure_id").alias("open_gaps"))
    return w["highcost_alerts"].filter(F.col("risk_tier").isin("CRITICAL", "HIGH")).join(gaps, "patient_id").select("patient_id", "risk_tier", "rolling_spend_30d", "open_gaps")


# --- live: operations ---------------------------------------------------------------------------------------------------------------------

query("q110_top_priorities")(lambda w: views.worklist(w["worklist_alerts"], 10))


@query("q111_critical_by_facility")
def _(w):
    return w["all_alerts"].filter((F.col("severity") == "CRITICAL") & (F.col("facility_id") != "")).groupBy("facility_id").agg(_n("critical_alerts"))


query("q112_pipeline_on_time")(lambda w: events.freshness({"claims_events": w["claims_events"]}, w.now))


@query("q113_fraud_and_cost")
def _(w):
    risky = w["fraud_scores"].filter(F.col("risk_tier").isin("CRITICAL", "HIGH")).groupBy("patient_id").agg(F.max("fraud_score").alias("max_score"))
    return w["highcost_alerts"].filter(F.col("risk_tier").isin("CRITICAL", "HIGH")).join(risky, "patient_id").select("patient_id", "rolling_spend_30d", "max_score")


@query("q114_unresolved_criticals")
def _(w):
    rows = tiles.k19_open_alerts(w["persona_alerts"], w["alert_closure_events"], w.now, "24 hours")
    return rows.filter(F.col("severity") == "CRITICAL").groupBy("persona").agg(_n("unresolved"))


@query("q115_time_to_alert")
def _(w):
    landed = w["landing_parsed"].filter(F.col("_corrupt_record").isNull()).select(F.col("event_id").alias("alert_id"), "ingest_ts")
    rows = w["all_alerts"].join(landed, "alert_id").groupBy("source_table")
    return rows.agg(_n("alerts"), s.rounded(F.avg(F.timestamp_diff("SECOND", F.col("alert_timestamp"), F.col("ingest_ts"))), 6).alias("avg_seconds"))


def _backlog(persona: str):
    def build(w: Warehouse) -> DataFrame:
        rows = tiles.k19_open_alerts(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)
        return rows.filter(F.col("persona") == persona).groupBy("severity").agg(_n("open_alerts"))

    return build


# --- live: clinical -----------------------------------------------------------------------------------------------------------------------------

query("q116_deteriorating")(lambda w: tiles.k13_deterioration(w["clinical_deterioration_events"], w.now, "24 hours"))
query("q117_hai_clusters")(lambda w: tiles.k14_hai_clusters(w["mortality_hai_events"], w.now))
query("q118_quality_drift")(lambda w: tiles.k15_drift_watchlist(w["provider_alerts"], w.now, "8 hours"))


@query("q119_just_readmitted")
def _(w):
    rows = lookback(w["provider_alerts"], "alert_timestamp", w.now, "24 hours").filter(F.col("alert_type") == "READMISSION_30DAY")
    return rows.select("alert_id", "patient_id", "severity", F.col("metric_value").alias("days_since_discharge"))


query("q120_risk_and_adherence")(_candidates)
query("q121_backlog_clinical")(_backlog("CMO"))
query("q122_variance_by_contract")(lambda w: tiles.k16_revenue_variance(w["net_revenue_variance_events"], w.now, "24 hours"))


@query("q123_underpayments")
def _(w):
    return scores.underpayments(lookback(w["net_revenue_variance_events"], TS, w.now, "6 hours")).select("event_id", "payer_name", "contract_id", "variance_pct", "variance_dollars")


query("q124_fraud_exposure")(lambda w: fraud.fraud_top_providers(w["fraud_scores"], w["dim_provider"], 25))
query("q125_accelerating_cost")(_accelerating)
query("q126_backlog_revenue")(_backlog("CFO"))


@query("q127_gap_closures")
def _(w):
    closed = views.alert_mttr(w["all_alerts"].filter(F.col("alert_type") == "CARE_GAP"), w["alert_closure_events"]).select("alert_id", "status")
    rows = w["care_gap_alerts"].select("alert_id", "measure_id").join(closed, "alert_id")
    return rows.groupBy("measure_id").agg(F.count_if(F.col("status") == "CLOSED").alias("closed"), F.count_if(F.col("status") == "OPEN").alias("open"))


query("q128_ed_boarding")(lambda w: tiles.k17_ed_boarding(w["ops_capacity_events"], w.now, "24 hours"))
query("q129_full_units")(lambda w: tiles.k17_bed_occupancy(w["ops_capacity_events"], w.now, WEEK).filter(F.col("utilization_pct") >= 95))


@query("q130_slow_turnover")
def _(w):
    latest = tiles.latest_by(lookback(w["ops_capacity_events"].filter(F.col("capacity_type") == "OR_TURNOVER"), TS, w.now, WEEK), ["facility_id"], TS, "event_id")
    return latest.filter(F.col("current_value") > 60).select("facility_id", "ward", "current_value")


query("q131_staffing_gaps")(lambda w: tiles.k17_staffing_gap(w["staffing_acuity_events"], w.now, "24 hours"))
query("q132_long_stays")(lambda w: tiles.k17_los_outliers(w["ops_capacity_events"], w.now, WEEK))
query("q133_backlog_operations")(_backlog("COO"))


@query("q134_rules_in_breach")
def _(w):
    from wardlight.operators import alerts

    breaches = alerts.dq_alerts(w["dq_violation_events"], cto_limits(w), w.now, "24 hours")
    return breaches.select("alert_id", "source_system", "severity", "metric_value")


query("q135_lag_by_type")(lambda w: events.ingest_lag(w["landing_parsed"], ["_table", "event_type"]).withColumnRenamed("_table", "tag"))
query("q136_phi_anomalies")(lambda w: tiles.k18_phi_map(w["audit_access_events"], w.now, "24 hours"))
query("q137_drifting_models")(lambda w: tiles.k18_model_drift(w["model_drift_events"], w.now, WEEK))
query("q138_backlog_platform")(_backlog("CTO"))
