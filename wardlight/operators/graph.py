"""Graph questions over the star schema: edges are key pairs, patterns are joins.

Every pattern starts at one fact and follows its keys; two facts are only joined on the
key of the node they share, after each was reduced, so no pattern multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.events import union_all
from wardlight.operators.quality import fk_coverage

Tables = Mapping[str, DataFrame]

# --- fixed values: node -> (table, key); edge -> (table, node key, other end's key, from, to) ---
NODES: dict[str, tuple[str, str]] = {
    "Patient": ("dim_patient", "patient_key"), "Provider": ("dim_provider", "provider_key"), "Payer": ("dim_payer", "payer_key"), "Medication": ("dim_medication", "medication_key"),
    "Diagnosis": ("dim_diagnosis", "diagnosis_key"), "CommunityHealth": ("dim_sdoh", "zip_code"), "Encounter": ("fact_encounter", "encounter_key"), "Claim": ("fact_claim", "claim_key"),
    "Prescription": ("fact_prescription", "prescription_key"), "PatientDiagnosis": ("fact_diagnosis", "fact_diagnosis_key"), "MedicationAdherence": ("agg_medication_adherence", "adherence_key"),
}
EDGES: dict[str, tuple[str, str, str]] = {
    "livesIn": ("dim_patient", "patient_key", "zip_code"),
    "references": ("fact_diagnosis", "fact_diagnosis_key", "diagnosis_key"),
    "affects": ("fact_diagnosis", "fact_diagnosis_key", "patient_key"),
    "dispenses": ("fact_prescription", "prescription_key", "medication_key"),
    "PrescriptionHasPayer": ("fact_prescription", "prescription_key", "payer_key"),
    "prescribedBy": ("fact_prescription", "prescription_key", "provider_key"),
    "serves": ("fact_prescription", "prescription_key", "patient_key"),
    "ClaimHasPayer": ("fact_claim", "claim_key", "payer_key"),
    "submittedBy": ("fact_claim", "claim_key", "provider_key"),
    "covers": ("fact_claim", "claim_key", "patient_key"),
    "involves": ("fact_encounter", "encounter_key", "patient_key"),
    "treatedBy": ("fact_encounter", "encounter_key", "provider_key"),
    "billsFor": ("fact_claim", "claim_key", "encounter_key"),
    "originatesFrom": ("fact_prescription", "prescription_key", "encounter_key"),
    "occursIn": ("fact_diagnosis", "fact_diagnosis_key", "encounter_key"),
    "adherenceFor": ("agg_medication_adherence", "adherence_key", "patient_key"),
    "adherenceMedication": ("agg_medication_adherence", "adherence_key", "medication_key"),
}


def edge(t: Tables, name: str) -> DataFrame:
    """Source and target keys of one edge type; rows without a target have no edge."""
    table, src, dst = EDGES[name]
    return t[table].select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter(F.col("dst").isNotNull())


def payer_name_edge(t: Tables, table: str) -> DataFrame:
    """Edges of a summary to payers, found by name."""
    names = t["dim_payer"].select("payer_name", "payer_key")
    return t[table].join(names, "payer_name").groupBy("payer_name", "payer_key").agg(F.count(F.lit(1)).alias("edges"))


def node_counts(t: Tables) -> DataFrame:
    return union_all([t[table].agg(F.count(F.lit(1)).alias("n")).select(F.lit("node").alias("kind"), F.lit(name).alias("name"), "n") for name, (table, _) in NODES.items()])


def edge_counts(t: Tables) -> DataFrame:
    return union_all([edge(t, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit("edge").alias("kind"), F.lit(name).alias("name"), "n") for name in EDGES])


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current") == 1) if "is_current" in df.columns else df


PROVIDER_COLUMNS = ["provider_key", "provider_id", "display_name", "specialty"]
PATIENT_COLUMNS = ["patient_key", "patient_id", "first_name", "last_name", "age", "gender"]


def providers(t: Tables, *more: str) -> DataFrame:
    return current(t["dim_provider"]).select(*PROVIDER_COLUMNS, *more)


def patients(t: Tables, *more: str) -> DataFrame:
    return current(t["dim_patient"]).select(*PATIENT_COLUMNS, *more)


def payers(t: Tables) -> DataFrame:
    return t["dim_payer"].select("payer_key", "payer_name", "payer_type")


def medications(t: Tables) -> DataFrame:
    return t["dim_medication"].select("medication_key", "medication_name", "generic_name", "drug_class", "therapeutic_area", "is_chronic")


def communities(t: Tables) -> DataFrame:
    return t["dim_sdoh"].select("zip_code", F.col("risk_tier").alias("sdoh_tier"), "social_vulnerability_index", "poverty_rate", "food_desert_flag")


def per_provider(t: Tables, fact: str, name: str) -> DataFrame:
    """One hop with a count: rows of a fact per clinician."""
    counts = t[fact].groupBy("provider_key").agg(F.count(F.lit(1)).alias(name))
    return counts.join(providers(t), "provider_key").select("provider_id", "display_name", "specialty", name)


def denied_claims(t: Tables) -> DataFrame:
    """Two hops from a shared node: denied claims with clinician and payer."""
    denied = t["fact_claim"].filter(F.col("denial_flag") == 1)
    return denied.join(providers(t), "provider_key").join(payers(t), "payer_key").select("claim_id", "display_name", "payer_name", "primary_denial_reason", "billed_amount")


def patient_panel(t: Tables, provider_id: str) -> DataFrame:
    """Encounters of one clinician's patients. The clinician is picked before anything is joined."""
    one = providers(t).filter(F.col("provider_id") == provider_id)
    return t["fact_encounter"].join(one, "provider_key").join(patients(t), "patient_key").select("display_name", "patient_id", "encounter_id", "encounter_type", "readmission_risk_category")


def prescribing(t: Tables, specialty: str) -> DataFrame:
    """Drugs prescribed within a specialty, along the prescription's own edge."""
    chosen = providers(t).filter(F.col("specialty") == specialty)
    rx = t["fact_prescription"].select("provider_key", "medication_key").join(chosen, "provider_key").join(medications(t), "medication_key")
    return rx.groupBy("provider_id", "display_name", "medication_name", "drug_class").agg(F.count(F.lit(1)).alias("prescriptions"))


def prescribing_via_encounter(t: Tables, specialty: str) -> DataFrame:
    """The same along the encounter in which the prescription arose."""
    chosen = providers(t).filter(F.col("specialty") == specialty)
    seen = t["fact_encounter"].select("encounter_key", "provider_key").join(chosen, "provider_key")
    rx = t["fact_prescription"].select("encounter_key", "medication_key").join(seen, "encounter_key").join(medications(t), "medication_key")
    return rx.groupBy("provider_id", "display_name", "medication_name").agg(F.count(F.lit(1)).alias("prescriptions"))


def high_risk_patients(t: Tables) -> DataFrame:
    risky = t["fact_encounter"].filter(F.col("readmission_risk_category") == "High")
    return risky.join(providers(t), "provider_key").join(patients(t), "patient_key").select("display_name", "patient_id", "encounter_id", "readmission_risk_score")


def vulnerable_communities(t: Tables, cond: Column) -> DataFrame:
    """Three edges: clinician, patient and community of an encounter, for communities that meet the condition."""
    places = communities(t).filter(cond)
    people = patients(t, "zip_code").join(places, "zip_code")
    rows = t["fact_encounter"].select("encounter_key", "provider_key", "patient_key").join(people, "patient_key").join(providers(t), "provider_key")
    return rows.groupBy("provider_id", "display_name", "patient_id", "zip_code", "sdoh_tier", "social_vulnerability_index").agg(F.count(F.lit(1)).alias("encounters"))


def adherence(t: Tables) -> DataFrame:
    """Adherence rows with patient and drug."""
    scores = t["agg_medication_adherence"].select("patient_key", "medication_key", "pdc_score", "adherence_category", "gap_days")
    return scores.join(patients(t), "patient_key").join(medications(t), "medication_key")


def adherence_candidates(t: Tables, first: str, last: str) -> DataFrame:
    """First step of a lookup by name: the patients it may mean."""
    named = patients(t).filter((F.col("first_name") == first) & (F.col("last_name") == last))
    return t["agg_medication_adherence"].select("patient_key").distinct().join(named, "patient_key").select("patient_id", "first_name", "last_name", "age", "gender")


def adherence_of(t: Tables, patient_id: str) -> DataFrame:
    """Second step: all drugs of one patient."""
    return adherence(t).filter(F.col("patient_id") == patient_id).select("patient_id", "drug_class", "medication_name", "is_chronic", "pdc_score", "adherence_category", "gap_days")


def non_adherent_ranking(t: Tables, n: int = 20) -> DataFrame:
    bad = t["agg_medication_adherence"].filter(F.col("adherence_category") == "Non-Adherent")
    counts = bad.groupBy("patient_key").agg(F.count(F.lit(1)).alias("non_adherent_drug_classes"))
    ranked = counts.join(patients(t), "patient_key").orderBy(F.col("non_adherent_drug_classes").desc(), "patient_id")
    return ranked.limit(n).select("patient_id", "first_name", "last_name", "age", "gender", "non_adherent_drug_classes")


def readmission_by_payer(t: Tables) -> DataFrame:
    """Claims of high-risk encounters over all claims with an encounter, per payer."""
    risk = t["fact_encounter"].select("encounter_key", "readmission_risk_category")
    rows = t["fact_claim"].select("encounter_key", "payer_key").join(risk, "encounter_key").join(payers(t), "payer_key")
    grouped = rows.groupBy("payer_name").agg(F.count_if(F.col("readmission_risk_category") == "High").alias("high_risk"), F.count(F.lit(1)).alias("total"))
    return grouped.withColumn("rate", s.ratio(F.col("high_risk"), F.col("total")))


def provider_profile(t: Tables, provider_id: str) -> dict[str, DataFrame]:
    """Everything about one clinician as separate results, never one product of them."""
    one = providers(t).filter(F.col("provider_id") == provider_id)
    key = one.select("provider_key")
    return {
        "provider": one,
        "patients": t["fact_encounter"].join(key, "provider_key").select("patient_key").distinct().join(patients(t), "patient_key"),
        "encounters": t["fact_encounter"].join(key, "provider_key").select("encounter_id", "encounter_type", "total_charges"),
        "claims": t["fact_claim"].join(key, "provider_key").select("claim_id", "claim_status", "billed_amount"),
        "prescriptions": t["fact_prescription"].join(key, "provider_key").select("prescription_id", "medication_key", "total_cost"),
    }


def profile_counts(t: Tables, provider_id: str) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n") for part, df in provider_profile(t, provider_id).items()])


def provider_payer_network(t: Tables) -> DataFrame:
    """Claims between each clinician and payer: rows, dollars, denials, patients."""
    grouped = t["fact_claim"].groupBy("provider_key", "payer_key").agg(
        F.count(F.lit(1)).alias("claims"), s.total("billed_amount").alias("billed"), F.count_if(F.col("denial_flag") == 1).alias("denied"), F.countDistinct("patient_key").alias("patients"))
    return grouped.join(providers(t), "provider_key").join(payers(t), "payer_key").select("provider_id", "display_name", "payer_name", "claims", "billed", "denied", "patients")


def edge_coverage(t: Tables) -> DataFrame:
    """Share of source rows that have the edge."""
    return union_all([fk_coverage(t[table], [dst], name) for name, (table, _, dst) in EDGES.items()]).withColumnRenamed("fact_name", "edge")
