"""Enrichment of the cleaned tables. The day of evaluation is always given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s


def as_date(day: str | Column) -> Column:
    return F.to_date(F.lit(day)) if isinstance(day, str) else day


def stamp_ods(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    return df.withColumn("_ods_load_timestamp", F.current_timestamp() if stamp is None else stamp)


def age_group(age: Column) -> Column:
    return (F.when(age < 18, "Pediatric").when(age < 40, "Young Adult").when(age < 65, "Adult").otherwise("Senior"))


def with_age(patients: DataFrame, as_of: str | Column) -> DataFrame:
    """Age in completed years and the four-band age group."""
    aged = patients.withColumn("age", s.years_between(as_date(as_of), "date_of_birth"))
    return aged.withColumn("age_group", age_group(F.col("age")))


def with_tenure(providers: DataFrame, as_of: str | Column) -> DataFrame:
    return providers.withColumn("years_of_service", s.years_between(as_date(as_of), "hire_date"))


def _facility_names(facilities: DataFrame) -> DataFrame:
    return facilities.select(F.col("id").alias("facility_id"), F.col("name").alias("facility_name"), F.col("type").alias("facility_type"))


def _join_facility(df: DataFrame, facilities: DataFrame) -> DataFrame:
    """Facility name and type; NULL columns when the rows carry no facility."""
    df = df.drop("facility_name", "facility_type")
    if "facility_id" not in df.columns:
        return df.withColumns({"facility_name": F.lit(None).cast("string"), "facility_type": F.lit(None).cast("string")})
    return df.join(_facility_names(facilities), "facility_id", "left")


def enrich_patients(patients: DataFrame, as_of: str | Column) -> DataFrame:
    return stamp_ods(with_age(patients, as_of))


def enrich_providers(providers: DataFrame, facilities: DataFrame, as_of: str | Column) -> DataFrame:
    return stamp_ods(with_tenure(_join_facility(providers, facilities), as_of))


def enrich_encounters(encounters: DataFrame, patients: DataFrame, providers: DataFrame, facilities: DataFrame) -> DataFrame:
    people = patients.select("patient_id", F.col("first_name").alias("patient_first_name"),
                             F.col("last_name").alias("patient_last_name"), "date_of_birth")
    clinicians = providers.select("provider_id", F.col("first_name").alias("provider_first_name"),
                                  F.col("last_name").alias("provider_last_name"), "specialty")
    joined = encounters.join(people, "patient_id", "left").join(clinicians, "provider_id", "left")
    return stamp_ods(_join_facility(joined, facilities))


def enrich_claims(claims: DataFrame, payers: DataFrame, as_of: str | Column) -> DataFrame:
    if "payer_id" in claims.columns:
        claims = claims.join(payers.select("payer_id", "payer_name", "payer_type"), "payer_id", "left")
    else:
        claims = claims.withColumns({"payer_name": F.lit(None).cast("string"), "payer_type": F.lit(None).cast("string")})
    paid_share = F.round(F.try_divide("paid_amount", "billed_amount"), 4).cast("double")
    return stamp_ods(claims.withColumns({
        "payment_ratio": F.when(F.col("billed_amount") > 0, paid_share).otherwise(F.lit(0.0)),
        "claim_age_days": F.datediff(as_date(as_of), F.col("claim_date")),
    }))


def enrich_prescriptions(prescriptions: DataFrame, medications: DataFrame, key: str = "rxnorm_code") -> DataFrame:
    """Drug attributes by code. Attributes whose name is taken get the prefix ``ref_``."""
    taken = set(prescriptions.columns)
    renamed = [F.col(c).alias(c if c == key or c not in taken else f"ref_{c}") for c in medications.columns]
    cost, copay, days = F.col("total_cost"), F.col("copay_amount"), F.col("days_supply")
    joined = prescriptions.join(medications.select(*renamed), key, "left")
    return stamp_ods(joined.withColumns({
        "cost_per_day": F.when(days > 0, F.round(F.try_divide(cost, days), 2).cast("double")).otherwise(F.lit(0.0)),
        "payer_coverage_pct": F.when((cost > 0) & copay.isNotNull(), F.round(F.try_divide(cost - copay, cost), 4).cast("double")).otherwise(F.lit(0.0)),
    }))


def enrich_diagnoses(diagnoses: DataFrame, icd: DataFrame, encounters: DataFrame) -> DataFrame:
    """Code description and the encounter's type and facility."""
    key = "icd_code" if "icd_code" in icd.columns else "code"
    taken = set(diagnoses.columns)
    codes = icd.select(F.col(key).alias("icd_code"),
                       *[F.col(c).alias(f"icd_{c}" if c in taken else c) for c in icd.columns if c != key])
    context = encounters.select("encounter_id", "encounter_type", "facility_id")
    return stamp_ods(diagnoses.join(codes, "icd_code", "left").join(context, "encounter_id", "left"))
