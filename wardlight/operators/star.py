"""Facts with the descriptive columns of the dimensions a question needs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.operators.graph import communities, current, medications

Tables = Mapping[str, DataFrame]


def _patients(t: Tables) -> DataFrame:
    return current(t["dim_patient"]).select(
        "patient_key", "patient_id", F.col("first_name").alias("patient_first_name"), F.col("last_name").alias("patient_last_name"), "age", "age_group", "gender", "insurance_type", "zip_code")


def _providers(t: Tables) -> DataFrame:
    return current(t["dim_provider"]).select("provider_key", "provider_id", "display_name", "specialty", "documentation_score")


def _payers(t: Tables) -> DataFrame:
    return t["dim_payer"].select("payer_key", "payer_id", "payer_name", "payer_type")


def _facilities(t: Tables) -> DataFrame:
    return t["dim_facility"].select("facility_key", "facility_id", "facility_name", "facility_type")


def _medications(t: Tables) -> DataFrame:
    return medications(t).withColumnRenamed("is_chronic", "chronic_med")


def _diagnoses(t: Tables) -> DataFrame:
    return t["dim_diagnosis"].select("diagnosis_key", "icd_description", "icd_category", "is_chronic")


_DIMS = {"patient": (_patients, "patient_key"), "provider": (_providers, "provider_key"), "payer": (_payers, "payer_key"), "facility": (_facilities, "facility_key"),
         "medication": (_medications, "medication_key"), "diagnosis": (_diagnoses, "diagnosis_key"), "sdoh": (communities, "zip_code")}


def star(t: Tables, fact: str | DataFrame, *dims: str) -> DataFrame:
    """Left joins in the order given; ``sdoh`` needs ``patient`` before it."""
    df = t[fact] if isinstance(fact, str) else fact
    for dim in dims:
        build, key = _DIMS[dim]
        right = build(t)
        df = df.drop(*[c for c in right.columns if c in df.columns and c != key]).join(right, key, "left")
    return df
