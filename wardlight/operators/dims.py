"""Dimension tables. Each ``dim_*_src`` gives the rows, the keys come from ``keys``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.keys import full_keys
from wardlight.operators.latest import dedup_latest
from wardlight.operators.ods import as_date

PATIENT_TRACKED = ["first_name", "last_name", "city", "state", "zip_code"]
PROVIDER_TRACKED = ["specialty", "department", "facility_id", "contract_type", "fte_status", "board_certified"]


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or NULL of that type when the input has none."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)


def date_spine(rows: DataFrame, day: str, years: int = 2) -> DataFrame:
    """One row per day of all calendar years in which a row falls, and of some years before and after."""
    first, last = F.make_date(F.year(F.min(day)) - years, F.lit(1), F.lit(1)), F.make_date(F.year(F.max(day)) + years, F.lit(12), F.lit(31))
    span = rows.agg(first.alias("first"), last.alias("last")).filter("first IS NOT NULL")
    return span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def dim_date(rows: DataFrame, day: str) -> DataFrame:
    """Calendar over the years of the facts, with a fiscal year that begins in July."""
    d = F.col("full_date")
    month = F.month(d)
    return date_spine(rows, day).select(
        s.date_key(d).alias("date_key"), d, F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        month.alias("month_number"), F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"), F.lit(0).alias("is_holiday"),
        (F.year(d) + F.when(month >= 7, 1).otherwise(0)).alias("fiscal_year"),
        F.when(month >= 7, F.floor((month - 7) / 3) + 1).otherwise(F.floor((month - 1) / 3) + 3).cast("int").alias("fiscal_quarter"),
    )


def dim_patient_src(patients: DataFrame, as_of: str | Column) -> DataFrame:
    """Patient attributes; age and group fall back to the date of birth."""
    age = F.coalesce(_or_null(patients, "age", "int"), s.years_between(as_date(as_of), "date_of_birth"))
    group = F.when(age < 18, "Pediatric").when(age < 65, "Adult").otherwise("Senior")
    given = ["first_name", "last_name", "date_of_birth", "gender"]
    optional = ["address", "city", "state", "zip_code", "phone", "email", "insurance_type", "insurance_provider"]
    return patients.select(
        "patient_id", *given, *[_or_null(patients, c) for c in optional],
        F.lit(None).cast("string").alias("insurance_policy_number"), age.alias("age"),
        F.coalesce(_or_null(patients, "age_group"), group).alias("age_group"),
    )


def dim_provider_src(providers: DataFrame) -> DataFrame:
    """Clinician attributes with their defaults."""

    def default(name: str, kind: str, blank) -> Column:
        return F.coalesce(_or_null(providers, name).try_cast(kind), F.lit(blank).cast(kind)).alias(name)

    return providers.select(
        "provider_id", "first_name", "last_name",
        F.concat(F.lit("Dr. "), F.col("first_name"), F.lit(" "), F.col("last_name")).alias("display_name"),
        _or_null(providers, "npi").alias("npi_number"), "specialty", default("department", "string", "General"),
        _or_null(providers, "facility_id"), F.when(F.col("is_active").cast("boolean"), 1).otherwise(0).alias("is_active"),
        default("contract_type", "string", "FFS"), default("fte_status", "string", "Full-time"),
        default("years_experience", "int", 0), default("board_certified", "boolean", False),
        default("patient_panel_size", "int", 0), default("annual_rvu_target", "int", 0), default("actual_rvu", "int", 0),
        default("patient_satisfaction_score", "double", 0.0), default("telehealth_enabled", "boolean", False),
        default("documentation_score", "int", 0), default("ehr_adoption_score", "int", 0),
    )


def payer_type_of(name: Column) -> Column:
    """Payer type read off the payer's name."""
    low = F.lower(name)
    return (F.when(low.contains("medicare"), "Medicare").when(low.contains("medicaid"), "Medicaid")
            .when(low.contains("self") | low.contains("cash"), "Self-Pay").otherwise("Commercial"))


def dim_payer_src(payers: DataFrame | None = None, ref_payers: DataFrame | None = None, claims: DataFrame | None = None) -> DataFrame:
    """First source at hand: payers, the reference list, or what the claims name."""
    src = payers if payers is not None else ref_payers if ref_payers is not None else claims.select("payer_id", "payer_name").distinct()
    kind = F.col("payer_type") if "payer_type" in src.columns else payer_type_of(F.col("payer_name")).alias("payer_type")
    extra = [c for c in ("plan_type", "state", "network_size", "avg_reimbursement_pct") if c in src.columns]
    return dedup_latest(src.select("payer_id", "payer_name", kind, *extra), ["payer_id"], [])


def dim_payer(src: DataFrame) -> DataFrame:
    return full_keys(src, "payer_key", "payer_id").withColumn("is_active", F.lit(1))


def dim_ref(df: DataFrame, bk: str, sk: str) -> DataFrame:
    """Dimension straight from reference data."""
    return full_keys(df.withColumn("is_active", F.lit(1)), sk, bk)


def dim_facility_src(facilities: DataFrame) -> DataFrame:
    names = {"id": "facility_id", "name": "facility_name", "type": "facility_type", "beds": "bed_count"}
    return facilities.withColumnsRenamed(names).select(
        "facility_id", "facility_name", "facility_type", "city", "state", F.col("bed_count").cast("int").alias("bed_count"), "latitude", "longitude")


def dim_medication_src(medications: DataFrame) -> DataFrame:
    return medications.select("rxnorm_code", "medication_name", "generic_name", "drug_class", "therapeutic_area",
                              "route", "form", "strength", F.col("is_chronic").cast("int").alias("is_chronic"))


def dim_diagnosis_src(icd: DataFrame) -> DataFrame:
    return icd.select(F.col("code").alias("icd_code"), F.col("description").alias("icd_description"),
                      F.col("category").alias("icd_category"), F.col("is_chronic").cast("int").alias("is_chronic"))


def dim_location_src(locations: DataFrame) -> DataFrame:
    return locations.select("location_id", "location_name")


def dim_monitor_src(monitors: DataFrame) -> DataFrame:
    """Two layouts: by device with its place, or by monitor without one."""
    if "device_id" in monitors.columns:
        return monitors.select(*[F.col(c).cast("string").alias(c) for c in ("device_id", "device_type", "device_model", "location_id", "unit_name")],
                               F.col("floor_number").try_cast("int").alias("floor_number"), F.col("building").cast("string").alias("building"),
                               F.col("facility_id").cast("string").alias("facility_id"), F.col("is_active").try_cast("int").alias("is_active"))
    blank = {c: F.lit(None).cast("string") for c in ("location_id", "unit_name", "building", "facility_id")}
    return monitors.select(F.col("monitor_id").alias("device_id"), F.col("monitor_type").alias("device_type"), F.col("model").alias("device_model"),
                           blank["location_id"].alias("location_id"), blank["unit_name"].alias("unit_name"), F.lit(None).cast("int").alias("floor_number"),
                           blank["building"].alias("building"), blank["facility_id"].alias("facility_id"), F.lit(1).alias("is_active"))


def dim_monitor(src: DataFrame, facility: DataFrame, location: DataFrame) -> DataFrame:
    """Devices with the keys of their facility and location."""
    keyed = full_keys(src, "monitor_key", "device_id")
    return (keyed.join(facility.select("facility_id", "facility_key"), "facility_id", "left")
            .join(location.select("location_id", "location_key"), "location_id", "left")
            .withColumn("patient_key", F.lit(None).cast("bigint")))


def dim_sdoh_src(sdoh: DataFrame) -> DataFrame:
    """Two layouts: the index as is, or rates from which two columns are derived."""
    null = F.lit(None).cast("double")
    common = [F.col("zip_code").cast("string").alias("zip_code"), F.coalesce(F.col("state").cast("string"), F.lit("MI")).alias("state"),
              F.col("poverty_rate").cast("double").alias("poverty_rate")]
    tail = [F.col("median_household_income").cast("int").alias("median_household_income")]
    if "food_desert_flag" in sdoh.columns:
        return sdoh.select(*common, F.col("food_desert_flag").cast("int").alias("food_desert_flag"), F.col("transportation_score").cast("double").alias("transportation_score"),
                           F.col("housing_instability_rate").cast("double").alias("housing_instability_rate"), F.col("uninsured_rate").cast("double").alias("uninsured_rate"),
                           F.col("broadband_access_pct").cast("double").alias("broadband_access_pct"), *tail, F.col("population").cast("int").alias("population"),
                           F.col("social_vulnerability_index").cast("double").alias("social_vulnerability_index"), F.col("risk_tier").cast("string").alias("risk_tier"))
    return sdoh.select(*common, F.when(F.col("food_insecurity_rate") > 0.15, 1).otherwise(0).alias("food_desert_flag"),
                       (F.lit(1.0) - F.coalesce(F.col("no_vehicle_pct").cast("double"), F.lit(0.0))).alias("transportation_score"),
                       null.alias("housing_instability_rate"), F.col("uninsured_rate").cast("double").alias("uninsured_rate"), null.alias("broadband_access_pct"),
                       *tail, F.lit(None).cast("int").alias("population"),
                       F.col("composite_svi_score").cast("double").alias("social_vulnerability_index"), F.col("risk_tier").cast("string").alias("risk_tier"))


def dim_plan_src(plans: DataFrame | None = None, enrollment: DataFrame | None = None) -> DataFrame:
    """Plan list, or the plans the enrollment names with blank attributes."""
    if plans is None:
        null = F.lit(None)
        plans = enrollment.select("plan_id", "payer_id").distinct().select(
            "plan_id", "payer_id", F.concat(F.lit("Plan "), F.col("plan_id")).alias("plan_name"),
            *[null.cast("string").alias(c) for c in ("line_of_business", "plan_type", "metal_tier", "state", "network_size", "effective_date", "termination_date")],
            F.lit(False).alias("is_capitated"), null.cast("double").alias("avg_pmpm_premium"))
    return dedup_latest(plans, ["plan_id"], [])
