"""Queries for loading, cleaning, keys, dimensions, facts and enrichment."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import clustering, dims, facts, keys, ods, quality, scd, silver
from wardlight.plans.registry import plain, query, tables
from wardlight.plans.warehouse import DIM_LOAD, Warehouse
from wardlight.sources import domain, files, landing
from wardlight.streaming import jobs

FIRST_LOAD, SECOND_LOAD = "1995-01-01", "1995-02-01"


# --- sources and sinks ---------------------------------------------------------------------

def _csv(df: DataFrame, path: str) -> None:
    plain(df).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _drop_folder(w: Warehouse) -> tuple[str, list[str]]:
    """Patient files as they would arrive: a base file and a dated increment."""
    folder = f"{w.folder}/drop-{uuid.uuid4().hex[:8]}"
    raw = w["patients_raw"]
    _csv(raw.filter(F.col(silver.LOAD_TS) == FIRST_LOAD), f"{folder}/base")
    _csv(raw.filter(F.col(silver.LOAD_TS) == SECOND_LOAD), f"{folder}/incremental/{SECOND_LOAD}")
    return folder, plain(raw).columns


@query("a01_load_full")
def _(w):
    folder, columns = _drop_folder(w)
    full = files.load_full(w.spark, f"{folder}/base", [f"{folder}/incremental/*.csv", f"{folder}/incremental/*/*.csv"], files.text_schema(columns))
    return full.select(*columns, F.col("_bronze_source").alias("bronze_source"))


@query("a02_load_incremental")
def _(w):
    folder, columns = _drop_folder(w)
    return plain(files.load_incremental(w.spark, [f"{folder}/incremental/*.csv", f"{folder}/incremental/*/*.csv"], files.text_schema(columns)))


@query("a03_lineage")
def _(w):
    marked = files.with_lineage(domain.source(w.spark, w.sf_dir, "part"), "full", F.lit(FIRST_LOAD))
    return marked.groupBy(F.regexp_extract("_bronze_file", "[^/]+$", 0).alias("file_name"), F.col("_bronze_source").alias("source"),
                          F.col("_bronze_load_timestamp").alias("load_ts")).agg(F.count(F.lit(1)).alias("row_count"))


@query("a04_save_append")
def _(w):
    path = f"{w.folder}/append-{uuid.uuid4().hex[:8]}"
    files.save_table(w["customer"].select("c_custkey", "c_name"), path)
    files.save_table(w["customer"].select("c_custkey", "c_mktsegment"), path, "append")
    return files.read_table(w.spark, path)


def _inputs() -> list[files.SourceFile]:
    return ([files.SourceFile(n.removesuffix("_raw"), n) for n in domain.BATCH if n.endswith("_raw")]
            + [files.SourceFile(n, n, reference=True) for n in domain.BATCH if n.startswith("ref_")])


@query("a05_table_names")
def _(w):
    return quality.table_counts({f.table: w[f.path] for f in _inputs()}).drop("current_count")


@query("a06_missing_sources")
def _(w):
    wanted = [files.SourceFile(n, f"{w.sf_dir}/{n}.parquet") for n in (*domain.SOURCE_TABLES, "payments")]
    return files.missing_sources(w.spark, wanted).drop("path")


@query("a07_consume_once")
def _(w):
    folder, columns = _drop_folder(w)
    paths = {k: f"{folder}/{k}" for k in ("incoming", "out", "checkpoint", "archive")}
    schema = files.text_schema(columns)
    for part in ("base", "incremental"):
        incoming = files.load_incremental(w.spark, [f"{folder}/{part}", f"{folder}/{part}/*/*.csv"], schema)
        incoming.select(*columns).write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(paths["incoming"])
        jobs.finish(jobs.consume_once(w.spark, paths["incoming"], schema, paths["out"], paths["checkpoint"], paths["archive"]))
    return w.spark.read.parquet(paths["out"]).select(*columns)


@query("a08_partitioned_sink")
def _(w):
    path = f"{w.folder}/premium_by_month"
    files.save_table(w["fact_premium"], path, partition_by=["year_month"])
    read = files.read_table(w.spark, path, w["fact_premium"].schema)
    return read.groupBy("year_month").agg(F.count(F.lit(1)).alias("row_count"), s.total("premium_amount").alias("premium"))


@query("a09_clustered_sink")
def _(w):
    path = f"{w.folder}/auth_clustered"
    files.save_clustered(w["fact_authorization"], path, ["payer_key", "decision_date_key"])
    return w.spark.read.parquet(path)


@query("a09_clustered_claims")
def _(w):
    path = f"{w.folder}/claims_clustered"
    claims = w["fact_claim"]
    edges = clustering.edges_of(claims, ["payer_key", "claim_date_key"])
    clustering.save_clustered_by(plain(claims), path, [(F.col(c), e) for c, e in edges.items()])
    return files.read_table(w.spark, path, plain(claims).schema)


@query("a10_load_report")
def _(w):
    return files.load_all(w.spark, {f"{n}_clean": w[f"{n}_clean"] for n in silver.KEYS}, f"{w.folder}/loaded")


@query("a11_parse_events")
def _(w):
    ok = w["landing_parsed"].filter(F.col("_corrupt_record").isNull())
    return ok.select("event_id", "closure_id", F.col("_table").alias("tag"), "event_timestamp", "patient_id", "claim_amount", "days_since_discharge", "is_preventable")


@query("a12_dead_letters")
def _(w):
    dead = landing.split_dead_letter(w["landing_parsed"])[1]
    return dead.select(F.col("_body").alias("body"), F.col("_table").alias("tag"), "reason")


@query("a13_date_spine")
def _(w):
    span = w["orders"].agg(F.min(F.col("o_orderdate").cast("date")).alias("a"), F.max(F.col("o_orderdate").cast("date")).alias("b"))
    days = dims.date_spine(w["orders"], "o_orderdate")
    used = w["orders"].select(F.col("o_orderdate").cast("date").alias("full_date")).groupBy("full_date").agg(F.count(F.lit(1)).alias("order_count"))
    inside = days.filter(F.col("full_date").between(span.select("a").scalar(), span.select("b").scalar()))
    return inside.join(used, "full_date", "left").fillna({"order_count": 0})


@query("a14_score_sink")
def _(w):
    path = f"{w.folder}/scores-{uuid.uuid4().hex[:8]}"
    for run in ("run1", "run2", "run1"):
        files.write_scores(w["fraud_scores"], path, run)
    return w.spark.read.parquet(path).groupBy("scoring_run_id", "risk_tier").agg(F.count(F.lit(1)).alias("score_count"))


# --- cleaning ------------------------------------------------------------------------------

@query("b01_proper_case")
def _(w):
    return w["patients_raw"].select("patient_id", s.proper("first_name").alias("first_name"), s.proper("last_name").alias("last_name"))


@query("b02_gender")
def _(w):
    return w["patients_raw"].groupBy("gender", s.norm_gender("gender").alias("normalised")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b03_codes")
def _(w):
    return w["diagnoses_raw"].groupBy("icd_code", s.code("icd_code").alias("code"), s.code("present_on_admission").alias("poa")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b04_digits")
def _(w):
    return w["patients_raw"].select("patient_id", s.digits("zip_code").alias("zip_code"), s.digits("phone").alias("phone"))


@query("b05_email")
def _(w):
    return w["providers_raw"].select("provider_id", s.email("email").alias("email"))


@query("b06_dates")
def _(w):
    return w["patients_raw"].select("patient_id", F.col("date_of_birth").alias("given"), s.to_d("date_of_birth").alias("date_of_birth"))


@query("b07_casts")
def _(w):
    spec = {"years_experience": "int", "board_certified": "boolean", "patient_satisfaction_score": "double", "hire_date": "date", "status": "int"}
    return s.cast_spec(w["providers_raw"], spec).select("provider_id", *spec)


@query("b08_business_dates")
def _(w):
    return w["claims_clean"].select("claim_id", "submit_date", "claim_date", "process_date", "payment_date")


@query("b09_length_of_stay")
def _(w):
    stay = s.length_of_stay(s.to_d("admit_date"), s.to_d("discharge_date"))
    return w["encounters_raw"].select("encounter_id", stay.alias("length_of_stay"))


@query("b10_is_active")
def _(w):
    return w["providers_raw"].groupBy("status", s.is_active("status").alias("is_active")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b11_flag_default")
def _(w):
    return w["claims_raw"].groupBy("denial_flag", s.flag0("denial_flag").alias("flag")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b12_dedup_latest")
def _(w):
    kept = silver.dedup_latest(w["patients_raw"], ["patient_id"], [silver.LOAD_TS])
    return kept.select("patient_id", "first_name", "city", F.col(silver.LOAD_TS).alias("load_ts"))


tables({f"b13_clean_{t}": f"{t}_clean" for t in ("patients", "providers", "encounters", "claims", "prescriptions", "diagnoses")})
tables({f"b14_clean_{t}": f"{t}_clean" for t in ("member_enrollment", "premiums", "authorizations", "capitation", "provider_contracts",
                                                  "hedis_compliance", "star_ratings", "risk_adjustment", "claim_appeals")})


# --- keys and slowly changing dimensions -------------------------------------------------------

@query("c01_assign_keys")
def _(w):
    patients = w["patients_clean"].select("patient_id", "insurance_type")
    existing = keys.full_keys(patients.filter(F.col("insurance_type") != "BUILDING"), "patient_key", "patient_id").withColumn("is_current", F.lit(1))
    return keys.assign_keys(patients, existing, "patient_key", "patient_id").select("patient_id", "insurance_type", "patient_key")


@query("c02_full_keys")
def _(w):
    return keys.full_keys(w["claims_clean"].select("claim_id"), "claim_key", "claim_id")


def _first_patients(w: Warehouse) -> DataFrame:
    first = w["patients_raw"].filter((F.col(silver.LOAD_TS) == FIRST_LOAD) & (F.col("insurance_type") != "BUILDING"))
    return dims.dim_patient_src(ods.with_age(silver.clean_patients(first), w.as_of), w.as_of)


@query("c03_scd2_merge")
def _(w):
    dim = scd.scd2_init(_first_patients(w), "patient_id", "patient_key", DIM_LOAD)
    now = dims.dim_patient_src(w["patients_enriched"], w.as_of)
    merged = scd.scd2_merge(now, dim, "patient_id", dims.PATIENT_TRACKED, "patient_key", "1995-02-01 00:00:00")
    return merged.select("patient_id", "patient_key", "first_name", "city", "zip_code", "is_current", "effective_start_date", "effective_end_date")


@query("c03_scd2_merge_providers")
def _(w):
    dim = scd.scd2_init(dims.dim_provider_src(w["providers_enriched"]), "provider_id", "provider_key", DIM_LOAD)
    moved = F.when(F.col("specialty") == "Oncology", "Hematology").otherwise(F.col("specialty"))
    now = dims.dim_provider_src(w["providers_enriched"].withColumn("specialty", moved))
    merged = scd.scd2_merge(now, dim, "provider_id", dims.PROVIDER_TRACKED, "provider_key", "1996-01-01 00:00:00")
    return merged.select("provider_id", "provider_key", "specialty", "is_current", "effective_end_date")


tables({"c04_scd2_init": "dim_provider"})


def _upserted(table: str, bk: str, sk: str, date: str, status: str, w: Warehouse) -> DataFrame:
    """Rows before 1999 in the target; rows from 1998 on come again with a new status."""
    rows = w[table].select(bk, sk, date, status)
    target = rows.filter(F.col(date) < 19990101)
    incoming = rows.filter(F.col(date) >= 19980101).withColumns({status: F.lit("Closed"), sk: F.col(sk) + 1000000})
    return scd.upsert(target, incoming, bk, [sk])


@query("c05_upsert_claims")
def _(w):
    return _upserted("fact_claim", "claim_id", "claim_key", "claim_date_key", "claim_status", w)


@query("c05_upsert_encounters")
def _(w):
    return _upserted("fact_encounter", "encounter_id", "encounter_key", "encounter_date_key", "encounter_type", w)


@query("c06_duplicate_keys")
def _(w):
    return scd.dup_keys(w["claims_raw"], ["claim_id"])


@query("c06_rebuild_duplicates")
def _(w):
    target = w["claims_raw"].select("claim_id", F.lit("old").alias("claim_status"))
    return scd.rebuild_if_duplicated(target, w["claims_clean"].select("claim_id", "claim_status"), "claim_id", [])


# --- dimensions -----------------------------------------------------------------------------------

tables({"c07_dim_date": "dim_date", "c11_dim_facility": "dim_facility", "c11_dim_medication": "dim_medication", "c11_dim_diagnosis": "dim_diagnosis",
        "c12_dim_monitor": "dim_monitor", "c13_dim_sdoh": "dim_sdoh", "c14_dim_plan": "dim_plan", "c10_dim_payer": "dim_payer"})


@query("c08_dim_patient")
def _(w):
    return dims.dim_patient_src(w["patients_clean"], w.as_of)


@query("c09_dim_provider")
def _(w):
    return dims.dim_provider_src(w["providers_enriched"])


@query("c10_dim_payer_from_claims")
def _(w):
    return dims.dim_payer_src(claims=w["claims_enriched"])


@query("c12_dim_monitor_plain")
def _(w):
    return dims.dim_monitor_src(w["ref_monitors"])


@query("c13_dim_sdoh_index")
def _(w):
    from wardlight.operators import scores

    return dims.dim_sdoh_src(scores.svi_index(w["sdoh_index_source"]).withColumnRenamed("composite_svi_score", "social_vulnerability_index"))


@query("c14_dim_plan_from_enrollment")
def _(w):
    return dims.dim_plan_src(enrollment=w["member_enrollment_clean"])


@query("c15_lookup")
def _(w):
    df = facts.lookup(w["claims_clean"].select("claim_id", "patient_id", "provider_id", "payer_id"), w["dim_patient"], "patient_id", ["patient_key"])
    df = facts.lookup(df, w["dim_provider"], "provider_id", ["provider_key"])
    return facts.lookup(df, w["dim_payer"], "payer_id", ["payer_key"])


# --- facts --------------------------------------------------------------------------------------------

tables({"c16_fact_encounter": "fact_encounter", "c17_fact_claim": "fact_claim", "c18_fact_prescription": "fact_prescription", "c19_fact_diagnosis": "fact_diagnosis",
        "c20_fact_premium": "fact_premium", "c20_fact_authorization": "fact_authorization", "c20_fact_capitation": "fact_capitation", "c20_fact_appeal": "fact_appeal",
        "c21_bridge_provider_contract": "bridge_provider_contract"})


@query("c17_fact_claim_hashed_denials")
def _(w):
    return facts.fact_claim(w["claims_enriched"], w.dims, w["fact_encounter"], hashed_denials=True)


@query("c17_fact_claim_model_scores")
def _(w):
    model = w["claims_clean"].filter(F.col("claim_type") == "Pharmacy").select(
        "claim_id", "denial_risk_score", F.lit("Model Reason").alias("primary_denial_reason"), F.lit("Model Action").alias("recommended_action"))
    fact = facts.fact_claim(w["claims_enriched"], w.dims, w["fact_encounter"], ml=model)
    return fact.select("claim_id", "denial_risk_score", "denial_risk_category", "primary_denial_reason", "recommended_action")


@query("c22_date_keys")
def _(w):
    return w["premiums_clean"].select("premium_id", s.month_key("year_month").alias("month_key")).join(
        w["member_enrollment_clean"].select(F.regexp_replace("enrollment_id", "ENR", "PRM").alias("premium_id"), s.date_key("coverage_end").alias("end_key")), "premium_id").withColumns(
        {"ym": s.ym_label("end_key"), "end_date": s.date_of_key("end_key")})


# --- enrichment ------------------------------------------------------------------------------------------

@query("d01_age")
def _(w):
    return ods.with_age(w["patients_clean"], w.as_of).select("patient_id", "age", "age_group")


@query("d02_tenure")
def _(w):
    return ods.with_tenure(w["providers_clean"], w.as_of).select("provider_id", "years_of_service")


tables({"d03_providers": "providers_enriched", "d04_encounters": "encounters_enriched", "d05_claims": "claims_enriched",
        "d06_prescriptions": "prescriptions_enriched", "d07_diagnoses": "diagnoses_enriched", "d08_premiums_stamped": "premiums_enriched"})
