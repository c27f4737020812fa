"""Expected SQL for loading, cleaning, keys, dimensions, facts and enrichment."""

from __future__ import annotations

from oracle.base import R, S, initcap, q
from oracle.tables import ACTION_AT, REASON_AT, bucket, claim_fact, d, digits, dkey, num, years
from wardlight.operators.silver import KEYS
from wardlight.sources import domain

PATIENT_COLS = """patient_id, first_name, last_name, date_of_birth, gender, address, city, state, zip_code, phone, email, insurance_type, insurance_provider"""

q("a01_load_full", f"SELECT {PATIENT_COLS}, CASE WHEN _bronze_load_timestamp = '1995-01-01' THEN 'full' ELSE 'incremental' END AS bronze_source FROM patients_raw")
q("a02_load_incremental", f"SELECT {PATIENT_COLS} FROM patients_raw WHERE _bronze_load_timestamp = '1995-02-01'")
q("a03_lineage", "SELECT 'part.parquet' AS file_name, 'full' AS source, '1995-01-01' AS load_ts, COUNT(*) AS row_count FROM part")
q("a04_save_append", "SELECT c_custkey, c_name FROM customer UNION ALL BY NAME SELECT c_custkey, c_mktsegment FROM customer")
q("a05_table_names", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in domain.BATCH if n.endswith("_raw") or n.startswith("ref_")))
q("a06_missing_sources", "SELECT 'payments' AS name, true AS required")
q("a07_consume_once", f"SELECT {PATIENT_COLS} FROM patients_raw")
q("a08_partitioned_sink", f"SELECT year_month, COUNT(*) AS row_count, {S('premium_amount')} AS premium FROM fact_premium GROUP BY 1")
q("a09_clustered_sink", "SELECT * FROM fact_authorization")
q("a09_clustered_claims", "SELECT * FROM fact_claim")
q("a10_load_report", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS records, 'ok' AS status, CAST(NULL AS VARCHAR) AS error FROM {n}" for n in (f"{k}_clean" for k in KEYS)))


def js(name: str, kind: str) -> str:
    return f"CAST(json_extract_string(body, '$.{name}') AS {kind}) AS {name}"


q("a11_parse_events", f"""SELECT {js('event_id', 'VARCHAR')}, {js('closure_id', 'VARCHAR')}, tag, {js('event_timestamp', 'VARCHAR')}, {js('patient_id', 'VARCHAR')}, {js('claim_amount', 'DOUBLE')},
    {js('days_since_discharge', 'BIGINT')}, {js('is_preventable', 'BOOLEAN')} FROM landing WHERE ok""")
q("a12_dead_letters", "SELECT body, CASE WHEN ok THEN tag END AS tag, CASE WHEN ok THEN 'unrouted' ELSE 'unparsable' END AS reason FROM landing WHERE NOT ok OR tag = 'unknown_events'")
q("a13_date_spine", """SELECT full_date, COALESCE(n, 0) AS order_count FROM dim_date LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_date, COUNT(*) AS n FROM orders GROUP BY 1) o USING (full_date)
    WHERE full_date BETWEEN (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)""")
q("a14_score_sink", "SELECT run AS scoring_run_id, risk_tier, COUNT(*) AS score_count FROM fraud_scores, (VALUES ('run1'), ('run2')) r(run) GROUP BY 1, 2")

q("b01_proper_case", f"SELECT patient_id, {initcap('first_name')} AS first_name, {initcap('last_name')} AS last_name FROM patients_raw")
q("b02_gender", """SELECT gender, CASE upper(gender) WHEN 'M' THEN 'Male' WHEN 'MALE' THEN 'Male' WHEN 'F' THEN 'Female' WHEN 'FEMALE' THEN 'Female' ELSE 'Unknown' END AS normalised, COUNT(*) AS row_count FROM patients_raw GROUP BY 1, 2""")
q("b03_codes", "SELECT icd_code, upper(trim(icd_code)) AS code, upper(trim(present_on_admission)) AS poa, COUNT(*) AS row_count FROM diagnoses_raw GROUP BY 1, 2, 3")
q("b04_digits", f"SELECT patient_id, {digits('zip_code')} AS zip_code, {digits('phone')} AS phone FROM patients_raw")
q("b05_email", "SELECT provider_id, lower(trim(email)) AS email FROM providers_raw")
q("b06_dates", f"SELECT patient_id, date_of_birth AS given, {d('date_of_birth')} AS date_of_birth FROM patients_raw")
q("b07_casts", f"""SELECT provider_id, {num('years_experience', 'INTEGER')} AS years_experience, {num('board_certified', 'BOOLEAN')} AS board_certified,
    {num('patient_satisfaction_score', 'DOUBLE')} AS patient_satisfaction_score, {num('hire_date', 'DATE')} AS hire_date, {num('status', 'INTEGER')} AS status FROM providers_raw""")
q("b08_business_dates", f"SELECT claim_id, submit_date, {d('submit_date')} AS claim_date, process_date, {d('process_date')} AS payment_date FROM claims_clean")
q("b09_length_of_stay", "SELECT encounter_id, COALESCE(CAST(discharge_date AS DATE) - CAST(admit_date AS DATE), CAST(length_of_stay AS INTEGER)) AS length_of_stay FROM encounters_raw")
q("b10_is_active", "SELECT status, status = 'Active' AS is_active, COUNT(*) AS row_count FROM providers_raw GROUP BY 1, 2")
q("b11_flag_default", "SELECT denial_flag, COALESCE(CAST(denial_flag AS INTEGER), 0) AS flag, COUNT(*) AS row_count FROM claims_raw GROUP BY 1, 2")
q("b12_dedup_latest", """SELECT patient_id, arg_max(first_name, _bronze_load_timestamp) AS first_name, arg_max(city, _bronze_load_timestamp) AS city, MAX(_bronze_load_timestamp) AS load_ts FROM patients_raw GROUP BY 1""")
for _t in ("patients", "providers", "encounters", "claims", "prescriptions", "diagnoses"):
    q(f"b13_clean_{_t}", f"SELECT * EXCLUDE (_bronze_load_timestamp) FROM {_t}_clean")
for _t in ("member_enrollment", "premiums", "authorizations", "capitation", "provider_contracts", "hedis_compliance", "star_ratings", "risk_adjustment", "claim_appeals"):
    q(f"b14_clean_{_t}", f"SELECT * EXCLUDE (_bronze_load_timestamp) FROM {_t}_clean")

q("c01_assign_keys", """SELECT patient_id, insurance_type, CASE WHEN insurance_type <> 'BUILDING' THEN 0 ELSE (SELECT COUNT(*) FROM patients_clean WHERE insurance_type <> 'BUILDING') END
    + ROW_NUMBER() OVER (PARTITION BY insurance_type = 'BUILDING' ORDER BY patient_id) AS patient_key FROM patients_clean""")
q("c02_full_keys", "SELECT claim_id, ROW_NUMBER() OVER (ORDER BY claim_id) AS claim_key FROM (SELECT DISTINCT claim_id FROM claims_raw) t")
_first = f"""SELECT patient_id, {initcap('first_name')} AS first_name, city, {digits('zip_code')} AS zip_code, ROW_NUMBER() OVER (ORDER BY patient_id) AS patient_key
    FROM patients_raw WHERE _bronze_load_timestamp = '1995-01-01' AND insurance_type <> 'BUILDING'"""
q("c03_scd2_merge", f"""SELECT patient_id, patient_key, first_name, city, zip_code, CASE WHEN gone THEN 0 ELSE 1 END AS is_current, TIMESTAMP '1995-01-01' AS effective_start_date,
    CASE WHEN gone THEN TIMESTAMP '1995-02-01' END AS effective_end_date FROM (SELECT f.*, f.city <> p.city AS gone FROM ({_first}) f JOIN patients_clean p USING (patient_id)) t
    UNION ALL SELECT patient_id, (SELECT COUNT(*) FROM ({_first}) x) + ROW_NUMBER() OVER (ORDER BY patient_id), first_name, city, zip_code, 1, TIMESTAMP '1995-02-01', NULL
    FROM (SELECT p.* FROM patients_clean p LEFT JOIN ({_first}) f USING (patient_id) WHERE f.patient_id IS NULL OR f.city <> p.city) n""")
q("c03_scd2_merge_providers", """SELECT provider_id, provider_key, specialty, CASE WHEN specialty = 'Oncology' THEN 0 ELSE 1 END AS is_current, CASE WHEN specialty = 'Oncology' THEN TIMESTAMP '1996-01-01' END AS effective_end_date
    FROM dim_provider UNION ALL SELECT provider_id, (SELECT COUNT(*) FROM dim_provider) + ROW_NUMBER() OVER (ORDER BY provider_id), 'Hematology', 1, NULL FROM dim_provider WHERE specialty = 'Oncology'""")
q("c04_scd2_init", "SELECT * FROM dim_provider")
for _n, _t, _bk, _sk, _date, _st in (("c05_upsert_claims", "fact_claim", "claim_id", "claim_key", "claim_date_key", "claim_status"),
                                     ("c05_upsert_encounters", "fact_encounter", "encounter_id", "encounter_key", "encounter_date_key", "encounter_type")):
    q(_n, f"""SELECT {_bk}, CASE WHEN {_date} >= 19990101 THEN {_sk} + 1000000 ELSE {_sk} END AS {_sk}, {_date}, CASE WHEN {_date} >= 19980101 THEN 'Closed' ELSE {_st} END AS {_st} FROM {_t}""")
q("c06_duplicate_keys", "SELECT claim_id, COUNT(*) AS row_count FROM claims_raw GROUP BY 1 HAVING COUNT(*) > 1")
q("c06_rebuild_duplicates", "SELECT claim_id, claim_status FROM claims_clean")

for _n, _t in {"c07_dim_date": "dim_date", "c11_dim_facility": "dim_facility", "c11_dim_medication": "dim_medication", "c11_dim_diagnosis": "dim_diagnosis", "c12_dim_monitor": "dim_monitor",
               "c13_dim_sdoh": "dim_sdoh", "c14_dim_plan": "dim_plan", "c10_dim_payer": "dim_payer", "c16_fact_encounter": "fact_encounter", "c17_fact_claim": "fact_claim",
               "c18_fact_prescription": "fact_prescription", "c19_fact_diagnosis": "fact_diagnosis", "c20_fact_premium": "fact_premium", "c20_fact_authorization": "fact_authorization",
               "c20_fact_capitation": "fact_capitation", "c20_fact_appeal": "fact_appeal", "c21_bridge_provider_contract": "bridge_provider_contract"}.items():
    q(_n, f"SELECT * FROM {_t}")
_age = years("DATE '2002-01-01'", "date_of_birth")
q("c08_dim_patient", f"""SELECT patient_id, first_name, last_name, date_of_birth, gender, address, city, state, zip_code, phone, email, insurance_type, insurance_provider, CAST(NULL AS VARCHAR) AS insurance_policy_number,
    {_age} AS age, CASE WHEN {_age} < 18 THEN 'Pediatric' WHEN {_age} < 65 THEN 'Adult' ELSE 'Senior' END AS age_group FROM patients_clean""")
q("c09_dim_provider", "SELECT * EXCLUDE (provider_key, is_current, effective_start_date, effective_end_date) FROM dim_provider")
q("c10_dim_payer_from_claims", "SELECT payer_id, MAX(payer_name) AS payer_name, MAX(payer_type) AS payer_type FROM (SELECT payer_id, payer_name, " + """CASE WHEN lower(payer_name) LIKE '%medicare%' THEN 'Medicare'
    WHEN lower(payer_name) LIKE '%medicaid%' THEN 'Medicaid' WHEN lower(payer_name) LIKE '%self%' OR lower(payer_name) LIKE '%cash%' THEN 'Self-Pay' ELSE 'Commercial' END AS payer_type
    FROM (SELECT DISTINCT payer_id, payer_name FROM claims_enriched) c) t GROUP BY 1""")
q("c12_dim_monitor_plain", """SELECT monitor_id AS device_id, monitor_type AS device_type, model AS device_model, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS unit_name,
    CAST(NULL AS INTEGER) AS floor_number, CAST(NULL AS VARCHAR) AS building, CAST(NULL AS VARCHAR) AS facility_id, 1 AS is_active FROM ref_monitors""")
q("c13_dim_sdoh_index", f"""SELECT *, CASE WHEN social_vulnerability_index >= 0.30 THEN 'High' WHEN social_vulnerability_index >= 0.15 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM (
    SELECT zip_code, state, poverty_rate, CAST(food_desert_flag AS INTEGER) AS food_desert_flag, transportation_score, housing_instability_rate, uninsured_rate, broadband_access_pct, CAST(median_household_income AS INTEGER) AS median_household_income, population,
    {R('poverty_rate * 0.25 + CAST(food_desert_flag AS INTEGER) * 0.15 + housing_instability_rate * 0.15 + uninsured_rate * 0.15 + (1 - transportation_score) * 0.20 + (1 - broadband_access_pct) * 0.10', 4)} AS social_vulnerability_index FROM sdoh_index_source) t""")
q("c14_dim_plan_from_enrollment", """SELECT plan_id, MAX(payer_id) AS payer_id, 'Plan ' || plan_id AS plan_name, CAST(NULL AS VARCHAR) AS line_of_business, CAST(NULL AS VARCHAR) AS plan_type, CAST(NULL AS VARCHAR) AS metal_tier, CAST(NULL AS VARCHAR) AS state,
    CAST(NULL AS VARCHAR) AS network_size, CAST(NULL AS VARCHAR) AS effective_date, CAST(NULL AS VARCHAR) AS termination_date, false AS is_capitated, CAST(NULL AS DOUBLE) AS avg_pmpm_premium FROM member_enrollment_clean GROUP BY plan_id""")
q("c15_lookup", """SELECT claim_id, c.patient_id, c.provider_id, c.payer_id, patient_key, provider_key, payer_key FROM claims_clean c LEFT JOIN dim_patient p ON c.patient_id = p.patient_id
    LEFT JOIN dim_provider v ON c.provider_id = v.provider_id LEFT JOIN dim_payer y ON c.payer_id = y.payer_id""")
_hashed = f"claim_status = 'Denied' OR billed_amount > 50000 AND {bucket('claim_id', 100)} < 18 OR billed_amount > 20000 AND {bucket('claim_id', 100)} < 12 OR {bucket('claim_id', 100)} < 5"
q("c17_fact_claim_hashed_denials", f"SELECT * EXCLUDE (claim_key) FROM ({claim_fact(_hashed)}) f")
q("c17_fact_claim_model_scores", f"""SELECT claim_id, score AS denial_risk_score, CASE WHEN score >= 0.6 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS denial_risk_category,
    CASE WHEN claim_status = 'Denied' THEN COALESCE(denial_reason, CASE WHEN claim_type = 'Pharmacy' THEN 'Model Reason' END, {REASON_AT}) END AS primary_denial_reason,
    CASE WHEN claim_status = 'Denied' THEN CASE WHEN claim_type = 'Pharmacy' AND {bucket('claim_id', 7)} = 6 THEN 'Model Action' ELSE {ACTION_AT} END END AS recommended_action
    FROM (SELECT *, CASE WHEN claim_type = 'Pharmacy' THEN denial_risk_score ELSE CASE WHEN claim_status = 'Denied' THEN 0.75 WHEN billed_amount > 50000 THEN 0.55 WHEN billed_amount > 20000 THEN 0.40
    WHEN billed_amount > 10000 THEN 0.30 ELSE 0.15 END::DOUBLE END AS score FROM claims_clean) t""")
q("c22_date_keys", f"""SELECT premium_id, CAST(replace(p.year_month, '-', '') AS INTEGER) * 100 + 1 AS month_key, {dkey('coverage_end')} AS end_key, strftime(coverage_end, '%Y-%m') AS ym, coverage_end AS end_date
    FROM premiums_clean p JOIN member_enrollment_clean e ON p.premium_id = replace(e.enrollment_id, 'ENR', 'PRM')""")

q("d01_age", "SELECT patient_id, age, age_group FROM patients_enriched")
q("d02_tenure", "SELECT provider_id, years_of_service FROM providers_enriched")
for _n in ("providers", "encounters", "claims", "prescriptions", "diagnoses"):
    q(f"d0{3 + ('providers', 'encounters', 'claims', 'prescriptions', 'diagnoses').index(_n)}_{_n}", f"SELECT * EXCLUDE (_bronze_load_timestamp) FROM {_n}_enriched")
q("d08_premiums_stamped", "SELECT * EXCLUDE (_bronze_load_timestamp) FROM premiums_clean")
