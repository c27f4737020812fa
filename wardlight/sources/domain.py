"""Healthcare tables derived from the order tables (the data this repository is tested on).

Each entry is one SELECT in SQL that Spark and other engines read alike. ``{name}``
stands for an input: an order table or an earlier entry. The result plays the part of
the raw files of a health system: every column is text, names are unclean, rows repeat,
dates may be wrong. Nothing here is a rule of the library; cleaning, keys, facts and
scores are computed from these tables by the operators.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from wardlight import reference_data as ref

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels")

# Business day on which the batch tables are evaluated, and moment of the event tables.
AS_OF = "2002-01-01"
EVENT_AS_OF = "2024-01-30 14:00:00"


def _pick(values: list[str], index: str) -> str:
    """CASE expression choosing values[index]."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({index} AS INT) {whens} END"


def _id(prefix: str, number: str, width: int = 12) -> str:
    return f"'{prefix}' || LPAD(CAST({number} AS STRING), {width}, '0')"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def _date(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS STRING)"


def _day_plus(expr: str, days: str) -> str:
    return f"CAST(CAST({expr} AS DATE) + CAST({days} AS INT) AS STRING)"


def _number(expr: str) -> str:
    return f"CAST(REGEXP_EXTRACT({expr}, '[0-9]+', 0) AS INT)"


ICD = [row[0] for row in ref.ICD_CODES]
CPT = ["99213", "99214", "99215", "99283", "99284", "99285", "99221", "71046", "27447", "80053"]
SPECIALTIES = ["cardiology", "internal medicine", "emergency medicine", "orthopedics", "pediatrics", "oncology"]
DISPOSITIONS = ["Home", "SNF", "Rehab", "Home Health", "Expired", "AMA", "Transfer"]
RAW_REASONS = ["Prior Auth Required", "Not Medically Necessary", "Duplicate Claim", "Invalid Code",
               "Coverage Expired", "Out of Network", "Missing Documentation"]


def payer_of(key: str) -> str:
    return _id("PAY", f"{key} % 20 + 1", 3)


PAYER_TYPES = ["Commercial", "Government", "Medicaid Managed Care", "Commercial", "Self-Pay"]


def payer_name(p: str) -> str:
    """Name of payer number p, told by kind and number."""
    return f"{_pick(['Commercial Health', 'Medicare Region', 'Medicaid Plan', 'Employer Mutual', 'Self-Pay Group'], f'{p} % 5')} || ' ' || CAST({p} + 1 AS STRING)"


BILLED = "CAST(l_extendedprice AS DECIMAL(18,2))"
ALLOWED = f"CAST({BILLED} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))"
PAID = f"CAST({ALLOWED} * (1 - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2))"
STATUS = """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN ' DENIED'
    WHEN l_returnflag = 'R' THEN 'approved' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ' appealed '
    WHEN l_returnflag = 'A' THEN 'pending' ELSE 'paid' END"""

BATCH: dict[str, str] = {
    # Lines with their orders: the source of claims, fills, diagnoses, gaps, stars and appeals.
    "order_lines": "SELECT * FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    # ---- reference inputs -------------------------------------------------------
    # The codes that occur in the given lines, with their fixed attributes.
    "ref_icd_codes": f"""SELECT code, description, category, is_chronic FROM (VALUES {ref.sql_values(ref.ICD_CODES)}) AS t(code, description, category, is_chronic)
        WHERE code IN (SELECT {_pick(ICD, 'l_partkey % 20')} FROM {{lineitem}})""",
    "ref_payers": f"""SELECT {payer_of('p')} AS payer_id, {payer_name('p')} AS payer_name, {_pick(PAYER_TYPES, 'p % 5')} AS payer_type,
        {_pick(['PPO', 'HMO', 'FFS', 'EPO'], 'p % 4')} AS plan_type, {_pick(['MI', 'NY', 'Federal'], 'p % 3')} AS state, {_pick(['Large', 'Medium', 'Small'], 'p % 3')} AS network_size,
        CAST(45 + p * 2 AS DOUBLE) / 100 AS avg_reimbursement_pct FROM (SELECT c_custkey % 20 AS p FROM {{customer}} GROUP BY c_custkey % 20) t""",
    "ref_drg_codes": f"""SELECT drg, description, CAST(weight AS DOUBLE) AS weight, CAST(base_rate AS DOUBLE) AS base_rate, icd_match
        FROM (VALUES {ref.sql_values(ref.DRG_CODES)}) AS t(drg, description, weight, base_rate, icd_match)""",
    "ref_hcc_codes": f"""SELECT hcc_code, hcc_description, CAST(raf_weight AS DOUBLE) AS raf_weight, icd_match
        FROM (VALUES {ref.sql_values(ref.HCC_CODES)}) AS t(hcc_code, hcc_description, raf_weight, icd_match)""",
    "hedis_measures": f"""SELECT measure_id, measure_name, measure_name AS description, target_icd, frequency_months, age_min, age_max
        FROM (VALUES {ref.sql_values(ref.HEDIS_MEASURES)}) AS t(measure_id, measure_name, target_icd, frequency_months, age_min, age_max)""",
    "ref_star_measures": f"SELECT star_measure_id, star_measure_name, domain, weight FROM (VALUES {ref.sql_values(ref.STAR_MEASURES)}) AS t(star_measure_id, star_measure_name, domain, weight)",
    "dashboard_thresholds": f"""SELECT threshold_key, alert_type, persona, CAST(warn_value AS DOUBLE) AS warn_value,
        CAST(critical_value AS DOUBLE) AS critical_value, unit, direction, true AS active
        FROM (VALUES {ref.sql_values(ref.THRESHOLDS)}) AS t(threshold_key, alert_type, persona, warn_value, critical_value, unit, direction)""",
    "hrrp_expected": f"""SELECT hrrp_condition, icd_code, CAST(expected_rate AS DOUBLE) AS expected_rate
        FROM (VALUES {ref.sql_values(ref.HRRP_EXPECTED)}) AS t(hrrp_condition, icd_code, expected_rate)""",
    "ref_facilities": f"""SELECT {_id('FAC', 'n_nationkey + 1', 3)} AS id, REPLACE(n_name, '_', ' ') || ' Hospital' AS name,
        {_pick(['General Hospital', 'Specialty Center', 'Urgent Care', 'Primary Care', 'Community Clinic'], 'n_regionkey')} AS type,
        'City ' || CAST(n_nationkey AS STRING) AS city, 'S' || CAST(n_regionkey AS STRING) AS state, 50 + n_nationkey * 10 AS beds,
        CAST(25.0 + n_nationkey * 0.75 AS DOUBLE) AS latitude, CAST(-120.0 + n_nationkey * 1.5 AS DOUBLE) AS longitude
        FROM {{nation}}""",
    "ref_medications": f"""SELECT p_brand AS rxnorm_code, 'Med ' || p_brand || ' 10 MG' AS medication_name, MIN(p_name) AS generic_name,
        'Class ' || CAST({_number('p_brand')} % 6 AS STRING) AS drug_class,
        'Area ' || CAST({_number('p_brand')} % 4 AS STRING) AS therapeutic_area,
        'Oral' AS route, 'Tablet' AS form, '10 MG' AS strength, {_number('p_brand')} % 2 AS is_chronic
        FROM {{part}} GROUP BY p_brand""",
    "ref_plans": f"""SELECT {_id('PLN', 'p', 4)} AS plan_id, {payer_of('p')} AS payer_id, 'Plan ' || CAST(p AS STRING) AS plan_name,
        {_pick(['Commercial', 'Medicare', 'Medicaid'], 'p % 3')} AS line_of_business, {_pick(['HMO', 'PPO', 'EPO'], 'p % 3')} AS plan_type,
        {_pick(['Bronze', 'Silver', 'Gold'], 'p % 3')} AS metal_tier, 'MI' AS state, 'Large' AS network_size,
        '1995-01-01' AS effective_date, '2005-12-31' AS termination_date, p % 4 = 0 AS is_capitated, CAST(300 + p AS DOUBLE) AS avg_pmpm_premium
        FROM (SELECT c_custkey % 40 AS p FROM {{customer}} GROUP BY c_custkey % 40) t""",
    "ref_sdoh_zipcode": f"""SELECT LPAD(CAST(500 + z AS STRING), 5, '0') AS zip_code, 'S' || CAST(z % 5 AS STRING) AS state,
        {_pick(['Urban', 'Suburban', 'Rural'], 'z % 3')} AS locale_type, 28000 + (z * 613) % 92000 AS median_household_income,
        CAST(5 + (z * 7) % 31 AS DOUBLE) / 100 AS poverty_rate, CAST(3 + (z * 5) % 10 AS DOUBLE) / 100 AS unemployment_rate,
        CAST(4 + (z * 11) % 27 AS DOUBLE) / 100 AS uninsured_rate, CAST(5 + (z * 13) % 31 AS DOUBLE) / 100 AS food_insecurity_rate,
        CAST(2 + (z * 3) % 24 AS DOUBLE) / 100 AS no_vehicle_pct, CAST(40.0 + z * 0.01 AS DOUBLE) AS latitude, CAST(-85.0 + z * 0.01 AS DOUBLE) AS longitude, n AS members
        FROM (SELECT c_custkey % 200 AS z, COUNT(*) AS n FROM {{customer}} GROUP BY c_custkey % 200) t""",
    "ref_monitors": f"""SELECT {_id('MON', 's_suppkey')} AS monitor_id, {_pick(['Bedside', 'Telemetry', 'Wearable'], 's_suppkey % 3')} AS monitor_type,
        'Maker ' || CAST(s_nationkey AS STRING) AS manufacturer, 'M' || CAST(s_suppkey % 9 AS STRING) AS model, 'WiFi' AS connectivity,
        s_suppkey % 30 AS battery_life_days, true AS fda_cleared, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS unit_cost FROM {{supplier}}""",
    "ref_devices": f"""SELECT {_id('DEV', 's_suppkey')} AS device_id, 'Monitor' AS device_type, 'D' || CAST(s_suppkey % 9 AS STRING) AS device_model,
        {_id('LOC', 's_nationkey % 24', 3)} AS location_id, {_pick(['ICU', 'ED', 'Medical', 'Surgical'], 's_suppkey % 4')} AS unit_name,
        CAST(s_suppkey % 5 AS STRING) AS floor_number, 'Main' AS building, {_id('FAC', 's_nationkey + 1', 3)} AS facility_id,
        CAST(s_suppkey % 2 AS STRING) AS is_active FROM {{supplier}}""",
    "ref_locations": f"""SELECT {_id('LOC', 'n_nationkey', 3)} AS location_id, 'Unit ' || CAST(n_nationkey AS STRING) AS location_name FROM {{nation}}""",
    "sdoh_index_source": f"""SELECT LPAD(CAST(500 + z AS STRING), 5, '0') AS zip_code, 'S' || CAST(z % 5 AS STRING) AS state,
        CAST(5 + (z * 7) % 31 AS DOUBLE) / 100 AS poverty_rate, z % 4 = 0 AS food_desert_flag, CAST(30 + z % 61 AS DOUBLE) / 100 AS transportation_score,
        CAST(3 + z % 23 AS DOUBLE) / 100 AS housing_instability_rate, CAST(4 + z % 17 AS DOUBLE) / 100 AS uninsured_rate,
        CAST(50 + z % 49 AS DOUBLE) / 100 AS broadband_access_pct, 28000 + (z * 613) % 67000 AS median_household_income, CAST(n AS INT) AS population
        FROM (SELECT c_custkey % 200 AS z, COUNT(*) AS n FROM {{customer}} GROUP BY c_custkey % 200) t""",
    # ---- members and clinicians -------------------------------------------------
    "patients_raw": f"""SELECT {_id('PAT', 'c_custkey')} AS patient_id,
        CASE WHEN load = 1 THEN '  first' ELSE ' FIRST' END || CAST(c_custkey % 50 AS STRING) || ' ' AS first_name,
        'LAST' || CAST(c_custkey AS STRING) AS last_name,
        CASE WHEN c_custkey % 211 = 5 THEN 'not-a-date' ELSE {_day_plus("DATE '1915-01-01'", '(c_custkey * 97) % 31000')} END AS date_of_birth,
        {_pick(['M', 'f', 'male', 'FEMALE', 'x'], 'c_custkey % 5')} AS gender, CAST(c_custkey AS STRING) || ' Main St' AS address,
        CASE WHEN load = 2 AND c_custkey % 20 = 0 THEN 'Newtown' ELSE 'City ' || CAST(c_nationkey AS STRING) END AS city,
        ' s' || CAST(c_nationkey % 5 AS STRING) || ' ' AS state, LPAD(CAST(500 + c_custkey % 203 AS STRING), 5, '0') || '-' AS zip_code,
        '(555) ' || LPAD(CAST(c_custkey % 1000 AS STRING), 3, '0') || '-' || LPAD(CAST(c_custkey % 10000 AS STRING), 4, '0') AS phone,
        ' User' || CAST(c_custkey AS STRING) || '@Mail.ORG ' AS email, c_mktsegment AS insurance_type,
        'Provider of ' || c_mktsegment AS insurance_provider, CASE WHEN load = 1 THEN '1995-01-01' ELSE '1995-02-01' END AS _bronze_load_timestamp
        FROM (SELECT c.*, 1 AS load FROM {{customer}} c UNION ALL SELECT c.*, 2 AS load FROM {{customer}} c WHERE c_custkey % 10 = 0) t""",
    "providers_raw": f"""SELECT {_id('PRV', 's_suppkey')} AS provider_id, ' ann' || CAST(s_suppkey % 30 AS STRING) AS first_name,
        'SMITH' || CAST(s_suppkey AS STRING) || ' ' AS last_name, 'NPI-' || LPAD(CAST(s_suppkey AS STRING), 10, '1') AS npi,
        {_pick(SPECIALTIES, 's_suppkey % 6')} AS specialty, CASE WHEN s_suppkey % 9 <> 0 THEN ' dept ' || CAST(s_suppkey % 7 AS STRING) END AS department,
        {_id('FAC', 's_nationkey + 1', 3)} AS facility_id, 'Old name' AS facility_name, ' Doc' || CAST(s_suppkey AS STRING) || '@Clinic.ORG' AS email,
        CASE WHEN s_suppkey % 8 = 0 THEN 'Inactive' ELSE 'Active' END AS status, {_day_plus("DATE '1970-01-01'", '(s_suppkey * 61) % 10000')} AS hire_date,
        {_pick(['FFS', 'Value-Based', 'Capitation'], 's_suppkey % 3')} AS contract_type,
        CASE WHEN s_suppkey % 10 <> 0 THEN {_pick(['Full-time', 'Part-time'], 's_suppkey % 2')} END AS fte_status,
        CAST(s_suppkey % 40 AS STRING) AS years_experience, {_pick(['true', 'false', 'maybe'], 's_suppkey % 3')} AS board_certified,
        CAST(100 + s_suppkey % 400 AS STRING) AS patient_panel_size, CAST(4000 + (s_suppkey * 17) % 3000 AS STRING) AS annual_rvu_target,
        CAST(3500 + (s_suppkey * 29) % 4000 AS STRING) AS actual_rvu, '4.' || CAST(s_suppkey % 10 AS STRING) AS patient_satisfaction_score,
        {_pick(['true', 'false'], 's_suppkey % 2')} AS telehealth_enabled, CAST(60 + s_suppkey % 41 AS STRING) AS documentation_score,
        CAST(50 + s_suppkey % 51 AS STRING) AS ehr_adoption_score, '1995-01-01' AS _bronze_load_timestamp FROM {{supplier}}""",
    # ---- encounters and what hangs on them --------------------------------------
    "encounters_raw": f"""SELECT {_id('ENC', 'o_orderkey')} AS encounter_id, {_id('PAT', 'o_custkey')} AS patient_id,
        {_id('PRV', 'o_orderkey % (SELECT COUNT(*) FROM {supplier})')} AS provider_id,
        CASE o_orderstatus WHEN 'F' THEN 'inpatient' WHEN 'O' THEN ' OUTPATIENT' ELSE {_pick([' emergency ', 'observation', 'telehealth'], 'o_orderkey % 3')} END AS encounter_type,
        {_date('o_orderdate')} AS admit_date,
        CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE {_day_plus('o_orderdate', 'o_orderkey % 13')} END AS discharge_date,
        CAST(o_orderkey % 7 AS STRING) AS length_of_stay, {_pick(ICD, 'o_orderkey % 20')} AS primary_diagnosis_code,
        {_id('FAC', 'o_custkey % 27 + 1', 3)} AS facility_id,
        CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'EMERGENCY' ELSE 'elective' END AS admission_type,
        {_pick(DISPOSITIONS, 'o_custkey % 7')} AS discharge_disposition, {_money('o_totalprice')} AS total_charges,
        drg AS drg_code, d.description AS drg_description, CAST(CAST(weight AS DECIMAL(8,4)) AS STRING) AS drg_weight,
        CAST(CAST(CAST(weight AS DECIMAL(8,4)) * CAST(base_rate AS DECIMAL(8,0)) AS DECIMAL(18,2)) AS STRING) AS expected_reimbursement,
        CASE WHEN drg IS NOT NULL THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.75 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) END AS cost_to_deliver,
        CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '0.' || LPAD(CAST(o_orderkey % 97 AS STRING), 2, '0') END AS readmission_risk,
        '1995-01-01' AS _bronze_load_timestamp
        FROM {{orders}} LEFT JOIN {{ref_drg_codes}} d ON o_orderstatus = 'F' AND d.icd_match = {_pick(ICD, 'o_orderkey % 20')} AND d.drg NOT IN ('292', '195', '638')""",
    "claims_raw": f"""SELECT {_id('CLM', 'l_orderkey')} || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS claim_id, {_id('ENC', 'l_orderkey')} AS encounter_id,
        {_id('PAT', 'o_custkey')} AS patient_id, {_id('PRV', 'l_suppkey')} AS provider_id,
        CASE WHEN l_orderkey % 50 = 0 THEN 'PAY999' ELSE {payer_of('o_custkey')} END AS payer_id,
        {_pick(['professional', ' INSTITUTIONAL', 'pharmacy'], 'l_linenumber % 3')} AS claim_type, {_pick(CPT, 'l_partkey % 10')} AS cpt_code,
        {_pick(ICD, 'l_partkey % 20')} AS primary_diagnosis_code, {_date('o_orderdate')} AS service_date, {_day_plus('o_orderdate', 'l_linenumber')} AS submit_date,
        CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 4 = 0 THEN {_date('l_shipdate')} ELSE {_day_plus('o_orderdate', 'l_linenumber + l_partkey % 120')} END AS process_date,
        CAST({BILLED} AS STRING) AS billed_amount, CASE WHEN l_partkey % 23 <> 0 THEN CAST({ALLOWED} AS STRING) END AS allowed_amount,
        CASE WHEN l_partkey % 29 <> 0 THEN CAST({PAID} AS STRING) END AS paid_amount, CAST(CAST({ALLOWED} - {PAID} AS DECIMAL(18,2)) AS STRING) AS patient_responsibility,
        {STATUS} AS claim_status, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1' WHEN l_returnflag = 'N' THEN '0' END AS denial_flag,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_partkey % 11 <> 0 THEN {_pick(RAW_REASONS, 'l_partkey % 7')} END AS denial_reason,
        '0.' || LPAD(CAST(l_partkey % 100 AS STRING), 2, '0') AS denial_risk_score, {_pick(['low', 'MEDIUM', ' high'], 'l_partkey % 3')} AS denial_risk_category,
        CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_orderkey % 75 AS STRING) END AS days_to_payment,
        CASE WHEN l_partkey % 3 = 0 THEN '0.95' END AS net_collection_rate,
        CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' OR l_returnflag = 'R' AND l_linestatus = 'F' AND l_partkey % 2 = 0 THEN {_day_plus('l_shipdate', '10')} END AS appeal_date,
        CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' OR l_returnflag = 'R' AND l_linestatus = 'F' AND l_partkey % 2 = 0 THEN {_pick(['overturned', 'Upheld', 'PARTIAL'], 'l_partkey % 3')} END AS appeal_outcome,
        CASE WHEN l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_partkey % 3 = 0 THEN CAST({ALLOWED} AS STRING)
             WHEN l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_partkey % 3 = 2 THEN CAST(CAST({ALLOWED} * CAST(0.5 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) END AS appeal_amount_recovered,
        '1995-01-01' AS _bronze_load_timestamp FROM {{order_lines}}""",
    "prescriptions_raw": f"""SELECT {_id('RX', 'l_orderkey')} || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS prescription_id, {_id('ENC', 'l_orderkey')} AS encounter_id,
        {_id('PAT', 'o_custkey')} AS patient_id, CASE WHEN l_partkey % 37 = 0 THEN 'PRVNONE' ELSE {_id('PRV', 'l_suppkey')} END AS provider_id, p_brand AS rxnorm_code,
        ' med ' || p_brand || ' 10 MG' AS medication_name, {_date('l_shipdate')} AS fill_date, CAST(CAST(l_quantity AS INT) AS STRING) AS days_supply,
        CAST(CAST(l_quantity AS INT) * 2 AS STRING) AS quantity, CAST(l_linenumber AS STRING) AS refill_number,
        CAST(CAST({BILLED} * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) AS total_cost,
        CASE WHEN l_partkey % 19 <> 0 THEN CAST(CAST(CAST({BILLED} * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) END AS copay_amount,
        'PH' || CAST(l_suppkey % 12 AS STRING) AS pharmacy_id, {_id('PRV', 'l_suppkey')} AS prescriber_id, CAST(l_partkey % 2 AS STRING) AS is_generic,
        CAST(l_partkey % 5 AS STRING) AS prior_auth_required, '1995-01-01' AS _bronze_load_timestamp
        FROM {{order_lines}} JOIN {{part}} ON l_partkey = p_partkey""",
    "diagnoses_raw": f"""SELECT {_id('DX', 'l_orderkey')} || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS diagnosis_id, {_id('ENC', 'l_orderkey')} AS encounter_id,
        {_id('PAT', 'o_custkey')} AS patient_id, CASE WHEN l_partkey % 41 = 0 THEN 'z99.9' ELSE ' ' || LOWER({_pick(ICD, 'l_partkey % 20')}) END AS icd_code,
        CASE WHEN l_linenumber = 1 THEN 'principal' ELSE 'SECONDARY ' END AS diagnosis_type, CAST(l_linenumber AS STRING) AS sequence_number,
        {_date('o_orderdate')} AS diagnosis_date, {_pick([' y', 'n'], 'l_partkey % 2')} AS present_on_admission, '1995-01-01' AS _bronze_load_timestamp
        FROM {{order_lines}}""",
    "care_gaps": f"""SELECT {_id('PAT', 'o_custkey')} AS patient_id, measure_id, CASE WHEN measure_id <> 'SPC' THEN measure_name END AS measure_name,
        CASE WHEN (o_custkey + m) % 3 = 0 THEN 'True' ELSE 'False' END AS is_gap_open, last_service AS last_service_date, CAST((o_custkey * 7 + m * 31) % 500 AS STRING) AS gap_days_overdue
        FROM (SELECT o_custkey, l_partkey % 9 AS m, MAX({_date('o_orderdate')}) AS last_service FROM {{order_lines}} GROUP BY o_custkey, l_partkey % 9) g
        JOIN (SELECT measure_id, measure_name, {"CASE measure_id " + " ".join(f"WHEN '{r[0]}' THEN {i}" for i, r in enumerate(ref.HEDIS_MEASURES)) + " END"} AS idx FROM {{hedis_measures}}) h ON g.m = h.idx""",
    # ---- health plan tables -------------------------------------------------------
    "member_enrollment_raw": f"""SELECT 'ENR' || LPAD(CAST(o_custkey AS STRING), 12, '0') || '-' || ym AS enrollment_id, {_id('PAT', 'o_custkey')} AS member_id, {_id('PAT', 'o_custkey')} AS patient_id,
        {_id('PLN', '(o_custkey + y) % 40', 4)} AS plan_id, {payer_of('(o_custkey + y)')} AS payer_id, ' ' || ym AS year_month, ym || '-01' AS coverage_start, ym || '-28' AS coverage_end,
        {_pick(['active', 'ACTIVE', 'suspended'], '(o_custkey + y) % 3')} AS enrollment_status, CAST(CAST(300 + (o_custkey + y) % 40 AS DECIMAL(18,2)) AS STRING) AS pmpm_premium,
        {_pick(['true', 'false', 'false', 'False'], 'o_custkey % 4')} AS is_capitated, '1995-01-01' AS _bronze_load_timestamp
        FROM (SELECT o_custkey, SUBSTRING({_date('o_orderdate')}, 1, 7) AS ym, CAST(SUBSTRING({_date('o_orderdate')}, 1, 4) AS INT) AS y FROM {{orders}}
              GROUP BY o_custkey, SUBSTRING({_date('o_orderdate')}, 1, 7), CAST(SUBSTRING({_date('o_orderdate')}, 1, 4) AS INT)) t""",
    "premiums_raw": """SELECT REPLACE(enrollment_id, 'ENR', 'PRM') AS premium_id, member_id, plan_id, payer_id, year_month, pmpm_premium AS premium_amount,
        CASE WHEN is_capitated = 'true' THEN '75.50' ELSE '0' END AS subsidy_amount,
        CAST(CAST(CAST(pmpm_premium AS DECIMAL(18,2)) - CASE WHEN is_capitated = 'true' THEN CAST(75.5 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS STRING) AS member_paid,
        _bronze_load_timestamp FROM {member_enrollment_raw}""",
    "authorizations_raw": f"""SELECT {_id('AUTH', 'o_orderkey')} AS auth_id, {_id('PAT', 'o_custkey')} AS patient_id, {_id('PAT', 'o_custkey')} AS member_id,
        {_id('PRV', 'o_orderkey % (SELECT COUNT(*) FROM {supplier})')} AS provider_id, {payer_of('o_custkey')} AS payer_id, {_id('CLM', 'o_orderkey')} || '01' AS claim_id,
        {_pick(CPT, 'o_orderkey % 10')} AS cpt_code, {_pick(ICD, 'o_orderkey % 20')} AS primary_diagnosis_code, {_day_plus('o_orderdate', '-5')} AS submit_date,
        CASE WHEN o_orderkey % 10 < 8 THEN {_day_plus('o_orderdate', 'o_orderkey % 7 - 5')} END AS decision_date,
        CASE WHEN o_orderkey % 10 < 8 THEN CAST(o_orderkey % 96 AS STRING) || '.5' END AS decision_tat_hours,
        {_pick(['approved', 'Approved', 'APPROVED', 'approved', 'denied', 'Denied', ' approved', 'approved', 'pending', ''], 'o_orderkey % 10')} AS auth_outcome,
        CAST(o_orderkey % 12 AS STRING) AS auth_units_requested, CAST(o_orderkey % 6 AS STRING) AS auth_units_approved, '1995-01-01' AS _bronze_load_timestamp
        FROM {{orders}}""",
    "capitation_raw": f"""SELECT REPLACE(enrollment_id, 'ENR', 'CAP') AS capitation_id, member_id,
        {_id('PRV', "CAST(SUBSTRING(member_id, 4, 12) AS BIGINT) % (SELECT COUNT(*) FROM {supplier})")} AS provider_id, payer_id, plan_id, year_month,
        CAST(CAST(CAST(pmpm_premium AS DECIMAL(18,2)) * CAST(0.2 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) AS capitation_pmpm, '0.0' || SUBSTRING(member_id, 15, 1) AS withhold_pct,
        CASE WHEN payer_id IN ('PAY001', 'PAY005') THEN 'true' ELSE 'false' END AS bonus_eligible, _bronze_load_timestamp FROM {{member_enrollment_raw}} WHERE is_capitated = 'true'""",
    "provider_contracts_raw": f"""SELECT 'CTR' || LPAD(CAST(s_suppkey AS STRING), 12, '0') || '-' || CAST(k AS STRING) AS contract_id, {_id('PRV', 's_suppkey')} AS provider_id, {payer_of('(s_suppkey + k * 7)')} AS payer_id,
        {_pick(['ffs', 'VALUE-BASED', 'capitation'], 's_suppkey % 3')} AS contract_type, {_day_plus("DATE '1996-01-01'", 's_suppkey % 700')} AS effective_date,
        {_day_plus("DATE '2001-12-01'", '(s_suppkey * 3 + k * 50) % 400')} AS termination_date, '1.' || CAST(s_suppkey % 10 AS STRING) AS fee_schedule_pct_medicare,
        '0.0' || CAST(s_suppkey % 10 AS STRING) AS withhold_pct, '0.0' || CAST(k AS STRING) AS quality_bonus_pct, {_pick(['true', 'false', 'True'], '(s_suppkey + k) % 3')} AS is_in_network,
        '1995-01-01' AS _bronze_load_timestamp FROM (SELECT s_suppkey, 0 AS k FROM {{supplier}} UNION ALL SELECT s_suppkey, 1 AS k FROM {{supplier}}) t""",
    "hedis_compliance_raw": f"""SELECT 'HED-' || payer_id || '-' || plan_id || '-' || measure_id AS compliance_id, '2001' AS measurement_year, payer_id, plan_id, measure_id, MAX(measure_name) AS measure_name,
        CAST(COUNT(*) AS STRING) AS denominator_eligible, CAST(SUM(CASE WHEN is_gap_open = 'False' THEN 1 ELSE 0 END) AS STRING) AS numerator_met,
        CAST(CAST(SUM(CASE WHEN is_gap_open = 'False' THEN 1 ELSE 0 END) * 100 AS INT) AS STRING) AS compliance_rate, '1995-01-01' AS _bronze_load_timestamp
        FROM (SELECT measure_id, measure_name, is_gap_open, {payer_of("CAST(SUBSTRING(patient_id, 4, 12) AS BIGINT)")} AS payer_id, {_id('PLN', 'CAST(SUBSTRING(patient_id, 4, 12) AS BIGINT) % 40', 4)} AS plan_id FROM {{care_gaps}}) t
        GROUP BY payer_id, plan_id, measure_id""",
    "star_ratings_raw": f"""SELECT 'STAR-' || payer_id || '-' || star_measure_id || '-' || y AS star_id, payer_id, y AS measurement_year, star_measure_id, star_measure_name, domain, CAST(weight AS STRING) AS weight,
        CAST(CAST(1 + (n % 9) * CAST(0.5 AS DECIMAL(4,1)) AS DECIMAL(4,1)) AS STRING) AS star_score, CAST(CAST((1 + (n % 9) * CAST(0.5 AS DECIMAL(4,1))) * weight AS DECIMAL(6,1)) AS STRING) AS weighted_score,
        '3.5' AS national_avg, '1995-01-01' AS _bronze_load_timestamp
        FROM (SELECT {payer_of('o_custkey')} AS payer_id, l_partkey % 8 AS m, SUBSTRING({_date('o_orderdate')}, 1, 4) AS y, COUNT(*) AS n FROM {{order_lines}}
              GROUP BY {payer_of('o_custkey')}, l_partkey % 8, SUBSTRING({_date('o_orderdate')}, 1, 4)) g
        JOIN (SELECT star_measure_id, star_measure_name, domain, weight, {"CASE star_measure_id " + " ".join(f"WHEN '{r[0]}' THEN {i}" for i, r in enumerate(ref.STAR_MEASURES)) + " END"} AS idx FROM {{ref_star_measures}}) s ON g.m = s.idx""",
    "risk_adjustment_raw": f"""SELECT {_id('RAF', 'c_custkey')} AS raf_id, {_id('PAT', 'c_custkey')} AS member_id, {payer_of('c_custkey')} AS payer_id, {_id('PLN', 'c_custkey % 40', 4)} AS plan_id, '2001' AS measurement_year,
        CAST(c_custkey % 4 AS STRING) AS hcc_count, CASE WHEN c_custkey % 4 > 0 THEN 'HCC18,HCC85' END AS hcc_codes, '0.' || CAST(30 + c_custkey % 40 AS STRING) AS demographic_score,
        '0.' || LPAD(CAST((c_custkey % 4) * 25 AS STRING), 2, '0') AS disease_score, CAST(c_custkey % 3 AS STRING) || '.' || CAST(10 + c_custkey % 90 AS STRING) AS raf_score, '1995-01-01' AS _bronze_load_timestamp FROM {{customer}}""",
    "claim_appeals_raw": f"""SELECT {_id('APL', 'l_orderkey')} || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS appeal_id, {_id('CLM', 'l_orderkey')} || LPAD(CAST(l_linenumber AS STRING), 2, '0') AS claim_id,
        {_id('PAT', 'o_custkey')} AS patient_id, {payer_of('o_custkey')} AS payer_id, ' Level ' || CAST(l_linenumber % 3 + 1 AS STRING) AS appeal_level, CAST(l_linenumber % 3 + 1 AS STRING) AS appeal_level_num,
        {_day_plus('o_orderdate', '30')} AS submit_date, {_day_plus('o_orderdate', '30 + l_linenumber * 5')} AS decision_date, {_pick(['overturned', 'UPHELD', ' partial'], 'l_orderkey % 3')} AS appeal_outcome,
        CAST(price AS STRING) AS appeal_amount_recovered, {_pick(['Medical necessity', 'Coding', 'Timely filing'], 'l_linenumber % 3')} AS appeal_reason, '1995-01-01' AS _bronze_load_timestamp
        FROM (SELECT l_orderkey, l_linenumber, o_custkey, MIN(o_orderdate) AS o_orderdate, MAX({ALLOWED}) AS price FROM {{order_lines}} WHERE l_returnflag = 'A' GROUP BY l_orderkey, l_linenumber, o_custkey) t""",
}


def inputs_of(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(text) if field})


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table, split as its files are."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batch_table(spark: SparkSession, name: str, lookup) -> DataFrame:
    """One derived table; ``lookup(name)`` gives the DataFrame of an input."""
    text = BATCH[name]
    return spark.sql(text, **{n: lookup(n) for n in inputs_of(text)})


def event_sql() -> dict[str, str]:
    """The event inputs: JSON messages and bedside readings."""
    from wardlight.sources.domain_events import LANDING_SQL, VITALS_SQL

    return {"landing_raw": LANDING_SQL, "vitals_readings": VITALS_SQL}
