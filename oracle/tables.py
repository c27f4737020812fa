"""Named subqueries for the cleaned, keyed and aggregated tables and the events."""

from __future__ import annotations

from oracle.base import AS_OF, NOW, A, M, R, S, back, cte, dkey, initcap

# --- silver -----------------------------------------------------------------------------------

TIES = {
    "claims": """encounter_id, patient_id, provider_id, payer_id, claim_type, cpt_code, primary_diagnosis_code, service_date, submit_date, process_date, billed_amount,
        allowed_amount, paid_amount, patient_responsibility, claim_status, denial_flag, denial_reason, denial_risk_score, denial_risk_category, days_to_payment, net_collection_rate,
        appeal_date, appeal_outcome, appeal_amount_recovered""",
    "prescriptions": """encounter_id, patient_id, provider_id, rxnorm_code, medication_name, fill_date, days_supply, quantity, refill_number, total_cost, copay_amount, pharmacy_id,
        prescriber_id, is_generic, prior_auth_required""",
    "diagnoses": "encounter_id, patient_id, icd_code, diagnosis_type, sequence_number, diagnosis_date, present_on_admission",
}


def one_row(table: str, key: str) -> str:
    ties = "".join(f", {c.strip()} DESC NULLS LAST" for c in TIES.get(table, "").split(",") if c.strip())
    return f"(SELECT * FROM {table}_raw QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY _bronze_load_timestamp DESC{ties}) = 1) t"


def d(c: str) -> str:
    return f"TRY_CAST({c} AS DATE)"


def num(c: str, t: str) -> str:
    return f"TRY_CAST({c} AS {t})"


def digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def replace(**cols: str) -> str:
    return "REPLACE (" + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + ")"


MONEY = "DECIMAL(18,2)"

cte("patients_clean", f"""SELECT * {replace(first_name=initcap('first_name'), last_name=initcap('last_name'),
    gender="CASE WHEN upper(gender) IN ('M','MALE') THEN 'Male' WHEN upper(gender) IN ('F','FEMALE') THEN 'Female' ELSE 'Unknown' END",
    state='upper(trim(state))', zip_code=digits('zip_code'), phone=digits('phone'), email='lower(trim(email))', date_of_birth=d('date_of_birth'))} FROM {one_row('patients', 'patient_id')}""")
cte("providers_clean", f"""SELECT * {replace(first_name=initcap('first_name'), last_name=initcap('last_name'), specialty=initcap('specialty'), department=initcap('department'),
    npi=digits('npi'), email='lower(trim(email))', hire_date=d('hire_date'))}, status = 'Active' AS is_active FROM {one_row('providers', 'provider_id')}""")
cte("encounters_clean", f"""SELECT * {replace(encounter_type=initcap('encounter_type'), admission_type=initcap('admission_type'), discharge_disposition=initcap('discharge_disposition'),
    discharge_date=d('discharge_date'), total_charges=num('total_charges', MONEY), readmission_risk=num('readmission_risk', 'DOUBLE'),
    length_of_stay="CASE WHEN discharge_date IS NOT NULL AND admit_date IS NOT NULL THEN CAST(discharge_date AS DATE) - CAST(admit_date AS DATE) ELSE CAST(length_of_stay AS INTEGER) END")},
    CAST(admit_date AS DATE) AS encounter_date FROM {one_row('encounters', 'encounter_id')}""")
cte("claims_clean", f"""SELECT * {replace(claim_type=initcap('claim_type'), claim_status=initcap('claim_status'), service_date=d('service_date'), billed_amount=num('billed_amount', MONEY),
    allowed_amount=num('allowed_amount', MONEY), paid_amount=num('paid_amount', MONEY), denial_flag="COALESCE(TRY_CAST(denial_flag AS INTEGER), 0)", denial_risk_score=num('denial_risk_score', 'DOUBLE'),
    denial_risk_category=initcap('denial_risk_category'), days_to_payment=num('days_to_payment', 'INTEGER'), net_collection_rate=num('net_collection_rate', 'DOUBLE'),
    appeal_outcome=initcap('appeal_outcome'), appeal_amount_recovered=num('appeal_amount_recovered', MONEY))},
    {d('submit_date')} AS claim_date, {d('process_date')} AS payment_date FROM {one_row('claims', 'claim_id')}""")
cte("prescriptions_clean", f"""SELECT * {replace(medication_name=initcap('medication_name'), fill_date=d('fill_date'), days_supply=num('days_supply', 'INTEGER'), quantity=num('quantity', 'INTEGER'),
    refill_number=num('refill_number', 'INTEGER'), is_generic=num('is_generic', 'INTEGER'), total_cost=num('total_cost', MONEY), copay_amount=num('copay_amount', MONEY))} FROM {one_row('prescriptions', 'prescription_id')}""")
cte("diagnoses_clean", f"""SELECT * {replace(icd_code='upper(trim(icd_code))', diagnosis_type=initcap('diagnosis_type'), present_on_admission='upper(trim(present_on_admission))',
    sequence_number=num('sequence_number', 'INTEGER'), diagnosis_date=d('diagnosis_date'))} FROM {one_row('diagnoses', 'diagnosis_id')}""")
cte("member_enrollment_clean", f"""SELECT * {replace(year_month='trim(year_month)', coverage_start=d('coverage_start'), coverage_end=d('coverage_end'), enrollment_status=initcap('enrollment_status'),
    pmpm_premium=num('pmpm_premium', MONEY), is_capitated=num('is_capitated', 'BOOLEAN'))} FROM {one_row('member_enrollment', 'enrollment_id')}""")
cte("premiums_clean", f"""SELECT * {replace(year_month='trim(year_month)', premium_amount=num('premium_amount', MONEY), subsidy_amount=num('subsidy_amount', MONEY), member_paid=num('member_paid', MONEY))} FROM {one_row('premiums', 'premium_id')}""")
cte("authorizations_clean", f"""SELECT * {replace(submit_date=d('submit_date'), decision_date=d('decision_date'), decision_tat_hours=num('decision_tat_hours', 'DOUBLE'), auth_outcome=initcap('auth_outcome'),
    auth_units_requested=num('auth_units_requested', 'INTEGER'), auth_units_approved=num('auth_units_approved', 'INTEGER'))} FROM {one_row('authorizations', 'auth_id')}""")
cte("capitation_clean", f"""SELECT * {replace(year_month='trim(year_month)', capitation_pmpm=num('capitation_pmpm', MONEY), withhold_pct=num('withhold_pct', 'DOUBLE'), bonus_eligible=num('bonus_eligible', 'BOOLEAN'))} FROM {one_row('capitation', 'capitation_id')}""")
cte("provider_contracts_clean", f"""SELECT * {replace(contract_type=initcap('contract_type'), effective_date=d('effective_date'), termination_date=d('termination_date'),
    fee_schedule_pct_medicare=num('fee_schedule_pct_medicare', 'DOUBLE'), withhold_pct=num('withhold_pct', 'DOUBLE'), quality_bonus_pct=num('quality_bonus_pct', 'DOUBLE'),
    is_in_network=num('is_in_network', 'BOOLEAN'))} FROM {one_row('provider_contracts', 'contract_id')}""")
cte("hedis_compliance_clean", f"""SELECT * {replace(measurement_year=num('measurement_year', 'INTEGER'), denominator_eligible=num('denominator_eligible', 'INTEGER'), numerator_met=num('numerator_met', 'INTEGER'),
    compliance_rate=num('compliance_rate', 'DOUBLE'))} FROM {one_row('hedis_compliance', 'compliance_id')}""")
cte("star_ratings_clean", f"""SELECT * {replace(measurement_year=num('measurement_year', 'INTEGER'), weight=num('weight', 'INTEGER'), star_score=num('star_score', 'DOUBLE'), weighted_score=num('weighted_score', 'DOUBLE'),
    national_avg=num('national_avg', 'DOUBLE'))} FROM {one_row('star_ratings', 'star_id')}""")
cte("risk_adjustment_clean", f"""SELECT * {replace(measurement_year=num('measurement_year', 'INTEGER'), hcc_count=num('hcc_count', 'INTEGER'), demographic_score=num('demographic_score', 'DOUBLE'),
    disease_score=num('disease_score', 'DOUBLE'), raf_score=num('raf_score', 'DOUBLE'))} FROM {one_row('risk_adjustment', 'raf_id')}""")
cte("claim_appeals_clean", f"""SELECT * {replace(appeal_level='trim(appeal_level)', appeal_level_num=num('appeal_level_num', 'INTEGER'), submit_date=d('submit_date'), decision_date=d('decision_date'),
    appeal_outcome=initcap('appeal_outcome'), appeal_amount_recovered=num('appeal_amount_recovered', MONEY), appeal_reason='trim(appeal_reason)')} FROM {one_row('claim_appeals', 'appeal_id')}""")

# --- enrichment -----------------------------------------------------------------------------------


def years(later: str, earlier: str) -> str:
    return f"CAST(FLOOR(({later} - {earlier}) / 365.25) AS INTEGER)"


cte("patients_enriched", f"""SELECT *, CASE WHEN age < 18 THEN 'Pediatric' WHEN age < 40 THEN 'Young Adult' WHEN age < 65 THEN 'Adult' ELSE 'Senior' END AS age_group
    FROM (SELECT *, {years(AS_OF, 'date_of_birth')} AS age FROM patients_clean) t""")
cte("providers_enriched", f"""SELECT p.* EXCLUDE (facility_name), f.name AS facility_name, f.type AS facility_type, {years(AS_OF, 'hire_date')} AS years_of_service
    FROM providers_clean p LEFT JOIN ref_facilities f ON p.facility_id = f.id""")
cte("encounters_enriched", """SELECT e.*, p.first_name AS patient_first_name, p.last_name AS patient_last_name, p.date_of_birth, v.first_name AS provider_first_name,
    v.last_name AS provider_last_name, v.specialty, f.name AS facility_name, f.type AS facility_type
    FROM encounters_clean e LEFT JOIN patients_clean p USING (patient_id) LEFT JOIN providers_clean v USING (provider_id) LEFT JOIN ref_facilities f ON e.facility_id = f.id""")
cte("claims_enriched", f"""SELECT c.*, payer_name, payer_type, CASE WHEN billed_amount > 0 THEN {R('paid_amount / billed_amount', 4)} ELSE 0 END AS payment_ratio,
    {AS_OF} - claim_date AS claim_age_days FROM claims_clean c LEFT JOIN ref_payers p USING (payer_id)""")
cte("prescriptions_enriched", f"""SELECT r.*, m.medication_name AS ref_medication_name, m.generic_name, m.drug_class, m.therapeutic_area, m.route, m.form, m.strength, m.is_chronic,
    CASE WHEN days_supply > 0 THEN {R('total_cost / days_supply', 2)} ELSE 0 END AS cost_per_day,
    CASE WHEN total_cost > 0 AND copay_amount IS NOT NULL THEN {R('(total_cost - copay_amount) / total_cost', 4)} ELSE 0 END AS payer_coverage_pct
    FROM prescriptions_clean r LEFT JOIN ref_medications m USING (rxnorm_code)""")
cte("diagnoses_enriched", """SELECT x.*, c.description, c.category, c.is_chronic, e.encounter_type, e.facility_id
    FROM diagnoses_clean x LEFT JOIN ref_icd_codes c ON x.icd_code = c.code LEFT JOIN encounters_clean e USING (encounter_id)""")

# --- dimensions ----------------------------------------------------------------------------------------


def numbered(sk: str, bk: str, source: str) -> str:
    return f"SELECT *, ROW_NUMBER() OVER (ORDER BY {bk}) AS {sk} FROM ({source}) t"


cte("dim_date", f"""SELECT {dkey('full_date')} AS date_key, full_date, dayofweek(full_date) + 1 AS day_of_week, dayname(full_date) AS day_name, day(full_date) AS day_of_month,
    dayofyear(full_date) AS day_of_year, weekofyear(full_date) AS week_of_year, month(full_date) AS month_number, monthname(full_date) AS month_name, quarter(full_date) AS quarter,
    year(full_date) AS year, CASE WHEN dayofweek(full_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
    CASE WHEN month(full_date) >= 7 THEN year(full_date) + 1 ELSE year(full_date) END AS fiscal_year,
    CASE WHEN month(full_date) IN (7,8,9) THEN 1 WHEN month(full_date) IN (10,11,12) THEN 2 WHEN month(full_date) IN (1,2,3) THEN 3 ELSE 4 END AS fiscal_quarter
    FROM (SELECT CAST(unnest(generate_series(make_timestamp(a - 2, 1, 1, 0, 0, 0), make_timestamp(b + 2, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS DATE) AS full_date
    FROM (SELECT year(MIN(o_orderdate)) AS a, year(MAX(o_orderdate)) AS b FROM orders) y) t""")
cte("dim_patient", numbered("patient_key", "patient_id", """SELECT patient_id, first_name, last_name, date_of_birth, gender, address, city, state, zip_code, phone, email, insurance_type, insurance_provider,
    CAST(NULL AS VARCHAR) AS insurance_policy_number, age, age_group, 1 AS is_current, TIMESTAMP '1995-01-01' AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date FROM patients_enriched"""))
cte("dim_provider", numbered("provider_key", "provider_id", """SELECT provider_id, first_name, last_name, 'Dr. ' || first_name || ' ' || last_name AS display_name, npi AS npi_number, specialty,
    COALESCE(department, 'General') AS department, facility_id, CAST(is_active AS INTEGER) AS is_active, COALESCE(contract_type, 'FFS') AS contract_type, COALESCE(fte_status, 'Full-time') AS fte_status,
    COALESCE(CAST(years_experience AS INTEGER), 0) AS years_experience, COALESCE(TRY_CAST(board_certified AS BOOLEAN), false) AS board_certified, CAST(patient_panel_size AS INTEGER) AS patient_panel_size,
    CAST(annual_rvu_target AS INTEGER) AS annual_rvu_target, CAST(actual_rvu AS INTEGER) AS actual_rvu, CAST(patient_satisfaction_score AS DOUBLE) AS patient_satisfaction_score,
    CAST(telehealth_enabled AS BOOLEAN) AS telehealth_enabled, CAST(documentation_score AS INTEGER) AS documentation_score, CAST(ehr_adoption_score AS INTEGER) AS ehr_adoption_score,
    1 AS is_current, TIMESTAMP '1995-01-01' AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date FROM providers_enriched"""))
cte("dim_payer", numbered("payer_key", "payer_id", "SELECT *, 1 AS is_active FROM ref_payers"))
cte("dim_facility", numbered("facility_key", "facility_id", "SELECT id AS facility_id, name AS facility_name, type AS facility_type, city, state, beds AS bed_count, latitude, longitude, 1 AS is_active FROM ref_facilities"))
cte("dim_medication", numbered("medication_key", "rxnorm_code", "SELECT *, 1 AS is_active FROM ref_medications"))
cte("dim_diagnosis", numbered("diagnosis_key", "icd_code", "SELECT code AS icd_code, description AS icd_description, category AS icd_category, is_chronic, 1 AS is_active FROM ref_icd_codes"))
cte("dim_location", numbered("location_key", "location_id", "SELECT location_id, location_name, 1 AS is_active FROM ref_locations"))
cte("dim_monitor", """SELECT s.*, facility_key, location_key, CAST(NULL AS BIGINT) AS patient_key FROM (SELECT ROW_NUMBER() OVER (ORDER BY device_id) AS monitor_key, device_id, device_type, device_model,
    location_id, unit_name, CAST(floor_number AS INTEGER) AS floor_number, building, facility_id, CAST(is_active AS INTEGER) AS is_active FROM ref_devices) s
    LEFT JOIN dim_facility USING (facility_id) LEFT JOIN dim_location USING (location_id)""".replace("SELECT s.*, facility_key", "SELECT s.*, dim_facility.facility_key"))
cte("sdoh_scored", f"""SELECT *, CASE WHEN composite_svi_score > 0.25 THEN 'High' WHEN composite_svi_score > 0.15 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM (SELECT *,
    {R('poverty_rate * 0.25 + uninsured_rate * 0.20 + food_insecurity_rate * 0.20 + unemployment_rate * 0.15 + no_vehicle_pct * 0.10 + (1 - median_household_income / 120000) * 0.10', 4)} AS composite_svi_score
    FROM ref_sdoh_zipcode) t""")
cte("dim_sdoh", numbered("sdoh_key", "zip_code", """SELECT zip_code, state, poverty_rate, CASE WHEN food_insecurity_rate > 0.15 THEN 1 ELSE 0 END AS food_desert_flag, 1.0::DOUBLE - no_vehicle_pct AS transportation_score,
    CAST(NULL AS DOUBLE) AS housing_instability_rate, uninsured_rate, CAST(NULL AS DOUBLE) AS broadband_access_pct, CAST(median_household_income AS INTEGER) AS median_household_income, CAST(NULL AS INTEGER) AS population,
    composite_svi_score AS social_vulnerability_index, risk_tier, 1 AS is_active FROM sdoh_scored"""))
cte("dim_plan", numbered("plan_key", "plan_id", "SELECT *, 1 AS is_active FROM ref_plans"))

# --- facts ---------------------------------------------------------------------------------------------------

cte("fact_encounter", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY encounter_id) AS encounter_key, CASE WHEN readmission_risk_score >= 0.5 THEN 1 ELSE 0 END AS readmission_flag,
    CASE WHEN readmission_risk_score >= 0.7 THEN 'High' WHEN readmission_risk_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS readmission_risk_category FROM (
    SELECT encounter_id, {dkey('encounter_date')} AS encounter_date_key, {dkey('COALESCE(discharge_date, encounter_date)')} AS discharge_date_key, patient_key, provider_key, facility_key,
    encounter_type, admission_type, discharge_disposition, COALESCE(length_of_stay, 1) AS length_of_stay, total_charges,
    CAST(COALESCE(CAST(cost_to_deliver AS DECIMAL(18,2)), total_charges * 0.7) AS DECIMAL(18,2)) AS total_cost, primary_diagnosis_code, drg_code, drg_description, CAST(drg_weight AS DOUBLE) AS drg_weight,
    CAST(expected_reimbursement AS DECIMAL(18,2)) AS expected_reimbursement,
    COALESCE(readmission_risk, CASE WHEN length_of_stay >= 10 THEN 0.80 WHEN length_of_stay >= 5 AND encounter_type = 'Inpatient' THEN 0.65 WHEN encounter_type = 'Emergency' THEN 0.55
        WHEN length_of_stay >= 3 THEN 0.35 ELSE 0.15 END::DOUBLE) AS readmission_risk_score
    FROM encounters_enriched e LEFT JOIN (SELECT patient_id, patient_key FROM dim_patient) p USING (patient_id) LEFT JOIN (SELECT provider_id, provider_key FROM dim_provider) v USING (provider_id)
    LEFT JOIN (SELECT facility_id, facility_key FROM dim_facility) f USING (facility_id)) t""")


def bucket(col: str, n: int) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 8))::BIGINT % {n} AS INTEGER)"


REASONS = ["Prior Authorization Required", "Not Medically Necessary", "Coding Error", "Coverage Expired", "Duplicate Claim", "Out of Network", "Missing Documentation"]
ACTIONS = ["Obtain prior authorization and resubmit", "Submit additional clinical documentation", "Correct coding and resubmit", "Verify eligibility and resubmit", "Verify not a duplicate claim",
           "Verify network status or obtain authorization", "Gather missing documentation and resubmit"]
REASON_AT = f"{REASONS}[{bucket('claim_id', 7)} + 1]"
ACTION_AT = f"{ACTIONS}[{bucket('claim_id', 7)} + 1]"


def claim_fact(denied: str) -> str:
    return f"""SELECT *, ROW_NUMBER() OVER (ORDER BY claim_id) AS claim_key, CASE WHEN denial_risk_score >= 0.6 THEN 'High' WHEN denial_risk_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS denial_risk_category FROM (
    SELECT claim_id, {dkey('claim_date')} AS claim_date_key, {dkey('COALESCE(payment_date, claim_date)')} AS payment_date_key, patient_key, provider_key, payer_key, encounter_key, facility_key, claim_type,
    CASE WHEN denied THEN 'Denied' ELSE claim_status END AS claim_status, primary_diagnosis_code, billed_amount,
    CAST(COALESCE(allowed_amount, billed_amount * 0.85) AS DECIMAL(18,2)) AS allowed_amount, CAST(COALESCE(paid_amount, billed_amount * 0.80) AS DECIMAL(18,2)) AS paid_amount,
    CAST(denied AS INTEGER) AS denial_flag,
    CAST(CASE WHEN denied THEN 0.75 WHEN billed_amount > 50000 THEN 0.55 WHEN billed_amount > 20000 THEN 0.40 WHEN billed_amount > 10000 THEN 0.30 ELSE 0.15 END AS DOUBLE) AS denial_risk_score,
    CASE WHEN denied THEN COALESCE(denial_reason, {REASON_AT}) END AS primary_denial_reason, CASE WHEN denied THEN {ACTION_AT} END AS recommended_action,
    COALESCE(days_to_payment, COALESCE(payment_date, claim_date) - claim_date) AS days_to_payment,
    COALESCE(net_collection_rate, CASE WHEN allowed_amount > 0 THEN CAST(COALESCE(paid_amount, 0) AS DOUBLE) / CAST(allowed_amount AS DOUBLE) ELSE 0 END) AS net_collection_rate,
    appeal_date, appeal_outcome, appeal_amount_recovered
    FROM (SELECT *, {denied} AS denied FROM claims_enriched) c LEFT JOIN (SELECT patient_id, patient_key FROM dim_patient) p USING (patient_id)
    LEFT JOIN (SELECT provider_id, provider_key FROM dim_provider) v USING (provider_id) LEFT JOIN (SELECT payer_id, payer_key FROM dim_payer) y USING (payer_id)
    LEFT JOIN (SELECT encounter_id, encounter_key, facility_key FROM fact_encounter) e USING (encounter_id)) t"""


cte("fact_claim", claim_fact("claim_status = 'Denied'"))
cte("encounter_payer", "SELECT encounter_id, arg_min(payer_key, claim_id) AS payer_key FROM claims_clean JOIN dim_payer USING (payer_id) GROUP BY encounter_id")
cte("fact_prescription", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY prescription_id) AS prescription_key FROM (
    SELECT prescription_id, CAST(NULL AS VARCHAR) AS prescription_group_id, {dkey('fill_date')} AS fill_date_key, patient_key, provider_key, payer_key, encounter_key, medication_key, facility_key,
    refill_number AS fill_number, days_supply, quantity AS quantity_dispensed, CAST(NULL AS INTEGER) AS refills_authorized, is_generic, CAST(NULL AS INTEGER) AS is_chronic_medication,
    CAST(NULL AS VARCHAR) AS pharmacy_type, total_cost, CAST(COALESCE(total_cost, 0) - COALESCE(copay_amount, 0) AS DECIMAL(18,2)) AS payer_paid, copay_amount AS patient_copay,
    CAST(NULL AS VARCHAR) AS prescribing_reason_code
    FROM prescriptions_clean r JOIN (SELECT patient_id, patient_key FROM dim_patient) p USING (patient_id) JOIN (SELECT provider_id, provider_key FROM dim_provider) v USING (provider_id)
    LEFT JOIN (SELECT rxnorm_code, medication_key FROM dim_medication) m USING (rxnorm_code) LEFT JOIN (SELECT encounter_id, encounter_key, facility_key FROM fact_encounter) e USING (encounter_id)
    LEFT JOIN encounter_payer USING (encounter_id)) t""")
cte("fact_diagnosis", """SELECT ROW_NUMBER() OVER (ORDER BY diagnosis_id) AS fact_diagnosis_key, diagnosis_id, encounter_key, encounter_date_key AS diagnosis_date_key, patient_key, diagnosis_key, facility_key,
    x.icd_code, sequence_number AS diagnosis_sequence, diagnosis_type, present_on_admission
    FROM diagnoses_clean x LEFT JOIN (SELECT patient_id, patient_key FROM dim_patient) p USING (patient_id) LEFT JOIN (SELECT icd_code, diagnosis_key FROM dim_diagnosis) g USING (icd_code)
    LEFT JOIN (SELECT encounter_id, encounter_key, facility_key, encounter_date_key FROM fact_encounter) e USING (encounter_id)""")
MEMBER = "LEFT JOIN (SELECT patient_id AS member_id, patient_key AS member_key FROM dim_patient) mp USING (member_id)"
PROVIDER_J = "LEFT JOIN (SELECT provider_id, provider_key FROM dim_provider) v USING (provider_id)"
PAYER_J = "LEFT JOIN (SELECT payer_id, payer_key FROM dim_payer) y USING (payer_id)"
PLAN_J = "LEFT JOIN (SELECT plan_id, plan_key FROM dim_plan) l USING (plan_id)"
cte("fact_premium", f"""SELECT ROW_NUMBER() OVER (ORDER BY premium_id) AS premium_key, premium_id, year_month, CAST(replace(year_month, '-', '') AS INTEGER) * 100 + 1 AS year_month_key, member_key, plan_key, payer_key,
    premium_amount, subsidy_amount, member_paid FROM premiums_clean {MEMBER} {PLAN_J} {PAYER_J}""")
cte("fact_authorization", f"""SELECT ROW_NUMBER() OVER (ORDER BY auth_id) AS auth_key, auth_id, {dkey('submit_date')} AS submit_date_key, {dkey('decision_date')} AS decision_date_key, member_key, provider_key, payer_key,
    claim_id, cpt_code, primary_diagnosis_code, auth_outcome, decision_tat_hours, auth_units_requested, auth_units_approved FROM authorizations_clean {MEMBER} {PROVIDER_J} {PAYER_J}""")
cte("fact_capitation", f"""SELECT ROW_NUMBER() OVER (ORDER BY capitation_id) AS capitation_key, capitation_id, year_month, member_key, provider_key, payer_key, plan_key, capitation_pmpm, withhold_pct, bonus_eligible
    FROM capitation_clean {MEMBER} {PROVIDER_J} {PAYER_J} {PLAN_J}""")
cte("fact_appeal", f"""SELECT ROW_NUMBER() OVER (ORDER BY appeal_id) AS appeal_key, appeal_id, claim_key, a.claim_id, member_key, payer_key, {dkey('submit_date')} AS submit_date_key, {dkey('decision_date')} AS decision_date_key,
    appeal_level, appeal_level_num, appeal_outcome, appeal_amount_recovered, appeal_reason FROM (SELECT *, patient_id AS member_id FROM claim_appeals_clean) a {MEMBER} {PAYER_J}
    LEFT JOIN (SELECT claim_id, claim_key FROM fact_claim) c USING (claim_id)""")
cte("bridge_provider_contract", f"""SELECT contract_id, provider_key, payer_key, contract_type, effective_date, termination_date, fee_schedule_pct_medicare, withhold_pct, quality_bonus_pct, is_in_network
    FROM provider_contracts_clean {PROVIDER_J} {PAYER_J}""")

# --- aggregates -----------------------------------------------------------------------------------------------


def cats(col: str) -> str:
    return ", ".join(f"COUNT(*) FILTER (WHERE {col} = '{c}') AS {c.lower()}_risk_count" for c in ("High", "Medium", "Low"))


DENIED = "denial_flag = 1"
cte("agg_readmission_by_date", f"""SELECT encounter_date_key, encounter_type, COUNT(*) AS total_encounters, {cats('readmission_risk_category')}, {M('readmission_risk_score')} AS avg_risk_score,
    COUNT(*) FILTER (WHERE readmission_flag = 1) AS actual_readmissions, {S('total_charges')} AS total_charges, {M('length_of_stay')} AS avg_length_of_stay FROM fact_encounter GROUP BY 1, 2""")
cte("agg_denial_by_date", f"""SELECT claim_date_key, claim_type, COUNT(*) AS total_claims, {cats('denial_risk_category')}, {M('denial_risk_score')} AS avg_risk_score, COUNT(*) FILTER (WHERE {DENIED}) AS actual_denials,
    {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {S("CASE WHEN denial_risk_category = 'High' THEN billed_amount ELSE 0 END")} AS at_risk_amount FROM fact_claim GROUP BY 1, 2""")
cte("agg_denial_by_payer", f"""SELECT *, denied_claims / total_claims AS denial_rate FROM (SELECT claim_date_key, payer_name, payer_type, primary_denial_reason, COUNT(*) AS total_claims,
    COUNT(*) FILTER (WHERE {DENIED}) AS denied_claims, {S('billed_amount')} AS total_billed, {S('CASE WHEN denial_flag = 1 THEN billed_amount ELSE 0 END')} AS denied_amount,
    {S('paid_amount')} AS total_paid, {M('denial_risk_score')} AS avg_denial_risk_score FROM fact_claim LEFT JOIN (SELECT payer_key, payer_name, payer_type FROM dim_payer) p USING (payer_key) GROUP BY 1, 2, 3, 4) t""")
cte("agg_revenue_by_drg", f"""SELECT *, {R('avg_expected_reimbursement - avg_cost_to_deliver', 4)} AS margin_per_case,
    CASE WHEN avg_cost_to_deliver > 0 THEN {R('(avg_expected_reimbursement - avg_cost_to_deliver) / avg_cost_to_deliver * 100', 6)} ELSE 0 END AS margin_pct FROM (
    SELECT drg_code, drg_description, COUNT(*) AS encounter_count, {A('total_charges')} AS avg_charges, {A('total_cost')} AS avg_cost_to_deliver, {A('expected_reimbursement')} AS avg_expected_reimbursement,
    {M('drg_weight')} AS avg_drg_weight, {M('length_of_stay')} AS avg_los, {S('total_charges')} AS total_charges, {S('total_cost')} AS total_cost_to_deliver,
    {S('expected_reimbursement')} AS total_expected_reimbursement FROM fact_encounter WHERE drg_code IS NOT NULL GROUP BY 1, 2) t""")
cte("agg_days_in_ar", f"""SELECT claim_date_key, payer_name, payer_type, COUNT(*) AS claim_count, {M('days_to_payment')} AS avg_days_to_payment, quantile_disc(days_to_payment, 0.5) AS median_days_to_payment,
    quantile_disc(days_to_payment, 0.9) AS p90_days_to_payment, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {M('net_collection_rate')} AS avg_net_collection_rate
    FROM fact_claim LEFT JOIN (SELECT payer_key, payer_name, payer_type FROM dim_payer) p USING (payer_key) WHERE days_to_payment IS NOT NULL GROUP BY 1, 2, 3""")
cte("agg_appeal_outcomes", f"""SELECT payer_name, primary_denial_reason AS denial_reason, appeal_outcome, COUNT(*) AS appeal_count, {S('billed_amount')} AS total_billed,
    {S('appeal_amount_recovered')} AS total_amount_recovered, {A('appeal_amount_recovered')} AS avg_amount_recovered
    FROM fact_claim LEFT JOIN (SELECT payer_key, payer_name FROM dim_payer) p USING (payer_key) WHERE appeal_outcome IS NOT NULL GROUP BY 1, 2, 3""")
cte("agg_mlr_by_payer_month", f"""SELECT payer_key, year_month, premium_collected, medical_paid, billed, claim_count, payer_id, payer_name, payer_type,
    CASE WHEN premium_collected > 0 THEN medical_paid / premium_collected END AS mlr_pct FROM (SELECT payer_key, year_month, {S('premium_amount')} AS premium_collected FROM fact_premium GROUP BY 1, 2) a
    FULL JOIN (SELECT payer_key, substr(CAST(claim_date_key AS VARCHAR), 1, 4) || '-' || substr(CAST(claim_date_key AS VARCHAR), 5, 2) AS year_month, {S('paid_amount')} AS medical_paid,
    {S('billed_amount')} AS billed, COUNT(*) AS claim_count FROM fact_claim GROUP BY 1, 2) b USING (payer_key, year_month) LEFT JOIN (SELECT payer_key, payer_id, payer_name, payer_type FROM dim_payer) p USING (payer_key)""")
cte("agg_hedis_compliance", f"""SELECT compliance_id, measurement_year, payer_key, plan_key, measure_id, measure_name, denominator_eligible, numerator_met, compliance_rate FROM hedis_compliance_clean {PAYER_J} {PLAN_J}""")
cte("agg_star_rating", f"SELECT star_id, payer_key, measurement_year, star_measure_id, star_measure_name, domain, weight, star_score, weighted_score, national_avg FROM star_ratings_clean {PAYER_J}")
cte("agg_star_rating_overall", f"""SELECT payer_key, measurement_year, {R('SUM(weighted_score) / SUM(weight)', 6)} AS overall_star_score, CAST(SUM(weight) AS BIGINT) AS total_weight, COUNT(*) AS measure_count
    FROM agg_star_rating GROUP BY 1, 2""")
cte("agg_raf_score", f"""SELECT raf_id, member_key, payer_key, plan_key, measurement_year, hcc_count, hcc_codes, demographic_score, disease_score, raf_score FROM risk_adjustment_clean {MEMBER} {PAYER_J} {PLAN_J}""")
PDC_CAT = "CASE WHEN pdc_score >= 0.80 THEN 'Adherent' WHEN pdc_score >= 0.50 THEN 'Partially Adherent' ELSE 'Non-Adherent' END"
cte("agg_medication_adherence", f"""SELECT *, {PDC_CAT} AS adherence_category, days_in_period - covered_days AS gap_days, patient_key * 100000 + medication_key AS adherence_key FROM (
    SELECT *, LEAST(CAST(covered_days AS DOUBLE) / days_in_period, 1.0) AS pdc_score FROM (SELECT *, LEAST(total_days_supply, days_in_period) AS covered_days FROM (
    SELECT patient_key, medication_key, drug_class, therapeutic_area, MIN(fill_date_key) AS measurement_period_start, MAX(fill_date_key) AS measurement_period_end, COUNT(*) AS total_fills,
    CAST(SUM(days_supply) AS BIGINT) AS total_days_supply, CAST(MAX(full_date) - MIN(full_date) + SUM(days_supply) AS BIGINT) AS days_in_period, {S('total_cost')} AS total_medication_cost,
    {S('payer_paid')} AS total_payer_cost, {S('patient_copay')} AS total_patient_cost, MAX(is_chronic) AS is_chronic
    FROM fact_prescription JOIN (SELECT medication_key, drug_class, therapeutic_area, is_chronic FROM dim_medication) m USING (medication_key) JOIN dim_date ON date_key = fill_date_key GROUP BY 1, 2, 3, 4) a) b) c""")

# --- events ------------------------------------------------------------------------------------------------------

cte("landing", "SELECT body, ingest_ts, json_valid(body) AS ok, CASE WHEN json_valid(body) THEN json_extract_string(body, '$._table') END AS tag FROM landing_raw")

EVENT_COLUMNS = {
    "claims_events": "event_id:k event_timestamp:t event_type:k claim_id:s patient_id:k provider_id:s facility_id:s payer_id:s diagnosis_code:s procedure_code:s claim_type:s claim_amount:r latitude:R longitude:R injected_fraud_flags:s",
    "adt_events": "event_id:k event_timestamp:t event_type:k patient_id:k facility_id:s facility_name:s admission_type:s primary_diagnosis:s latitude:R longitude:R has_open_care_gaps:b open_gap_measures:s",
    "rx_events": "event_id:k event_timestamp:t event_type:k patient_id:k provider_id:s medication_code:s medication_name:s drug_class:s quantity:i days_supply:i latitude:R longitude:R",
    "readmission_events": "event_id:k event_timestamp:t event_type:k patient_id:k provider_id:s facility_id:s current_encounter_id:s prior_discharge_date:t days_since_discharge:i current_diagnosis:s prior_diagnosis:s readmission_risk_score:r drg_code:s latitude:R longitude:R",
    "quality_metric_events": "event_id:k event_timestamp:t event_type:k provider_id:s provider_name:s specialty:s facility_id:s metric_name:s metric_value:r benchmark_value:r direction:s rolling_window_days:i denominator:i numerator:i",
    "denial_adjudication_events": "event_id:k event_timestamp:t event_type:k claim_id:s patient_id:k provider_id:s payer_id:s payer_name:s adjudication_result:s denial_reason:s billed_amount:r allowed_amount:r paid_amount:r is_preventable:b recommended_action:s",
    "ar_snapshot_events": "event_id:k event_timestamp:t event_type:k payer_id:s payer_name:s open_claims_count:i total_ar_balance:r avg_days_in_ar:r claims_over_45_days:i claims_over_90_days:i net_collection_rate:r prior_period_avg_days:r trend_direction:s",
    "auth_lifecycle_events": "event_id:k event_timestamp:t event_type:k auth_id:s patient_id:k provider_id:s payer_id:s payer_name:s procedure_code:s procedure_description:s auth_status:s auth_expiry_date:s days_until_expiry:i scheduled_procedure_date:s estimated_charge:r",
    "clinical_deterioration_events": "event_id:k event_timestamp:t event_type:k patient_id:k encounter_id:s facility_id:s ward:s news2_score:r sirs_score:r mews_score:r deterioration_type:s requires_rrt:b primary_diagnosis:s latitude:R longitude:R",
    "mortality_hai_events": "event_id:k event_timestamp:t event_type:k facility_id:s ward:s hai_type:s organism:s cluster_size:i infection_count_72h:i severity:s latitude:R longitude:R",
    "net_revenue_variance_events": "event_id:k event_timestamp:t event_type:k claim_id:s payer_id:s payer_name:s contract_id:s contract_type:s expected_payment:r actual_payment:r variance_pct:r variance_dollars:r provider_id:s facility_id:s",
    "ops_capacity_events": "event_id:k event_timestamp:t event_type:k facility_id:s facility_name:s capacity_type:s current_value:r threshold_value:r utilization_pct:r los_hours:r ward:s latitude:R longitude:R",
    "staffing_acuity_events": "event_id:k event_timestamp:t event_type:k facility_id:s ward:s nurse_count:i patient_count:i acuity_score:r ratio_actual:r ratio_target:r staffing_gap:i",
    "dq_violation_events": "event_id:k event_timestamp:t event_type:k source_table:s rule_name:s rule_type:s expected_value:r actual_value:r violation_count:i violation_pct:r severity:s",
    "audit_access_events": "event_id:k event_timestamp:t event_type:k user_principal:s action_type:s resource_accessed:s anomaly_score:r geo_country:s severity:s",
    "model_drift_events": "event_id:k event_timestamp:t event_type:k model_name:s model_version:s feature_name:s drift_score:r psi_value:r ks_value:r baseline_period:s severity:s",
    "alert_closure_events": "closure_id:k closure_timestamp:t alert_id:k alert_source_table:s alert_type:s persona:s action_taken:s resolved_by:s resolution_notes:s mttr_seconds:l outcome:s",
}


def field(name: str, kind: str) -> str:
    text = f"json_extract_string(body, '$.{name}')"
    return {"k": text, "s": f"COALESCE({text}, '')", "t": f"TRY_CAST({text} AS TIMESTAMP)", "R": f"CAST({text} AS DOUBLE)", "r": f"COALESCE(CAST({text} AS DOUBLE), 0)",
            "i": f"COALESCE(CAST({text} AS INTEGER), 0)", "l": f"COALESCE(CAST({text} AS BIGINT), 0)", "b": f"COALESCE(CAST({text} AS BOOLEAN), false)"}[kind] + f" AS {name}"


for _table, _columns in EVENT_COLUMNS.items():
    _pairs = [c.split(":") for c in _columns.split()]
    cte(_table, f"SELECT {', '.join(field(*p) for p in _pairs)} FROM landing WHERE ok AND tag = '{_table}'")

cte("provider_baseline", f"""SELECT provider_id, {A('billed_amount')} AS hist_avg_amount, stddev_samp(CAST(billed_amount AS DOUBLE)) AS hist_std_amount, COUNT(*) AS hist_claim_count
    FROM fact_claim JOIN (SELECT provider_key, provider_id FROM dim_provider) p USING (provider_key) GROUP BY 1""")
EPOCH = "CAST(floor(epoch(event_timestamp)) AS BIGINT)"
cte("velocity", f"""SELECT *, CASE WHEN claims_in_window > 5 THEN LEAST(30, (claims_in_window - 5) * 6) ELSE 0 END AS velocity_score FROM (
    SELECT *, CASE WHEN event_timestamp IS NULL THEN 0 ELSE COUNT(claim_id) OVER (PARTITION BY provider_id, event_timestamp IS NULL ORDER BY {EPOCH} RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) END AS claims_in_window FROM claims_events) t""")
cte("fraud_scored", f"""SELECT *, CASE WHEN amount_zscore > 2 THEN LEAST(25.0, (amount_zscore - 2) * 10) ELSE 0 END AS amount_score, CASE WHEN geo_distance_deg > 1 THEN LEAST(25.0, geo_distance_deg * 5) ELSE 0 END AS geo_score,
    CASE WHEN procedure_code = '99215' THEN 20 ELSE 0 END AS upcoding_score FROM (SELECT v.*, CASE WHEN hist_std_amount > 0 THEN {R('(claim_amount - hist_avg_amount) / hist_std_amount', 6)} ELSE 0 END AS amount_zscore,
    {R('sqrt(pow(v.latitude - f.latitude, 2) + pow(v.longitude - f.longitude, 2))', 6)} AS geo_distance_deg FROM velocity v LEFT JOIN dim_facility f USING (facility_id) LEFT JOIN provider_baseline USING (provider_id)) t""")
cte("fraud_scores", f"""SELECT *, CASE WHEN fraud_score >= 50 THEN 'CRITICAL' WHEN fraud_score >= 30 THEN 'HIGH' WHEN fraud_score >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM (
    SELECT md5('FRAUD|' || event_id) AS score_id, event_timestamp AS score_timestamp, claim_id, patient_id, provider_id, facility_id, claim_amount, diagnosis_code, procedure_code, claim_type,
    {R('velocity_score + amount_score + geo_score + upcoding_score', 2)} AS fraud_score,
    concat_ws('|', CASE WHEN velocity_score > 0 THEN 'velocity_burst' END, CASE WHEN amount_score > 0 THEN 'amount_outlier' END, CASE WHEN geo_score > 0 THEN 'geo_anomaly' END, CASE WHEN upcoding_score > 0 THEN 'upcoding' END) AS fraud_flags,
    velocity_score, amount_score, geo_score, upcoding_score, claims_in_window, amount_zscore, geo_distance_deg, latitude, longitude FROM fraud_scored) t""")

cte("care_gap_alerts", """SELECT md5('CARE_GAP|' || event_id || '|' || measure_id) AS alert_id, event_timestamp AS alert_timestamp, event_id, patient_id, first_name AS patient_first_name, last_name AS patient_last_name, facility_id,
    facility_name, event_type, admission_type, primary_diagnosis, measure_id, measure_name, gap_days_overdue,
    CASE WHEN measure_id IN ('CDC','BCS','COL') AND gap_days_overdue > 180 OR gap_days_overdue > 365 THEN 'CRITICAL' WHEN measure_id IN ('CDC','BCS','COL') OR gap_days_overdue > 90 THEN 'HIGH' WHEN gap_days_overdue > 30 THEN 'MEDIUM' ELSE 'LOW' END AS alert_priority,
    'Open measure ' || measure_id || ' [' || measure_name || ']: ' || COALESCE(first_name, '') || ' ' || COALESCE(last_name, '') || ' is in the house; due since ' || gap_days_overdue || ' days.' AS alert_text,
    latitude, longitude FROM (SELECT a.event_id, a.event_timestamp, a.event_type, a.patient_id, a.facility_id, a.admission_type, a.primary_diagnosis, g.measure_id, COALESCE(h.measure_name, g.measure_name, g.measure_id) AS measure_name,
    COALESCE(TRY_CAST(g.gap_days_overdue AS INTEGER), 0) AS gap_days_overdue, p.first_name, p.last_name, COALESCE(f.facility_name, 'Unknown') AS facility_name, COALESCE(f.latitude, 42.96) AS latitude, COALESCE(f.longitude, -85.67) AS longitude
    FROM adt_events a JOIN care_gaps g USING (patient_id) LEFT JOIN dim_patient p USING (patient_id) LEFT JOIN dim_facility f ON a.facility_id = f.facility_id LEFT JOIN hedis_measures h ON g.measure_id = h.measure_id
    WHERE a.event_type IN ('ADMIT', 'OBSERVATION') AND CAST(g.is_gap_open AS BOOLEAN)) t""")

cte("rolling_spend", f"""SELECT * REPLACE (CASE WHEN event_epoch IS NULL THEN 0 ELSE rolling_spend_30d END AS rolling_spend_30d, CASE WHEN event_epoch IS NULL THEN 0 ELSE rolling_spend_90d END AS rolling_spend_90d,
    CASE WHEN event_epoch IS NULL THEN 0 ELSE claims_count_30d END AS claims_count_30d) FROM (SELECT *, CAST(SUM(CAST(COALESCE(claim_amount, 0) AS DECIMAL(18,2))) OVER (PARTITION BY patient_id ORDER BY event_epoch RANGE BETWEEN {30 * 86400} PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_spend_30d,
    CAST(SUM(CAST(COALESCE(claim_amount, 0) AS DECIMAL(18,2))) OVER (PARTITION BY patient_id ORDER BY event_epoch RANGE BETWEEN {90 * 86400} PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_spend_90d,
    COUNT(claim_id) OVER (PARTITION BY patient_id ORDER BY event_epoch RANGE BETWEEN {30 * 86400} PRECEDING AND CURRENT ROW) AS claims_count_30d
    FROM (SELECT *, {EPOCH} AS event_epoch FROM claims_events) t) u""")
cte("latest_spend", "SELECT * FROM rolling_spend WHERE event_epoch IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_id ORDER BY event_epoch DESC, event_id DESC) = 1")
cte("ed_visits", f"""SELECT patient_id, event_timestamp AS ed_event_ts, ed_visits_30d, facility_id AS ed_facility_id FROM (SELECT *, COUNT(*) OVER (PARTITION BY patient_id ORDER BY event_epoch RANGE BETWEEN {30 * 86400} PRECEDING AND CURRENT ROW) AS ed_visits_30d
    FROM (SELECT *, {EPOCH} AS event_epoch FROM adt_events WHERE admission_type = 'EMERGENCY' AND event_timestamp IS NOT NULL) t) u QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_id ORDER BY event_epoch DESC, event_id DESC) = 1""")
cte("readmission_counts", """SELECT patient_id, COUNT(*) FILTER (WHERE date_diff('day', CAST(prev AS DATE), CAST(event_timestamp AS DATE)) <= 30) AS readmission_count_30d FROM (
    SELECT patient_id, event_timestamp, lag(event_timestamp) OVER (PARTITION BY patient_id ORDER BY event_timestamp) AS prev FROM adt_events WHERE event_type = 'ADMIT' AND event_timestamp IS NOT NULL) t GROUP BY 1""")
cte("highcost_alerts", f"""SELECT *, CASE WHEN rolling_spend_30d >= 15000 AND ed_visits_30d >= 3 THEN 'CRITICAL' WHEN rolling_spend_30d >= 15000 OR rolling_spend_90d >= 40000 THEN 'HIGH'
    WHEN ed_visits_30d >= 3 OR readmission_count_30d > 0 OR cost_trend = 'ACCELERATING' THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM (
    SELECT md5('HIGH_COST|' || patient_id || '|2024-01-30 14:00:00') AS alert_id, {NOW} AS alert_timestamp, patient_id, p.first_name AS patient_first_name, p.last_name AS patient_last_name, e.ed_facility_id AS facility_id,
    COALESCE(f.facility_name, 'Unknown') AS facility_name, rolling_spend_30d, rolling_spend_90d, claims_count_30d, COALESCE(ed_visits_30d, 0) AS ed_visits_30d, COALESCE(readmission_count_30d, 0) AS readmission_count_30d,
    COALESCE(readmission_count_30d, 0) > 0 AS readmission_flag, CASE WHEN rolling_spend_30d > rolling_spend_90d / 3 * 1.5::DOUBLE THEN 'ACCELERATING' WHEN rolling_spend_30d > rolling_spend_90d / 3 * 1.1::DOUBLE THEN 'RISING'
    WHEN rolling_spend_30d < rolling_spend_90d / 3 * 0.8::DOUBLE THEN 'DECLINING' ELSE 'STABLE' END AS cost_trend, COALESCE(s.latitude, f.latitude) AS latitude, COALESCE(s.longitude, f.longitude) AS longitude
    FROM latest_spend s LEFT JOIN ed_visits e USING (patient_id) LEFT JOIN readmission_counts USING (patient_id) LEFT JOIN dim_patient p USING (patient_id) LEFT JOIN dim_facility f ON e.ed_facility_id = f.facility_id) t""")

# --- persona alerts -------------------------------------------------------------------------------------------------


def aid(kind: str) -> str:
    return f"md5('{kind}|' || event_id) AS alert_id, event_timestamp AS alert_timestamp, '{kind}' AS alert_type"


def usd(x: str) -> str:
    return f"format('{{:,}}', CAST({R(x, 0)} AS BIGINT))"


def newest(table: str, keys: str, where: str = "true") -> str:
    return f"(SELECT * FROM {table} WHERE {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) = 1) n"


cte("readmission_alerts", f"""SELECT {aid('READMISSION_30DAY')}, provider_id, COALESCE(display_name, 'Unknown') AS provider_name, patient_id, r.facility_id, CASE WHEN days_since_discharge <= 7 THEN 'CRITICAL' WHEN days_since_discharge <= 14 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    'Readmission: patient ' || COALESCE(patient_id, '') || ' was admitted again ' || days_since_discharge || ' days after leaving (group ' || drg_code || ', risk ' || readmission_risk_score || '); first ' || prior_diagnosis || ', now ' || current_diagnosis || '.' AS alert_text,
    CASE WHEN days_since_discharge <= 7 THEN 'Have a care manager look at the case today and tell the chief medical officer.' WHEN days_since_discharge <= 14 THEN 'Call the patient by tomorrow, book a visit and go through the medicines.'
    ELSE 'Discuss at the weekly review and see whether the discharge plan was kept.' END AS recommended_action, 'days_since_discharge' AS metric_name, CAST(days_since_discharge AS DOUBLE) AS metric_value, 30.0::DOUBLE AS benchmark_value,
    COALESCE(latitude, 40.84) AS latitude, COALESCE(longitude, -73.94) AS longitude FROM readmission_events r LEFT JOIN (SELECT provider_id, display_name FROM dim_provider) p USING (provider_id)""")
cte("quality_drift_alerts", f"""SELECT {aid('QUALITY_DRIFT')}, provider_id, provider_name, '' AS patient_id, facility_id, severity,
    'Quality: ' || provider_name || ' (' || specialty || '), ' || metric_name || ' = ' || {R('metric_value', 4)} || ' against ' || {R('benchmark_value', 4)} || ' (' || direction || ', n=' || denominator || ').' AS alert_text,
    CASE WHEN severity = 'CRITICAL' THEN 'Ask the medical director for a peer review of recent cases.' ELSE 'Show the clinician the figures and take them to the monthly meeting.' END AS recommended_action,
    metric_name, metric_value, benchmark_value, 40.84::DOUBLE AS latitude, -73.94::DOUBLE AS longitude FROM (SELECT *, CASE WHEN direction = 'lower_is_better' AND off > 1.30::DOUBLE THEN 'CRITICAL' WHEN direction = 'lower_is_better' AND off > 1.15::DOUBLE THEN 'HIGH'
    WHEN direction = 'higher_is_better' AND off < 0.70::DOUBLE THEN 'CRITICAL' WHEN direction = 'higher_is_better' AND off < 0.85::DOUBLE THEN 'HIGH' ELSE 'OK' END AS severity FROM (
    SELECT *, CASE WHEN benchmark_value <> 0 THEN metric_value / benchmark_value ELSE 1 END AS off FROM {newest('quality_metric_events', 'provider_id, metric_name')}) a) b WHERE severity <> 'OK'""")
cte("provider_alerts", "SELECT * FROM readmission_alerts UNION ALL BY NAME SELECT * FROM quality_drift_alerts")


def spikes(interval: str, min_claims: int = 20) -> str:
    return f"""SELECT md5('DENIAL_SPIKE|' || payer_id || '|2024-01-30 14:00:00') AS alert_id, {NOW} AS alert_timestamp, 'DENIAL_SPIKE' AS alert_type, payer_id, payer_name, '' AS claim_id, '' AS patient_id,
    CASE WHEN rate >= 0.20 THEN 'CRITICAL' WHEN rate >= 0.15 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    'Denials: ' || payer_name || ' denied ' || denied || '/' || total || ' claims (=' || {R('rate * 100', 1)} || '%) within {interval}. Top reason: ' || CASE WHEN COALESCE(top_reason, '') = '' THEN 'mixed' ELSE top_reason END || '; amount $' || {usd('dollars')} || '.' AS alert_text,
    CASE WHEN rate >= 0.20 THEN 'Inform finance leadership, hold new claims and look into the contract.' WHEN rate >= 0.15 THEN 'Find out by tomorrow why the commonest reason occurs.' ELSE 'Keep an eye on this payer and discuss it this week.' END AS recommended_action,
    dollars AS dollar_impact, COALESCE(top_reason, '') AS denial_reason, 0 AS days_until_expiry FROM (SELECT *, CAST(denied AS DOUBLE) / total AS rate FROM (
    SELECT payer_id, payer_name, COUNT(*) AS total, COUNT(*) FILTER (WHERE adjudication_result = 'DENIED') AS denied, COALESCE(CAST(SUM(CAST(billed_amount AS DECIMAL(18,2))) FILTER (WHERE adjudication_result = 'DENIED') AS DOUBLE), 0) AS dollars
    FROM denial_adjudication_events WHERE {back('event_timestamp', interval)} GROUP BY 1, 2) a
    LEFT JOIN (SELECT payer_id, payer_name, denial_reason AS top_reason FROM denial_adjudication_events WHERE adjudication_result = 'DENIED' AND {back('event_timestamp', interval)} GROUP BY 1, 2, 3
        QUALIFY ROW_NUMBER() OVER (PARTITION BY payer_id, payer_name ORDER BY COUNT(*) DESC, denial_reason) = 1) r USING (payer_id, payer_name)) t WHERE total >= {min_claims} AND rate > 0.12"""


def hi_dollar(interval: str) -> str:
    return f"""SELECT {aid('HIGH_DOLLAR_DENIAL')}, payer_id, payer_name, claim_id, patient_id, CASE WHEN billed_amount > 10000 THEN 'CRITICAL' WHEN billed_amount > 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    'Large denial' || CASE WHEN is_preventable THEN ' [PREVENTABLE]' ELSE '' END || ': claim ' || claim_id || ' (' || payer_name || ') over $' || {usd('billed_amount')} || '. Reason: ' || denial_reason || '.' AS alert_text,
    CASE WHEN recommended_action = '' THEN 'Check the claim and appeal if justified.' ELSE recommended_action END AS recommended_action, billed_amount AS dollar_impact, denial_reason, 0 AS days_until_expiry
    FROM denial_adjudication_events WHERE {back('event_timestamp', interval)} AND adjudication_result = 'DENIED' AND (billed_amount > 5000 OR is_preventable AND billed_amount > 2000)"""


cte("spikes_week", spikes("7 days"))
cte("high_dollar_week", hi_dollar("7 days"))
cte("ar_breach_alerts", f"""SELECT {aid('AR_AGING_BREACH')}, payer_id, payer_name, '' AS claim_id, '' AS patient_id, CASE WHEN avg_days_in_ar > 60 THEN 'CRITICAL' WHEN avg_days_in_ar > 50 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    'Receivables: ' || payer_name || ' pays after ' || {R('avg_days_in_ar', 1)} || ' days (aim: under 45); open claims ' || open_claims_count || ', balance $' || {usd('total_ar_balance')} || ', beyond 90 days ' || claims_over_90_days || ', trend ' || trend_direction || '.' AS alert_text,
    CASE WHEN trend_direction = 'INCREASING' THEN '[TREND ↑] ' ELSE '' END || CASE WHEN avg_days_in_ar > 60 THEN 'Inform finance leadership and meet with the payer about open balances.' WHEN avg_days_in_ar > 50 THEN 'Write to the payer and check how claims are sent.'
    ELSE 'Look at it again next week and in the monthly report.' END AS recommended_action, total_ar_balance AS dollar_impact, '' AS denial_reason, CAST(floor(avg_days_in_ar) AS INTEGER) AS days_until_expiry
    FROM {newest('ar_snapshot_events', 'payer_id')} WHERE avg_days_in_ar > 45""")
cte("auth_alerts", f"""SELECT {aid('AUTH_EXPIRING')}, payer_id, payer_name, auth_id AS claim_id, patient_id, CASE WHEN days_until_expiry <= 2 THEN 'CRITICAL' WHEN days_until_expiry <= 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    'Authorization ' || auth_id || ' (' || procedure_code || ') with ' || payer_name || ' ends in ' || days_until_expiry || ' days; planned for ' || substr(scheduled_procedure_date, 1, 10) || ', charge $' || {usd('estimated_charge')} || '.' AS alert_text,
    CASE WHEN days_until_expiry <= 2 THEN 'Ask for an extension today and warn those who plan the procedure.' WHEN days_until_expiry <= 5 THEN 'Request the extension and confirm it with the clinic.'
    ELSE 'Check this week whether the procedure is still planned.' END AS recommended_action, estimated_charge AS dollar_impact, '' AS denial_reason, days_until_expiry
    FROM {newest('auth_lifecycle_events', 'auth_id')} WHERE auth_status = 'EXPIRING_SOON' OR auth_status = 'APPROVED' AND days_until_expiry BETWEEN 1 AND 7""")
cte("payer_alerts", "SELECT * FROM spikes_week UNION ALL BY NAME SELECT * FROM high_dollar_week UNION ALL BY NAME SELECT * FROM ar_breach_alerts UNION ALL BY NAME SELECT * FROM auth_alerts")


def sev(value: str, warn: float, crit: float, floor: str = "OK") -> str:
    return f"CASE WHEN {value} >= {crit}::DOUBLE THEN 'CRITICAL' WHEN {value} >= {warn}::DOUBLE THEN 'HIGH' ELSE '{floor}' END"


def capacity(interval: str) -> str:
    return f"""SELECT md5(alert_type || '|' || event_id) AS alert_id, event_timestamp AS alert_timestamp, alert_type, facility_id, ward, severity,
    alert_type || ': ' || facility_name || ' ' || ward || ' - ' || capacity_type || ' = ' || {R('current_value', 1)} || ' (threshold ' || {R('threshold_value', 1)} || ', utilization ' || {R('utilization_pct', 1)} || '%).' AS alert_text,
    CASE capacity_type WHEN 'ED_BOARDING' THEN 'Open more capacity and call those who assign beds.' WHEN 'BED_OCCUPANCY' THEN 'See who can go home and put off planned admissions.'
    ELSE 'Find what slows the room down between two cases.' END AS recommended_action, capacity_type AS metric_name, current_value AS metric_value, threshold_value,
    COALESCE(latitude, 0) AS latitude, COALESCE(longitude, 0) AS longitude FROM (SELECT *, CASE capacity_type WHEN 'ED_BOARDING' THEN 'ED_BOARDING_BREACH' WHEN 'BED_OCCUPANCY' THEN 'BED_CAPACITY_CRITICAL' WHEN 'OR_TURNOVER' THEN 'OR_DELAY' ELSE 'LOS_BREACH' END AS alert_type,
    CASE capacity_type WHEN 'ED_BOARDING' THEN {sev('current_value', 10, 20)} WHEN 'BED_OCCUPANCY' THEN {sev('current_value', 85, 95)} WHEN 'OR_TURNOVER' THEN {sev('current_value', 45, 60)} ELSE 'OK' END AS severity
    FROM {newest('ops_capacity_events', 'facility_id, capacity_type', back('event_timestamp', interval))}) t WHERE severity <> 'OK'"""


def staffing(interval: str) -> str:
    return f"""SELECT {aid('STAFFING_GAP')}, facility_id, ward, severity, 'Short of nurses: ' || ward || ' — nurses=' || nurse_count || ', patients=' || patient_count || ', acuity=' || {R('acuity_score', 2)} || ', ratio=' || {R('ratio_actual', 2)} || ' vs target ' || {R('ratio_target', 2)} || ' (gap=' || staffing_gap || ').' AS alert_text,
    CASE WHEN severity = 'CRITICAL' THEN 'Call in extra nurses and take no transfers for now.' ELSE 'Share out the patients anew and tell the next shift.' END AS recommended_action,
    'staffing_gap' AS metric_name, CAST(staffing_gap AS DOUBLE) AS metric_value, 1.0::DOUBLE AS threshold_value, 0.0::DOUBLE AS latitude, 0.0::DOUBLE AS longitude
    FROM (SELECT *, {sev('staffing_gap', 1, 3)} AS severity FROM {newest('staffing_acuity_events', 'facility_id, ward', back('event_timestamp', interval))}) t WHERE severity <> 'OK'"""


cte("coo_alerts", f"{capacity('7 days')} UNION ALL BY NAME {staffing('7 days')}")


def dq(interval: str) -> str:
    return f"""SELECT {aid('DQ_THRESHOLD_BREACH')}, source_table AS source_system, sv AS severity, 'Data rule ' || rule_name || ' on ' || source_table || ' — ' || rule_type || ' broken by ' || {R('violation_pct', 2)} || '% (count=' || violation_count || ')' AS alert_text,
    CASE WHEN sv = 'CRITICAL' THEN 'Stop the jobs that read this table and tell its owner.' ELSE 'Look into the rule by tomorrow.' END AS recommended_action, 'violation_pct' AS metric_name, violation_pct AS metric_value, 1.0::DOUBLE AS threshold_value
    FROM (SELECT *, {sev('violation_pct', 1, 5)} AS sv FROM {newest('dq_violation_events', 'source_table, rule_name', back('event_timestamp', interval))}) t WHERE sv <> 'OK'"""


def phi(interval: str) -> str:
    return f"""SELECT {aid('PHI_ANOMALY')}, 'audit_access' AS source_system, sv AS severity, 'Unusual access: ' || user_principal || ' ' || action_type || ' on ' || resource_accessed || ' from ' || geo_country || ' — anomaly_score=' || {R('anomaly_score', 3)} AS alert_text,
    CASE sv WHEN 'CRITICAL' THEN 'Lock the account and inform security and privacy officers.' WHEN 'HIGH' THEN 'Ask for a second factor and watch the account for a day.' ELSE 'Keep for the next access review.' END AS recommended_action,
    'anomaly_score' AS metric_name, anomaly_score AS metric_value, 0.7::DOUBLE AS threshold_value FROM (SELECT *, {sev('anomaly_score', 0.7, 0.9, 'MEDIUM')} AS sv FROM audit_access_events WHERE {back('event_timestamp', interval)} AND anomaly_score > 0.4::DOUBLE) t"""


def model_drift(interval: str) -> str:
    return f"""SELECT {aid('MODEL_DRIFT')}, model_name AS source_system, sv AS severity, 'Drift of ' || model_name || ' ' || model_version || ' feature=' || feature_name || ' PSI=' || {R('psi_value', 4)} || ' KS=' || {R('ks_value', 4)} || ' baseline=' || baseline_period AS alert_text,
    CASE WHEN sv = 'CRITICAL' THEN 'Do not release the model and train it on newer data.' ELSE 'Look at the feature in the weekly model review.' END AS recommended_action, 'psi_value' AS metric_name, psi_value AS metric_value, 0.1::DOUBLE AS threshold_value
    FROM (SELECT *, {sev('psi_value', 0.1, 0.25)} AS sv FROM {newest('model_drift_events', 'model_name, feature_name', back('event_timestamp', interval))}) t WHERE sv <> 'OK'"""


cte("cto_alerts", f"{dq('7 days')} UNION ALL BY NAME {phi('7 days')} UNION ALL BY NAME {model_drift('7 days')}")

# --- unified alerts -------------------------------------------------------------------------------------------------------


def trunc_text(c: str) -> str:
    return f"CAST(trunc({c}) AS BIGINT)"


def unified(interval: str) -> str:
    w = lambda ts: back(ts, interval, True)
    return f"""SELECT score_id AS alert_id, score_timestamp AS alert_timestamp, 'fraud_scores' AS source_table, 'FRAUD' AS alert_type, patient_id, provider_id, facility_id, risk_tier AS severity, fraud_score AS score,
    'Fraud ' || {trunc_text('fraud_score')} || '/100 flags=' || fraud_flags AS alert_text FROM fraud_scores WHERE {w('score_timestamp')} AND fraud_score >= 50
    UNION ALL SELECT alert_id, alert_timestamp, 'care_gap_alerts', 'CARE_GAP', patient_id, '', facility_id, alert_priority, CAST(gap_days_overdue AS DOUBLE), alert_text FROM care_gap_alerts WHERE {w('alert_timestamp')} AND gap_days_overdue > 90
    UNION ALL SELECT alert_id, alert_timestamp, 'highcost_alerts', 'HIGH_COST', patient_id, '', '', risk_tier, rolling_spend_30d, 'Spend30d $' || {trunc_text('rolling_spend_30d')} || ' ED=' || ed_visits_30d FROM highcost_alerts WHERE {w('alert_timestamp')}
    UNION ALL SELECT event_id, event_timestamp, 'readmission_events', 'READMISSION', patient_id, provider_id, facility_id, CASE WHEN readmission_risk_score >= 80 THEN 'CRITICAL' WHEN readmission_risk_score >= 70 THEN 'HIGH' ELSE 'MEDIUM' END, readmission_risk_score,
    'Readmit ' || days_since_discharge || 'd DRG=' || drg_code || ' risk=' || {trunc_text('readmission_risk_score')} FROM readmission_events WHERE {w('event_timestamp')} AND (readmission_risk_score >= 70 OR days_since_discharge <= 7 AND readmission_risk_score >= 50)
    UNION ALL SELECT event_id, event_timestamp, 'clinical_deterioration_events', 'DETERIORATION', patient_id, '', facility_id, CASE WHEN news2_score >= 7 THEN 'CRITICAL' ELSE 'HIGH' END, news2_score,
    deterioration_type || ' NEWS2=' || news2_score || ' ward=' || ward FROM clinical_deterioration_events WHERE {w('event_timestamp')} AND news2_score >= 5"""


cte("all_alerts", unified("30 days"))
_shared = "alert_id, alert_timestamp, alert_type, severity, alert_text, recommended_action"
cte("persona_alerts", " UNION ALL ".join(f"SELECT {_shared}, '{p}' AS persona FROM {t}" for t, p in (("provider_alerts", "CMO"), ("payer_alerts", "CFO"), ("coo_alerts", "COO"), ("cto_alerts", "CTO"))))
cte("closure_times", """SELECT alert_id, MIN(closure_timestamp) FILTER (WHERE action_taken = 'ACKNOWLEDGED') AS ack_time, MIN(closure_timestamp) FILTER (WHERE action_taken = 'RESOLVED') AS close_time
    FROM alert_closure_events GROUP BY 1""")
RANK = "CASE {0} WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"
cte("worklist_alerts", f"""SELECT patient_id, 'FRAUD' AS alert_type, score_id AS alert_id, {RANK.format('risk_tier')} AS priority, risk_tier, 'Fraud score: ' || fraud_score || ' | Flags: ' || fraud_flags AS detail, score_timestamp AS alert_time
    FROM fraud_scores WHERE {back('score_timestamp', '7 days')} UNION ALL SELECT patient_id, 'CARE_GAP', alert_id, {RANK.format('alert_priority')}, alert_priority, 'Gap: ' || measure_name || ' | Overdue: ' || gap_days_overdue || 'd', alert_timestamp
    FROM care_gap_alerts WHERE {back('alert_timestamp', '7 days')} UNION ALL SELECT patient_id, 'HIGH_COST', alert_id, {RANK.format('risk_tier')}, risk_tier, '30d spend: $' || rolling_spend_30d || ' | ED visits: ' || ed_visits_30d || ' | Trend: ' || cost_trend, alert_timestamp
    FROM highcost_alerts WHERE {back('alert_timestamp', '7 days')}""")
cte("worklist", """SELECT patient_id, string_agg(DISTINCT alert_type, ',' ORDER BY alert_type) AS alert_types, MIN(priority) AS max_priority, COUNT(*) AS alert_count FROM worklist_alerts GROUP BY 1
    ORDER BY max_priority, alert_count DESC, patient_id LIMIT 100""")
