"""Expected SQL for scores, aggregates and data-quality checks."""

from __future__ import annotations

from oracle.base import AS_OF, CTES, M, R, S, cte, q
from oracle.tables import ACTION_AT, PDC_CAT, REASON_AT, RANK, bucket, dkey

q("e01_readmission_risk", "SELECT encounter_id, readmission_risk_score, readmission_flag, readmission_risk_category FROM fact_encounter")
q("e02_readmission_score", f"""SELECT encounter_id, {R('''GREATEST(LEAST(0.15 + CASE WHEN encounter_type IN ('Inpatient', 'Emergency') THEN 0.10 ELSE 0 END + CASE WHEN length_of_stay > 7 THEN 0.15 WHEN length_of_stay > 3 THEN 0.08 ELSE 0 END
    + CASE WHEN total_charges > 50000 THEN 0.10 WHEN total_charges > 20000 THEN 0.05 ELSE 0 END + CASE WHEN c.is_chronic = 1 THEN 0.12 ELSE 0 END + CASE WHEN primary_diagnosis_code IN ('I50.9', 'J44.9', 'N18.3') THEN 0.10 ELSE 0 END
    + CASE WHEN upper(discharge_disposition) IN ('SNF', 'REHAB', 'HOME HEALTH') THEN 0.08 WHEN upper(discharge_disposition) = 'AMA' THEN 0.20 ELSE 0 END, 0.99), 0.01)''', 4)} AS readmission_score
    FROM encounters_clean LEFT JOIN ref_icd_codes c ON c.code = primary_diagnosis_code""")
_b100, _b7 = bucket("claim_id", 100), bucket("claim_id", 7)
HASHED = f"(claim_status = 'Denied' OR billed_amount > 50000 AND {_b100} < 18 OR billed_amount > 20000 AND {_b100} < 12 OR {_b100} < 5)"
q("e03_hashed_denials", f"SELECT claim_id, claim_status, {HASHED} AS is_denied FROM claims_clean")
q("e04_denial_risk", "SELECT claim_id, denial_risk_score, denial_risk_category FROM fact_claim")
q("e05_denial_score", f"""SELECT claim_id, x AS denial_score, CASE WHEN x >= 0.4::DOUBLE THEN 'High' WHEN x >= 0.2::DOUBLE THEN 'Medium' ELSE 'Low' END AS denial_score_category FROM (SELECT claim_id,
    {R('''0.08 + CASE WHEN billed_amount > 50000 THEN 0.20 WHEN billed_amount > 20000 THEN 0.10 ELSE 0 END + CASE WHEN cpt_code IN ('70553', '72148', '73721', '27447', '29827', '33533', '47562') THEN 0.15 ELSE 0 END
    + CASE WHEN payer_type IN ('Government', 'Medicaid Managed Care') THEN 0.05 ELSE 0 END + CASE WHEN claim_type = 'Inpatient' THEN 0.05 ELSE 0 END''', 4)} AS x FROM claims_enriched) t""")
q("e06_denial_reason", f"SELECT claim_id, COALESCE(denial_reason, {REASON_AT}) AS primary_denial_reason, {ACTION_AT} AS recommended_action FROM claims_clean WHERE {HASHED}")
q("e07_payment_metrics", f"""SELECT claim_id, COALESCE(payment_date, claim_date) - claim_date AS days_to_payment,
    {R("CASE WHEN allowed_amount > 0 THEN CAST(COALESCE(paid_amount, 0) AS DOUBLE) / CAST(allowed_amount AS DOUBLE) ELSE 0 END", 6)} AS net_collection_rate FROM claims_clean""")
q("e08_vulnerability", "SELECT zip_code, composite_svi_score, risk_tier FROM sdoh_scored")
q("e08_vulnerability_index", f"""SELECT zip_code, x AS composite_svi_score, CASE WHEN x >= 0.3::DOUBLE THEN 'High' WHEN x >= 0.15::DOUBLE THEN 'Medium' ELSE 'Low' END AS risk_tier FROM (SELECT zip_code,
    {R('poverty_rate * 0.25 + CAST(food_desert_flag AS INTEGER) * 0.15 + housing_instability_rate * 0.15 + uninsured_rate * 0.15 + (1 - transportation_score) * 0.20 + (1 - broadband_access_pct) * 0.10', 4)} AS x FROM sdoh_index_source) t""")
AGE365 = f"CAST(FLOOR(({AS_OF} - date_of_birth) / 365) AS INTEGER)"
q("e09_care_gap_eligible", f"""SELECT patient_id, measure_id, measure_name FROM (SELECT *, {AGE365} AS age FROM patients_clean) p, hedis_measures m WHERE age BETWEEN age_min AND age_max
    AND (measure_id <> 'BCS' OR gender = 'Female') AND (target_icd = '' OR EXISTS (SELECT 1 FROM diagnoses_clean x WHERE x.patient_id = p.patient_id AND list_contains(string_split(target_icd, '|'), x.icd_code)))""")
cte("latest_plan", "SELECT member_id, payer_id, plan_id, year_month FROM member_enrollment_clean QUALIFY ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY year_month DESC, enrollment_id DESC) = 1")
q("e10_hedis_rollup", f"""SELECT payer_id, plan_id, measure_id, measure_name, COUNT(*) AS denominator_eligible, COUNT(*) FILTER (WHERE is_gap_open = 'False') AS numerator_met, 2001 AS measurement_year,
    {R("CAST(COUNT(*) FILTER (WHERE is_gap_open = 'False') AS DOUBLE) / COUNT(*)", 4)} AS compliance_rate FROM care_gaps LEFT JOIN latest_plan ON patient_id = member_id GROUP BY 1, 2, 3, 4""")
q("e11_raf_score", f"""SELECT member_id, payer_id, plan_id, COALESCE(n, 0) AS hcc_count, codes AS hcc_codes, {R('demo', 4)} AS demographic_score, {R('COALESCE(w, 0)', 4)} AS disease_score, {R('demo + COALESCE(w, 0)', 4)} AS raf_score
    FROM (SELECT patient_id AS member_id, COALESCE(CASE WHEN {AGE365} < 65 THEN 0.30 ELSE 0.45 + ({AGE365} - 65) * 0.012 END, 0.30) + CASE WHEN gender = 'Female' THEN 0.05 ELSE 0 END AS demo FROM patients_clean) p
    JOIN latest_plan USING (member_id) LEFT JOIN (SELECT patient_id AS member_id, COUNT(*) AS n, SUM(raf_weight) AS w, string_agg(hcc_code, ',' ORDER BY hcc_code) AS codes FROM
    (SELECT DISTINCT patient_id, hcc_code, raf_weight FROM diagnoses_clean JOIN ref_hcc_codes ON icd_match = icd_code) h GROUP BY 1) g USING (member_id)""")
q("e12_drg_reimbursement", f"SELECT encounter_id, drg_code, {R('r.weight * r.base_rate', 2)} AS drg_payment FROM encounters_clean LEFT JOIN ref_drg_codes r ON drg = drg_code")
q("e13_member_months", """SELECT member, CAST(m AS DATE) AS coverage_start, last_day(CAST(m AS DATE)) AS coverage_end, strftime(m, '%Y-%m') AS year_month FROM (SELECT o_custkey AS member,
    unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY 1) t""")
q("e14_latest_enrollment", "SELECT * FROM latest_plan")
q("e15_revenue_variance", f"""SELECT event_id, expected_payment, actual_payment, {R('actual_payment - expected_payment', 2)} AS variance_dollars,
    CASE WHEN expected_payment <> 0 THEN {R('(actual_payment - expected_payment) / expected_payment * 100', 2)} ELSE 0 END AS variance_pct FROM net_revenue_variance_events""")
q("e15_underpayments", "SELECT event_id, contract_type, variance_pct, variance_dollars FROM net_revenue_variance_events WHERE variance_pct < -5")
q("e16_staffing_gap", f"""SELECT event_id, nurse_count, patient_count, acuity_score, {R('CAST(patient_count AS DOUBLE) / nurse_count', 2)} AS ratio_actual, t AS ratio_target,
    GREATEST(0, CAST(trunc(patient_count / t - nurse_count) AS INTEGER)) AS staffing_gap FROM (SELECT *, CASE WHEN acuity_score < 3 THEN 4.0 ELSE 3.0 END::DOUBLE AS t FROM staffing_acuity_events) s""")
q("e17_rapid_response", "SELECT event_id, news2_score, sirs_score, deterioration_type, news2_score >= 7 OR deterioration_type = 'SEPSIS' AND sirs_score >= 2 AS requires_rrt FROM clinical_deterioration_events")
q("e17_hai_severity", "SELECT event_id, cluster_size, CASE WHEN cluster_size >= 5 THEN 'CRITICAL' WHEN cluster_size >= 3 THEN 'HIGH' WHEN cluster_size >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM mortality_hai_events")
q("e17_utilization", f"SELECT event_id, current_value, threshold_value, CASE WHEN threshold_value <> 0 THEN {R('current_value / threshold_value * 100', 1)} ELSE 0 END AS utilization_pct FROM ops_capacity_events")
q("e18_hrrp_penalty", f"""SELECT *, {R('LEAST(0.03, GREATEST(0, excess_ratio - 1))', 6)} AS penalty FROM (SELECT facility_key, hrrp_condition, expected_rate, COUNT(*) AS discharges, CAST(SUM(readmission_flag) AS BIGINT) AS readmissions,
    {R('CAST(SUM(readmission_flag) AS DOUBLE) / COUNT(*) / expected_rate', 6)} AS excess_ratio FROM fact_encounter JOIN hrrp_expected ON icd_code = primary_diagnosis_code GROUP BY 1, 2, 3) t""")
cte("star_ranked", """SELECT *, CASE WHEN percentile >= 0.9 THEN 5 WHEN percentile >= 0.65 THEN 4 WHEN percentile >= 0.35 THEN 3 WHEN percentile >= 0.1 THEN 2 ELSE 1 END AS stars FROM (
    SELECT *, percent_rank() OVER (PARTITION BY star_measure_id, measurement_year ORDER BY star_score) AS percentile FROM agg_star_rating) t""")
q("e19_star_cutpoints", f"SELECT star_id, star_score, {R('percentile', 6)} AS percentile, stars FROM star_ranked")
q("e19_star_rollup", f"""SELECT payer_key, measurement_year, domain, {R('CAST(s AS DOUBLE) / w', 6)} AS domain_stars, {R('CAST(SUM(s) OVER (PARTITION BY payer_key, measurement_year) AS DOUBLE) / SUM(w) OVER (PARTITION BY payer_key, measurement_year)', 6)} AS overall_stars
    FROM (SELECT payer_key, measurement_year, domain, SUM(stars * weight) AS s, SUM(weight) AS w FROM star_ranked GROUP BY 1, 2, 3) t""")
q("e20_dq_violation", f"""SELECT *, CASE WHEN violation_pct > 10 THEN 'CRITICAL' WHEN violation_pct > 5 THEN 'HIGH' WHEN violation_pct > 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM (SELECT event_id, expected_value, actual_value,
    CAST(trunc(abs(expected_value - actual_value)) AS INTEGER) AS violation_count, {R('abs(expected_value - actual_value) / expected_value * 100', 2)} AS violation_pct FROM dq_violation_events) t""")
cte("drift_bins", """SELECT b, COUNT(*) FILTER (WHERE base) AS nb, COUNT(*) FILTER (WHERE NOT base) AS nc FROM (SELECT claim_date_key < 19980101 AS base, CASE WHEN billed_amount >= 75000 THEN 6 WHEN billed_amount >= 50000 THEN 5
    WHEN billed_amount >= 30000 THEN 4 WHEN billed_amount >= 20000 THEN 3 WHEN billed_amount >= 10000 THEN 2 WHEN billed_amount >= 5000 THEN 1 ELSE 0 END AS b FROM fact_claim) t GROUP BY 1""")
q("e21_psi", f"""SELECT {R('SUM((p - c) * ln(p / c))', 6)} AS psi, COUNT(*) AS bins_used FROM (SELECT GREATEST(nb / SUM(nb) OVER (), 0.000001) AS p, GREATEST(nc / SUM(nc) OVER (), 0.000001) AS c FROM drift_bins) t""")
q("e21_ks", f"""SELECT {R('MAX(abs(fb - fc))', 6)} AS ks, MAX(tb) AS base_rows, MAX(tc) AS current_rows FROM (SELECT COUNT(*) FILTER (WHERE base) OVER (ORDER BY billed_amount) / COUNT(*) FILTER (WHERE base) OVER () AS fb,
    COUNT(*) FILTER (WHERE NOT base) OVER (ORDER BY billed_amount) / COUNT(*) FILTER (WHERE NOT base) OVER () AS fc, COUNT(*) FILTER (WHERE base) OVER () AS tb, COUNT(*) FILTER (WHERE NOT base) OVER () AS tc
    FROM (SELECT claim_date_key < 19980101 AS base, billed_amount FROM fact_claim) t) u""")

for _n, _t in {"f01_readmission_by_date": "agg_readmission_by_date", "f02_denial_by_date": "agg_denial_by_date", "f03_denial_by_payer": "agg_denial_by_payer", "f04_revenue_by_drg": "agg_revenue_by_drg",
               "f05_days_in_ar": "agg_days_in_ar", "f06_appeal_outcomes": "agg_appeal_outcomes", "f07_mlr_by_payer_month": "agg_mlr_by_payer_month", "f08_hedis_compliance": "agg_hedis_compliance",
               "f09_star_rating": "agg_star_rating", "f09_star_rating_overall": "agg_star_rating_overall", "f10_raf_score": "agg_raf_score", "f11_medication_adherence": "agg_medication_adherence"}.items():
    q(_n, f"SELECT * FROM {_t}")
# Days covered, counted one by one.
q("f12_adherence_exact", f"""SELECT *, {PDC_CAT} AS adherence_category FROM (SELECT patient_key, medication_key, first_fill_date, covered_days, DATE '2001-12-31' - first_fill_date + 1 AS days_in_period,
    CAST(covered_days AS DOUBLE) / (DATE '2001-12-31' - first_fill_date + 1) AS pdc_score FROM (SELECT patient_key, medication_key, MIN(fill) AS first_fill_date, COUNT(DISTINCT day) FILTER (WHERE day <= DATE '2001-12-31') AS covered_days
    FROM (SELECT patient_key, medication_key, full_date AS fill, CAST(unnest(generate_series(CAST(full_date AS TIMESTAMP), CAST(full_date + days_supply - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
    FROM fact_prescription JOIN dim_date ON date_key = fill_date_key WHERE full_date <= DATE '2001-12-31') d GROUP BY 1, 2) g) t""")
q("f13_vitals_hourly", f"""SELECT *, CASE WHEN max_risk_score >= 70 THEN 'High' WHEN max_risk_score >= 40 THEN 'Medium' ELSE 'Low' END AS risk_flag FROM (SELECT patient_id, location_id, {dkey('reading_ts')} AS date_key, hour(reading_ts) AS hour_of_day,
    {M('heart_rate')} AS avg_heart_rate, MAX(heart_rate) AS max_heart_rate, MIN(heart_rate) AS min_heart_rate, {M('bp_systolic')} AS avg_bp_systolic, MAX(bp_systolic) AS max_bp_systolic, {M('bp_diastolic')} AS avg_bp_diastolic,
    {M('spo2')} AS avg_spo2, MIN(spo2) AS min_spo2, {M('temperature')} AS avg_temperature, MAX(temperature) AS max_temperature, {M('respiratory_rate')} AS avg_respiratory_rate, {M('risk_score')} AS avg_risk_score,
    MAX(risk_score) AS max_risk_score, COUNT(*) FILTER (WHERE spo2 < 90 OR heart_rate > 130 OR heart_rate < 40 OR bp_systolic > 180) AS critical_reading_count, COUNT(*) AS reading_count FROM vitals_readings GROUP BY 1, 2, 3, 4) t""")
q("f14_alert_facts", f"""SELECT alert_id, patient_id, {dkey('alert_timestamp')} AS date_key, hour(alert_timestamp) AS alert_hour, alert_type AS alert_code, severity, {RANK.format('severity')} AS severity_rank, score AS measured_value,
    CASE WHEN acked IS NOT NULL THEN 1 ELSE 0 END AS was_acknowledged, by_whom AS acknowledged_by, acked AS acknowledged_at, {R("date_diff('second', alert_timestamp, acked) / 60.0::DOUBLE", 4)} AS response_time_minutes
    FROM all_alerts LEFT JOIN (SELECT alert_id, closure_timestamp AS acked, resolved_by AS by_whom FROM alert_closure_events QUALIFY ROW_NUMBER() OVER (PARTITION BY alert_id ORDER BY closure_timestamp, closure_id) = 1) c USING (alert_id)""")
q("f15_ar_aging", f"""SELECT CASE WHEN days_to_payment IS NULL THEN 'unknown' WHEN days_to_payment <= 30 THEN '0-30' WHEN days_to_payment <= 60 THEN '31-60' WHEN days_to_payment <= 90 THEN '61-90' ELSE '90+' END AS age_bucket, payer_name,
    COUNT(*) AS claim_count, {S('billed_amount')} AS total_billed FROM fact_claim LEFT JOIN dim_payer USING (payer_key) GROUP BY 1, 2""")
q("f16_expiring_contracts", f"SELECT * FROM bridge_provider_contract WHERE termination_date >= {AS_OF} AND termination_date <= {AS_OF} + 90")
q("f17_authorization_outliers", """SELECT *, CAST(denied AS DOUBLE) / decided AS denial_rate FROM (SELECT provider_key, COUNT(*) AS decided, COUNT(*) FILTER (WHERE auth_outcome = 'Denied') AS denied
    FROM fact_authorization WHERE COALESCE(auth_outcome, '') <> '' GROUP BY 1) t WHERE decided >= 5""")
q("f18_payer_mix", f"""SELECT payer_type, claim_count, total_billed, total_paid, {R('claim_count / SUM(claim_count) OVER ()', 6)} AS claim_share, {R('total_billed / SUM(total_billed) OVER ()', 6)} AS billed_share FROM (
    SELECT payer_type, COUNT(*) AS claim_count, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid FROM fact_claim LEFT JOIN dim_payer USING (payer_key) WHERE claim_date_key >= 20000801 GROUP BY 1) t""")

q("r01_not_null", " UNION ALL ".join(f"SELECT '{c}_not_null' AS check_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM claims_clean" for c in ("claim_id", "payment_date", "allowed_amount", "denial_reason")))
q("r02_date_order", "SELECT 'payment_date_before_claim_date' AS check_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE payment_date < claim_date) AS violations FROM claims_clean")
q("r03_non_negative", "SELECT 'premium_amount_negative' AS check_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE premium_amount < 0) AS violations FROM premiums_clean")
_gold = [n for n in CTES if n.startswith(("dim_", "fact_", "agg_", "bridge_"))]
q("r04_table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS current_count FROM {n}" for n in _gold))
FKS = {"fact_encounter": "patient_key provider_key facility_key", "fact_claim": "patient_key provider_key payer_key encounter_key facility_key",
       "fact_prescription": "patient_key provider_key payer_key medication_key encounter_key", "fact_diagnosis": "patient_key encounter_key diagnosis_key facility_key"}
q("r05_key_coverage", " UNION ALL ".join(f"SELECT '{t}' AS fact_name, '{k}' AS fk, COUNT(*) AS row_count, COUNT({k}) AS matched, {R(f'COUNT({k}) * 100.0::DOUBLE / COUNT(*)', 6)} AS match_pct FROM {t}" for t, ks in FKS.items() for k in ks.split()))
q("r06_sanity_metrics", f"""SELECT 'claims_total' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM fact_claim UNION ALL SELECT 'claims_denied', SUM(denial_flag) FROM fact_claim UNION ALL SELECT 'claims_denied_dollars', {S('CASE WHEN denial_flag = 1 THEN billed_amount END')} FROM fact_claim
    UNION ALL SELECT 'chronic_pairs', COUNT(*) FILTER (WHERE is_chronic = 1) FROM agg_medication_adherence UNION ALL SELECT 'chronic_non_adherent', COUNT(*) FILTER (WHERE is_chronic = 1 AND adherence_category = 'Non-Adherent') FROM agg_medication_adherence
    UNION ALL SELECT 'chronic_avg_pdc', {R('AVG(pdc_score) FILTER (WHERE is_chronic = 1)', 6)} FROM agg_medication_adherence UNION ALL SELECT 'diagnoses_total', COUNT(*) FROM fact_diagnosis
    UNION ALL SELECT 'diagnoses_principal', COUNT(*) FILTER (WHERE diagnosis_type = 'Principal') FROM fact_diagnosis UNION ALL SELECT 'diagnoses_secondary', COUNT(*) FILTER (WHERE diagnosis_type = 'Secondary') FROM fact_diagnosis
    UNION ALL SELECT 'zip_total', COUNT(*) FROM dim_sdoh UNION ALL SELECT 'zip_states', COUNT(DISTINCT state) FROM dim_sdoh UNION ALL SELECT 'zip_high_risk', COUNT(*) FILTER (WHERE risk_tier = 'High') FROM dim_sdoh
    UNION ALL SELECT 'zip_avg_svi', {M('social_vulnerability_index')} FROM dim_sdoh""")


def _profile(table: str, col: str, cat: str, layer: str) -> str:
    x = f"TRY_CAST({col} AS DOUBLE)"
    stats = f"COUNT(*) AS row_count, COUNT({x}) AS non_null, MIN({x}) AS min_score, {M(x)} AS avg_score, MAX({x}) AS max_score"
    return f"SELECT '{layer}' AS layer, '(all)' AS category, {stats} FROM {table} UNION ALL SELECT '{layer}', {cat}, {stats} FROM {table} GROUP BY {cat}"


q("r07_score_profile", _profile("encounters_raw", "readmission_risk", "encounter_type", "raw") + " UNION ALL " + _profile("fact_encounter", "readmission_risk_score", "readmission_risk_category", "gold"))
q("r08_routed_quality", "SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE claim_type <> '') AS populated, COUNT(*) FILTER (WHERE claim_type = '') AS blank FROM claims_events")
