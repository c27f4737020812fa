"""Expected SQL for the business questions."""

from __future__ import annotations

import oracle.events_queries  # noqa: F401  (named subqueries used below)
import oracle.metrics_queries  # noqa: F401
from oracle.base import NOW, QUERIES, A, M, R, S, back, cte, div, q
from oracle.metrics_queries import blankd, n, share
from oracle.tiles_queries import newest

D = "denial_flag = 1"
READ = share("readmission_flag = 1")
DEN = share(D)
HIGH_N = n("readmission_risk_category = 'High'")
COLLECT = div("SUM(paid_amount)", "SUM(billed_amount)")
RISK = S("CASE WHEN denial_risk_category IN ('High', 'Medium') THEN billed_amount ELSE 0 END")
RISK_HIGH = S("CASE WHEN denial_risk_category = 'High' THEN billed_amount END")
YEAR_SPAN = "BETWEEN 20000801 AND 20010731"
ADHERENT = share("adherence_category = 'Adherent'")


def metric_rows(pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST(({v}) AS DOUBLE) AS value" for k, v in pairs.items())


cte("high_risk", f"SELECT patient_key, MAX(readmission_risk_score) AS max_risk, COUNT(*) AS high_risk_encounters FROM fact_encounter WHERE readmission_risk_category = 'High' GROUP BY 1")
cte("non_adherent", f"SELECT patient_key, COUNT(*) AS non_adherent_drugs, {M('pdc_score')} AS avg_pdc FROM agg_medication_adherence WHERE adherence_category = 'Non-Adherent' GROUP BY 1")
cte("chronic_enc", "SELECT DISTINCT encounter_key, diagnosis_key, icd_description FROM dx_star WHERE is_chronic = 1")
CAND = "SELECT patient_id, max_risk, high_risk_encounters, non_adherent_drugs, avg_pdc FROM high_risk JOIN non_adherent USING (patient_key) JOIN dim_patient USING (patient_key)"

q("q001_cmo_today", metric_rows({"readmission_rate": f"SELECT {READ} FROM fact_encounter", "high_risk_readmissions": f"SELECT {HIGH_N} FROM fact_encounter", "adherent_rate": f"SELECT {ADHERENT} FROM agg_medication_adherence",
                                 "avg_pdc_score": f"SELECT {M('pdc_score')} FROM agg_medication_adherence", "high_risk_sdoh_patients": f"SELECT {n('sdoh_tier = ' + chr(39) + 'High' + chr(39))} FROM pat_star",
                                 "chronic_patients": "SELECT COUNT(DISTINCT patient_key) FROM dx_star WHERE is_chronic = 1"}))
q("q002_readmission_vs_benchmark", f"""SELECT {READ} AS readmission_rate, 0.15::DOUBLE AS benchmark, (SELECT COUNT(*) FROM (SELECT patient_key FROM fact_encounter GROUP BY 1 HAVING bool_or(readmission_risk_category = 'High') AND MAX(readmission_flag) = 0) t) AS high_risk_not_readmitted
    FROM fact_encounter WHERE encounter_date_key BETWEEN 20010701 AND 20010731""")
q("q003_readmission_drivers", "SELECT icd_description, COUNT(*) AS readmissions FROM chronic_enc JOIN fact_encounter USING (encounter_key) WHERE readmission_flag = 1 GROUP BY 1")
q("q004_intervention_candidates", CAND)
cte("sdoh_rates", f"""SELECT sdoh_tier AS risk_tier, total_patients, high_risk_sdoh_patients, total_encounters, readmission_rate, total_charges, avg_readmission_risk FROM (SELECT sdoh_tier, COUNT(*) AS total_patients, COUNT(*) FILTER (WHERE sdoh_tier = 'High') AS high_risk_sdoh_patients FROM pat_star GROUP BY 1) a
    FULL JOIN (SELECT sdoh_tier AS tier2, COUNT(*) AS total_encounters, {READ} AS readmission_rate, {S('total_charges')} AS total_charges, {M('readmission_risk_score')} AS avg_readmission_risk FROM enc_star GROUP BY 1) b ON sdoh_tier IS NOT DISTINCT FROM tier2""")
q("q005_sdoh_equity", "SELECT risk_tier, total_patients, total_encounters, readmission_rate FROM sdoh_rates")
q("q006_peer_review", f"""SELECT provider_id, display_name, specialty, documentation_score, claims, denial_rate FROM dim_provider LEFT JOIN (SELECT provider_key, COUNT(*) AS claims, {DEN} AS denial_rate FROM fact_claim GROUP BY 1) c USING (provider_key)
    WHERE denial_rate > 0.2::DOUBLE OR documentation_score < 70""")
q("q007_readmission_rate", f"SELECT {READ} AS readmission_rate FROM fact_encounter")
q("q008_readmission_by_type", f"SELECT encounter_type, COUNT(*) AS total_encounters, {READ} AS readmission_rate, {HIGH_N} AS high_risk_readmissions FROM fact_encounter GROUP BY 1")
q("q009_readmission_trend", f"SELECT year, month_number, month_name, COUNT(*) AS total_encounters, {READ} AS readmission_rate FROM enc_star WHERE encounter_date_key {YEAR_SPAN} GROUP BY 1, 2, 3")
q("q010_adherence_by_class", f"SELECT drug_class, {M('pdc_score')} AS avg_pdc_score, {ADHERENT} AS adherent_rate FROM adh_star GROUP BY 1")
q("q011_rvu_leaders", """SELECT provider_id, display_name, specialty, annual_rvu_target AS avg_rvu_target, actual_rvu AS avg_actual_rvu, CAST(actual_rvu AS DOUBLE) / annual_rvu_target AS rvu_attainment_pct FROM dim_provider
    ORDER BY rvu_attainment_pct DESC, provider_id LIMIT 20""")
q("q012_specialty_scorecard", f"""SELECT specialty, COUNT(*) AS total_providers, {share('board_certified')} AS board_certified_rate, {M('patient_satisfaction_score')} AS avg_satisfaction_score, {M('documentation_score')} AS avg_documentation_score,
    {share("contract_type = 'Value-Based'")} AS value_based_provider_rate FROM dim_provider GROUP BY 1""")
_MARGIN = R(div(f"{S('expected_reimbursement')} - {S('total_cost')}", S("expected_reimbursement")), 6)
q("q013_worst_drg_margins", f"SELECT drg_code, drg_description, COUNT(*) AS total_encounters, {S('total_charges')} AS total_charges, {S('total_cost')} AS total_cost, {_MARGIN} AS drg_margin FROM fact_encounter GROUP BY 1, 2 ORDER BY drg_margin NULLS LAST, drg_code LIMIT 15")
q("q014_telehealth_by_year", f"""SELECT c.*, {R('(c.total_charges - p.total_charges) / p.total_charges', 6)} AS yoy_growth FROM (SELECT year, COUNT(*) AS total_encounters, {n("encounter_type = 'Telehealth'")} AS telehealth_encounters, {share("encounter_type = 'Telehealth'")} AS telehealth_rate,
    {S('total_charges')} AS total_charges FROM enc_star GROUP BY 1) c LEFT JOIN yearly_charges p ON p.year = c.year - 1""")
q("q015_sdoh_readmissions", "SELECT risk_tier, total_patients, high_risk_sdoh_patients, readmission_rate, total_charges FROM sdoh_rates")
q("q016_chronic_burden", f"""SELECT p AS total_patients, c AS chronic_patients, CAST(c AS DOUBLE) / p AS chronic_rate, c AS patients_with_chronic_conditions, a AS avg_pdc_score FROM (SELECT (SELECT COUNT(*) FROM dim_patient) AS p,
    (SELECT COUNT(DISTINCT patient_key) FROM dx_star WHERE is_chronic = 1) AS c, (SELECT {M('pdc_score')} FROM agg_medication_adherence) AS a) t""")
q("q017_panel_capacity", f"""SELECT COALESCE(a.specialty, b.specialty) AS specialty, provs AS total_providers, size AS avg_panel_size, CAST(pats AS DOUBLE) / provs AS actual_panel_count, CAST(pats AS DOUBLE) / provs / size AS panel_utilization_pct
    FROM (SELECT specialty, {blankd('patient_key')} AS pats FROM enc_star GROUP BY 1) a FULL JOIN (SELECT specialty, COUNT(*) AS provs, {M('patient_panel_size')} AS size FROM dim_provider GROUP BY 1) b ON a.specialty IS NOT DISTINCT FROM b.specialty""")
q("q018_common_chronic_diagnoses", f"""SELECT CASE WHEN diagnosis_key IS NULL THEN NULL ELSE icd_code END AS icd_code, icd_description, icd_category, {blankd('diagnosis_key')} AS unique_diagnoses, COUNT(DISTINCT patient_key) FILTER (WHERE is_chronic = 1) AS patients_with_chronic_conditions
    FROM dx_star GROUP BY 1, 2, 3 ORDER BY patients_with_chronic_conditions DESC, icd_code LIMIT 15""")

q("q019_cfo_today", metric_rows({"denial_rate": f"SELECT {DEN} FROM fact_claim", "collection_rate": f"SELECT {COLLECT} FROM fact_claim", "avg_days_to_payment": f"SELECT {M('days_to_payment')} FROM fact_claim", "at_risk_revenue": f"SELECT {RISK} FROM fact_claim",
                                 "appeal_success_rate": f"""SELECT {div(n("appeal_outcome IN ('Overturned', 'Partial')"), 'COUNT(appeal_outcome)')} FROM fact_claim""",
                                 "mlr_pct": f"SELECT {div('SUM(CAST(medical_paid AS DECIMAL(18,2)))', 'SUM(CAST(premium_collected AS DECIMAL(18,2)))')} FROM agg_mlr_by_payer_month"}))
q("q020_cfo_vs_benchmarks", f"""SELECT *, denial_rate > 0.08::DOUBLE AS denial_over, collection_rate < 0.95::DOUBLE AS collection_under, avg_days_to_payment > 45 AS ar_over FROM (SELECT {DEN} AS denial_rate, {COLLECT} AS collection_rate, {M('days_to_payment')} AS avg_days_to_payment FROM fact_claim) t""")
q("q021_top_denying_payers", f"""SELECT payer_name, denied, denial_rate, main_reason FROM (SELECT payer_name, {n(D)} AS denied, {DEN} AS denial_rate FROM claim_star WHERE payer_name IS NOT NULL GROUP BY 1) a LEFT JOIN (SELECT payer_name, primary_denial_reason AS main_reason FROM claim_star
    WHERE primary_denial_reason IS NOT NULL GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY payer_name ORDER BY COUNT(*) DESC, primary_denial_reason) = 1) b USING (payer_name) ORDER BY denial_rate DESC, payer_name LIMIT 3""")
q("q022_quarter_denials", f"""SELECT COALESCE({S('CASE WHEN denial_flag = 1 THEN billed_amount END')}, 0) AS denied_dollars, COALESCE({S("CASE WHEN claim_status = 'Pending' AND denial_risk_category IN ('High', 'Medium') THEN billed_amount END")}, 0) AS pending_at_risk
    FROM fact_claim WHERE claim_date_key BETWEEN 20010701 AND 20010930""")
q("q023_appeal_return_by_reason", f"SELECT primary_denial_reason AS denial_reason, COUNT(*) AS appeals, {S('appeal_amount_recovered')} AS recovered, {div('SUM(appeal_amount_recovered)', 'SUM(billed_amount)')} AS recovered_share FROM fact_claim WHERE appeal_outcome IS NOT NULL GROUP BY 1")
q("q024_payer_mix_shift", f"""SELECT year_month, payer_type, claim_count, total_billed, total_paid, {R('claim_count / SUM(claim_count) OVER (PARTITION BY year_month)', 6)} AS claim_share, {R('total_billed / SUM(total_billed) OVER (PARTITION BY year_month)', 6)} AS billed_share FROM (
    SELECT substr(CAST(claim_date_key AS VARCHAR), 1, 4) || '-' || substr(CAST(claim_date_key AS VARCHAR), 5, 2) AS year_month, payer_type, COUNT(*) AS claim_count, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid FROM claim_star WHERE claim_date_key {YEAR_SPAN} GROUP BY 1, 2) t""")
q("q025_overall_denials", f"SELECT COUNT(*) AS total_claims, {S('billed_amount')} AS total_billed, {DEN} AS denial_rate, {RISK_HIGH} AS at_risk_revenue_high FROM fact_claim")
q("q026_denials_by_payer", f"SELECT payer_name, payer_type, COUNT(*) AS total_claims, {DEN} AS denial_rate, {M('denial_risk_score')} AS avg_denial_risk FROM claim_star GROUP BY 1, 2")
q("q027_collection_by_payer", f"SELECT payer_name, payer_type, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {COLLECT} AS collection_rate, {M('net_collection_rate')} AS net_collection_rate FROM claim_star GROUP BY 1, 2")
q("q028_revenue_at_risk", f"""SELECT payer_name, {RISK} AS at_risk_revenue, {n("denial_risk_category = 'High'")} AS high_risk_denials FROM claim_star GROUP BY 1""")
q("q029_billed_vs_paid", f"SELECT year, month_number, month_name, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {COLLECT} AS collection_rate, COUNT(*) AS total_claims FROM claim_star WHERE claim_date_key {YEAR_SPAN} GROUP BY 1, 2, 3")
q("q030_slow_payers", f"SELECT payer_name, payer_type, COUNT(*) AS total_claims, {M('days_to_payment')} AS avg_days_to_payment, {COLLECT} AS collection_rate FROM claim_star GROUP BY 1, 2")
q("q031_ar_aging", f"""SELECT CASE WHEN days_to_payment IS NULL THEN 'unknown' WHEN days_to_payment <= 30 THEN '0-30' WHEN days_to_payment <= 60 THEN '31-60' WHEN days_to_payment <= 90 THEN '61-90' ELSE '90+' END AS age_bucket, payer_name, COUNT(*) AS claim_count, {S('billed_amount')} AS total_billed FROM claim_star GROUP BY 1, 2""")
q("q032_appeal_return_by_payer", f"""SELECT payer_name, COUNT(*) AS appeals, {n("appeal_outcome IN ('Overturned', 'Partial')")} AS won, {S('appeal_amount_recovered')} AS recovered FROM claim_star WHERE appeal_outcome IS NOT NULL GROUP BY 1""")
q("q033_payer_mix", f"""SELECT payer_type, total_payers, total_claims, total_billed, total_paid, collection_rate FROM (SELECT payer_type, COUNT(*) AS total_claims, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {COLLECT} AS collection_rate FROM claim_star GROUP BY 1) c
    LEFT JOIN (SELECT payer_type, COUNT(*) AS total_payers FROM dim_payer GROUP BY 1) p USING (payer_type)""")
q("q034_drg_costs", f"SELECT drg_code, drg_description, COUNT(*) AS total_encounters, {S('total_charges')} AS total_charges, {S('total_cost')} AS total_cost, {S('expected_reimbursement')} AS total_expected_reimbursement FROM fact_encounter GROUP BY 1, 2 ORDER BY total_cost DESC, drg_code LIMIT 15")
q("q035_ytd_vs_prior_year", f"""SELECT c.year, c.ytd_charges, c.total_encounters, p.ytd_charges AS py_ytd_charges, {R('(c.ytd_charges - p.ytd_charges) / p.ytd_charges', 6)} AS yoy_growth FROM (SELECT year, {S('total_charges')} AS ytd_charges, COUNT(*) AS total_encounters FROM enc_star WHERE month_number <= 7 GROUP BY 1) c
    LEFT JOIN (SELECT year, {S('total_charges')} AS ytd_charges FROM enc_star WHERE month_number <= 7 GROUP BY 1) p ON p.year = c.year - 1 WHERE c.year = 2001""")
q("q036_reasons_at_risk", f"SELECT primary_denial_reason, COUNT(*) AS total_claims, {RISK_HIGH} AS at_risk_revenue_high, {M('denial_risk_score')} AS avg_denial_risk FROM fact_claim WHERE claim_date_key BETWEEN 20010401 AND 20010630 GROUP BY 1 ORDER BY at_risk_revenue_high DESC NULLS LAST, primary_denial_reason LIMIT 10")
q("q037_denials_overall_and_by_payer", f"SELECT '(all)' AS payer_name, COUNT(*) AS total_claims, {DEN} AS denial_rate FROM fact_claim UNION ALL SELECT payer_name, COUNT(*), {DEN} FROM claim_star GROUP BY 1")
q("q038_top_denial_reasons", f"SELECT primary_denial_reason, COUNT(*) AS claims, {S('billed_amount')} AS billed FROM fact_claim WHERE {D} GROUP BY 1 ORDER BY claims DESC, primary_denial_reason LIMIT 5")
q("q039_provider_denial_rates", f"SELECT provider_id, display_name, specialty, COUNT(*) AS claims, {DEN} AS denial_rate FROM claim_star WHERE provider_id IS NOT NULL GROUP BY 1, 2, 3 ORDER BY denial_rate DESC, provider_id LIMIT 10")
q("q040_large_denied_claims", f"SELECT claim_id, patient_id, payer_name, primary_denial_reason, CAST(billed_amount AS DOUBLE) AS billed_amount FROM claim_star WHERE {D} AND billed_amount > 50000")
q("q041_risk_not_denied", f"SELECT COUNT(*) AS claims, {S('billed_amount')} AS revenue_at_risk FROM claims_clean WHERE denial_risk_category = 'High' AND denial_flag = 0")
q("q042_risk_pending", "SELECT claim_id, patient_id, payer_id, denial_risk_score, CAST(billed_amount AS DOUBLE) AS billed_amount FROM claims_clean WHERE denial_risk_category = 'High' AND claim_status = 'Pending'")
q("q043_risk_categories", "SELECT denial_risk_category, COUNT(*) AS claims FROM fact_claim GROUP BY 1")
q("q044_readmission_by_month", f"SELECT year, month_number, {READ} AS readmission_rate, COUNT(*) AS total_encounters FROM enc_star GROUP BY 1, 2")
q("q045_riskiest_patients", "SELECT patient_id, MAX(readmission_risk_score) AS max_risk, age, insurance_type FROM enc_star WHERE patient_id IS NOT NULL GROUP BY patient_id, age, insurance_type ORDER BY max_risk DESC, patient_id LIMIT 10")
q("q046_rate_by_type", f"SELECT encounter_type, {READ} AS readmission_rate FROM fact_encounter GROUP BY 1")
q("q047_rate_by_facility", f"SELECT facility_name, COUNT(*) AS total_encounters, {READ} AS readmission_rate FROM enc_star GROUP BY 1")
q("q048_stay_by_risk", f"SELECT readmission_risk_category, {M('length_of_stay')} AS avg_los FROM fact_encounter WHERE readmission_risk_category IN ('High', 'Low') GROUP BY 1")
q("q049_encounters_by_risk", "SELECT readmission_risk_category, COUNT(*) AS encounters FROM fact_encounter GROUP BY 1")
q("q050_non_adherent_members", f"SELECT patient_id, drug_class, gap_days, {R('pdc_score', 6)} AS pdc_score FROM adh_star WHERE adherence_category = 'Non-Adherent'")
q("q051_adherence_rates", f"SELECT drug_class, therapeutic_area, {ADHERENT} AS adherent_rate, {M('pdc_score')} AS avg_pdc FROM agg_medication_adherence GROUP BY 1, 2")
q("q052_chronic_non_adherent", "SELECT patient_id, non_adherent_drugs, avg_pdc FROM non_adherent JOIN dim_patient USING (patient_key) WHERE patient_key IN (SELECT patient_key FROM dx_star WHERE is_chronic = 1)")
q("q053_patients_by_adherence", "SELECT adherence_category, COUNT(DISTINCT patient_key) AS patients, COUNT(*) AS pairs FROM agg_medication_adherence GROUP BY 1")
q("q054_rx_cost_by_class", f"SELECT drug_class, therapeutic_area, COUNT(*) AS fills, {S('total_cost')} AS total_cost, {S('patient_copay')} AS copay FROM rx_star GROUP BY 1, 2")
q("q055_vulnerable_members", "SELECT patient_id, zip_code, social_vulnerability_index, poverty_rate, food_desert_flag FROM pat_star WHERE sdoh_tier = 'High'")
q("q056_sdoh_risk", "SELECT risk_tier, avg_readmission_risk, readmission_rate FROM sdoh_rates")
q("q057_readmission_by_payer", QUERIES["n10_readmission_by_payer"])
q("q058_readmitted_social_risk", f"""SELECT patient_id, readmissions, sdoh_tier, social_vulnerability_index, avg_pdc FROM (SELECT patient_key, patient_id, sdoh_tier, social_vulnerability_index, COUNT(*) AS readmissions FROM enc_star WHERE readmission_flag = 1 GROUP BY 1, 2, 3, 4) e
    LEFT JOIN (SELECT patient_key, {M('pdc_score')} AS avg_pdc FROM agg_medication_adherence GROUP BY 1) a USING (patient_key)""")
q("q059_stay_by_type", f"SELECT encounter_type, {M('length_of_stay')} AS avg_length_of_stay FROM fact_encounter GROUP BY 1")
q("q060_top_diagnoses", "SELECT icd_code, icd_description, COUNT(*) AS diagnoses FROM dx_star GROUP BY 1, 2 ORDER BY diagnoses DESC, icd_code LIMIT 10")
q("q061_chronic_prevalence", "SELECT icd_description, COUNT(DISTINCT patient_key) FILTER (WHERE is_chronic = 1) AS patients_with_chronic_conditions FROM dx_star GROUP BY 1")
q("q062_top_rx_patients", f"SELECT patient_id, {S('total_cost')} AS rx_cost, COUNT(*) AS fills FROM rx_star GROUP BY 1 ORDER BY rx_cost DESC, patient_id LIMIT 10")
q("q063_age_groups", "SELECT age_group, COUNT(*) AS total_patients FROM dim_patient GROUP BY 1")
RX = f"COUNT(*) AS fills, {S('total_cost')} AS total_cost, {S('payer_paid')} AS payer_paid, {S('patient_copay')} AS copay"
q("q064_rx_cost_by_payer", f"SELECT *, {R('copay / total_cost', 6)} AS copay_share FROM (SELECT payer_name, {RX} FROM rx_star GROUP BY 1) t")
q("q065_copay_by_payer_and_class", f"SELECT payer_name, drug_class, {A('patient_copay')} AS avg_copay FROM rx_star GROUP BY 1, 2")
q("q066_chronic_rx_burden", f"SELECT payer_name, {S('payer_paid')} AS payer_paid, COUNT(*) AS fills FROM rx_star WHERE chronic_med = 1 GROUP BY 1")
q("q067_rx_network", f"SELECT provider_id, payer_name, COUNT(*) AS prescriptions, {S('payer_paid')} AS payer_paid FROM rx_star WHERE payer_name IS NOT NULL GROUP BY 1, 2")
q("q068_reimbursement_gap", f"SELECT *, {R('total_billed - total_paid', 2)} AS gap FROM (SELECT payer_name, {S('billed_amount')} AS total_billed, {S('paid_amount')} AS total_paid, {COLLECT} AS collection_rate FROM claim_star GROUP BY 1) t")
q("q069_readmitted_non_adherent", """SELECT patient_id, max_risk, drug_class, gap_days FROM adh_star JOIN (SELECT patient_key, MAX(readmission_risk_score) AS max_risk FROM fact_encounter WHERE readmission_flag = 1 GROUP BY 1) e USING (patient_key) WHERE adherence_category = 'Non-Adherent'""")
q("q070_denied_with_diagnosis", f"SELECT claim_id, primary_diagnosis_code, icd_description, primary_denial_reason FROM fact_claim LEFT JOIN dim_diagnosis ON icd_code = primary_diagnosis_code WHERE {D}")
q("q071_encounters_with_denials", f"SELECT encounter_id, encounter_type, COUNT(*) AS denied_claims, {S('billed_amount')} AS denied_billed FROM fact_claim JOIN (SELECT encounter_key, encounter_id, encounter_type FROM fact_encounter) e USING (encounter_key) WHERE {D} GROUP BY 1, 2")
q("q072_poverty_denials", f"SELECT 'high_poverty' AS population, COUNT(*) AS claims, {DEN} AS denial_rate FROM claim_star WHERE poverty_rate > 0.25::DOUBLE UNION ALL SELECT 'all', COUNT(*), {DEN} FROM fact_claim")
q("q073_candidates_by_payer", f"""SELECT payer_name, COUNT(DISTINCT patient_key) AS patients, {S('billed_amount')} AS billed, {S('paid_amount')} AS paid FROM claim_star WHERE patient_key IN (SELECT patient_key FROM high_risk) AND patient_key IN (SELECT patient_key FROM non_adherent) GROUP BY 1""")
q("q074_provider_profile", QUERIES["n11_provider_profile"])
q("q075_denied_by_provider", f"SELECT provider_id, display_name, claim_id, primary_denial_reason, payer_name, patient_id FROM claim_star WHERE {D}")
q("q076_patient_panel", "SELECT patient_id, encounter_id, encounter_type, readmission_flag, diagnoses FROM enc_star LEFT JOIN (SELECT encounter_key, COUNT(*) AS diagnoses FROM fact_diagnosis GROUP BY 1) d USING (encounter_key) WHERE provider_id = 'PRV000000000003'")
q("q077_specialty_prescribing", "SELECT medication_name, payer_name, COUNT(*) AS prescriptions, COUNT(DISTINCT patient_key) AS patients FROM rx_star WHERE specialty = 'Cardiology' GROUP BY 1, 2")
q("q078_high_risk_by_provider", """SELECT provider_id, display_name, COUNT(DISTINCT patient_key) AS high_risk_patients, NULLIF(COUNT(DISTINCT diagnosis_key), 0) AS conditions FROM enc_star LEFT JOIN chronic_enc USING (encounter_key)
    WHERE readmission_risk_category = 'High' AND provider_id IS NOT NULL GROUP BY 1, 2""")
q("q079_providers_in_vulnerable_areas", f"SELECT provider_id, specialty, COUNT(DISTINCT patient_key) AS patients, {M('social_vulnerability_index')} AS avg_svi FROM enc_star WHERE sdoh_tier = 'High' AND provider_id IS NOT NULL GROUP BY 1, 2")
q("q080_claims_of_payer", "SELECT claim_id, provider_id, patient_id, claim_status, primary_denial_reason FROM claim_star WHERE payer_name = 'Medicaid Plan 3'")
q("q081_denials_by_payer", f"SELECT payer_name, primary_denial_reason, COUNT(*) AS denied, COUNT(DISTINCT provider_key) AS providers, COUNT(DISTINCT patient_key) AS patients, COUNT(DISTINCT encounter_key) AS encounters FROM claim_star WHERE {D} GROUP BY 1, 2")
q("q082_rx_by_payer", "SELECT payer_name, medication_name, COUNT(*) AS prescriptions, COUNT(DISTINCT provider_key) AS providers, COUNT(DISTINCT patient_key) AS patients FROM rx_star GROUP BY 1, 2")
q("q083_network_of_payer", "SELECT provider_id, encounter_type, COUNT(*) AS claims FROM claim_star LEFT JOIN (SELECT encounter_key, encounter_type FROM fact_encounter) e USING (encounter_key) WHERE payer_name = 'Medicaid Plan 3' GROUP BY 1, 2")
q("q084_payers_in_vulnerable_areas", f"SELECT payer_name, COUNT(DISTINCT patient_key) AS patients, COUNT(*) AS claims, {M('poverty_rate')} AS avg_poverty FROM claim_star WHERE sdoh_tier = 'High' GROUP BY 1")
STORY = """SELECT claim_id, patient_id, encounter_id, encounter_type, provider_id, payer_name, claim_status, primary_denial_reason, CAST(billed_amount AS DOUBLE) AS billed_amount
    FROM claim_star LEFT JOIN (SELECT encounter_key, encounter_id, encounter_type FROM fact_encounter) e USING (encounter_key)"""
q("q085_trace_claim", f"{STORY} WHERE claim_id = (SELECT MIN(claim_id) FROM fact_claim WHERE {D})")
q("q086_denied_story", f"{STORY} WHERE {D}")
q("q087_claims_of_encounter", f"{STORY} WHERE encounter_id = 'ENC000000000100'")
q("q088_denied_of_high_risk", f"{STORY} WHERE {D} AND patient_key IN (SELECT patient_key FROM high_risk)")
q("q089_costly_encounters", """SELECT encounter_id, provider_id, CAST(total_charges AS DOUBLE) AS total_charges, claims, any_denied, diagnoses FROM enc_star LEFT JOIN (SELECT encounter_key, COUNT(*) AS claims, MAX(denial_flag) AS any_denied FROM fact_claim GROUP BY 1) c USING (encounter_key)
    LEFT JOIN (SELECT encounter_key, COUNT(*) AS diagnoses FROM fact_diagnosis GROUP BY 1) d USING (encounter_key) WHERE total_charges > 400000""")
q("q090_claims_network", QUERIES["n12_provider_payer_network"])
q("q091_chronic_rx_network", f"SELECT medication_name, payer_name, COUNT(DISTINCT provider_key) AS providers, {S('payer_paid')} AS payer_paid FROM rx_star WHERE chronic_med = 1 GROUP BY 1, 2")
q("q092_denials_by_diagnosis", f"SELECT icd_category, COUNT(*) AS claims, {n(D)} AS denied, {DEN} AS denial_rate FROM fact_claim LEFT JOIN dim_diagnosis ON icd_code = primary_diagnosis_code GROUP BY 1")
q("q093_rx_burden", f"SELECT payer_name, drug_class, {RX} FROM rx_star GROUP BY 1, 2")
q("q094_poor_adherence_network", "SELECT patient_id, COUNT(DISTINCT provider_key) AS providers, COUNT(DISTINCT payer_key) AS payers FROM rx_star WHERE patient_key IN (SELECT patient_key FROM non_adherent) GROUP BY 1")
q("q095_cover_by_class", f"SELECT drug_class, payer_name, {RX} FROM rx_star GROUP BY 1, 2")
q("q096_most_vulnerable", """SELECT patient_id, max_risk, social_vulnerability_index, providers, payers FROM high_risk JOIN pat_star USING (patient_key) LEFT JOIN (SELECT patient_key, COUNT(DISTINCT provider_key) AS providers, COUNT(DISTINCT payer_key) AS payers FROM fact_claim GROUP BY 1) c USING (patient_key)
    WHERE sdoh_tier = 'High' AND patient_key IN (SELECT patient_key FROM non_adherent)""")
q("q097_network_averages", f"SELECT 'denial_rate' AS metric, payer_name AS name, {DEN} AS value FROM claim_star GROUP BY 2 UNION ALL SELECT 'avg_cost', provider_id, {S('total_cost')} / COUNT(*) FROM enc_star GROUP BY 2")
TRAIL = "SELECT prescription_id, patient_id, medication_name, provider_id, payer_name, CAST(total_cost AS DOUBLE) AS total_cost, CAST(payer_paid AS DOUBLE) AS payer_paid, CAST(patient_copay AS DOUBLE) AS patient_copay FROM rx_star"
q("q098_patient_prescriptions", f"{TRAIL} WHERE patient_id = 'PAT000000000007'")
q("q099_costliest_prescriptions", f"{TRAIL} t ORDER BY t.total_cost DESC, prescription_id LIMIT 20")
q("q100_medication_lifecycle", f"{TRAIL} WHERE medication_name = 'Med Brand#7 10 MG'")
q("q101_brand_prescribing", f"SELECT provider_id, payer_name, COUNT(*) AS prescriptions, {S('payer_paid')} AS payer_paid FROM rx_star WHERE is_generic = 0 GROUP BY 1, 2")
q("q102_food_desert_rx", f"SELECT payer_name, {RX} FROM rx_star WHERE food_desert_flag = 1 AND chronic_med = 1 GROUP BY 1")

q("q103_top_fraud_providers", """SELECT provider_id, MAX(fraud_score) AS max_score, COALESCE(string_agg(DISTINCT fraud_flags, ',' ORDER BY fraud_flags) FILTER (WHERE fraud_flags <> ''), '') AS flags,
    CAST(SUM(CASE WHEN fraud_flags <> '' THEN CAST(claim_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS flagged_amount FROM fraud_scores GROUP BY 1 ORDER BY max_score DESC, provider_id LIMIT 10""")
q("q104_claims_by_fraud_tier", "SELECT risk_tier, COUNT(*) AS claims FROM fraud_scores GROUP BY 1")
q("q105_gaps_by_facility", "SELECT facility_name, measure_id, COUNT(*) AS alerts FROM care_gap_alerts GROUP BY 1, 2")
q("q106_critical_gaps", "SELECT measure_id, COUNT(DISTINCT patient_id) AS patients, MAX(gap_days_overdue) AS max_overdue FROM care_gap_alerts WHERE alert_priority = 'CRITICAL' GROUP BY 1")
ACC = "SELECT patient_id, rolling_spend_30d, ed_visits_30d, readmission_flag, risk_tier FROM highcost_alerts WHERE cost_trend = 'ACCELERATING'"
q("q107_accelerating_members", ACC)
q("q108_geo_anomaly_amount", f"SELECT COUNT(*) AS claims, {S('CAST(claim_amount AS DECIMAL(18,2))')} AS flagged_amount FROM fraud_scores WHERE fraud_flags LIKE '%geo_anomaly%'")
q("q109_cost_and_gaps", "SELECT patient_id, risk_tier, rolling_spend_30d, open_gaps FROM highcost_alerts JOIN (SELECT patient_id, COUNT(DISTINCT measure_id) AS open_gaps FROM care_gap_alerts GROUP BY 1) g USING (patient_id) WHERE risk_tier IN ('CRITICAL', 'HIGH')")
q("q110_top_priorities", "SELECT * FROM worklist ORDER BY max_priority, alert_count DESC, patient_id LIMIT 10")
q("q111_critical_by_facility", "SELECT facility_id, COUNT(*) AS critical_alerts FROM all_alerts WHERE severity = 'CRITICAL' AND facility_id <> '' GROUP BY 1")
q("q112_pipeline_on_time", f"""SELECT 'claims_events' AS table_name, last_event, m AS minutes_ago, CASE WHEN m > 60 THEN 'CRITICAL' WHEN m > 15 THEN 'WARNING' ELSE 'OK' END AS status FROM (SELECT MAX(event_timestamp) AS last_event, COALESCE(date_diff('minute', MAX(event_timestamp), {NOW}), 9999) AS m FROM claims_events) t""")
q("q113_fraud_and_cost", "SELECT patient_id, rolling_spend_30d, max_score FROM highcost_alerts JOIN (SELECT patient_id, MAX(fraud_score) AS max_score FROM fraud_scores WHERE risk_tier IN ('CRITICAL', 'HIGH') GROUP BY 1) f USING (patient_id) WHERE risk_tier IN ('CRITICAL', 'HIGH')")
OPEN = "NOT EXISTS (SELECT 1 FROM alert_closure_events c WHERE c.alert_id = p.alert_id AND action_taken = 'RESOLVED')"
q("q114_unresolved_criticals", f"SELECT persona, COUNT(*) AS unresolved FROM persona_alerts p WHERE severity = 'CRITICAL' AND {back('alert_timestamp', '24 hours')} AND {OPEN} GROUP BY 1")
q("q115_time_to_alert", f"SELECT source_table, COUNT(*) AS alerts, {R('''AVG(date_diff('second', alert_timestamp, ingest_ts))''', 6)} AS avg_seconds FROM all_alerts JOIN landed ON event_id = alert_id GROUP BY 1")


def backlog(name: str, persona: str) -> None:
    q(name, f"SELECT severity, COUNT(*) AS open_alerts FROM persona_alerts p WHERE persona = '{persona}' AND {back('alert_timestamp', '7 days')} AND {OPEN} GROUP BY 1")


_E24 = back("event_timestamp", "24 hours")
_EW = back("event_timestamp", "7 days")
q("q116_deteriorating", f"SELECT event_timestamp, facility_id, ward, patient_id, deterioration_type, news2_score, sirs_score, mews_score, requires_rrt FROM {newest('clinical_deterioration_events', 'patient_id', _E24)} WHERE news2_score >= 5 OR sirs_score >= 2 OR mews_score >= 4")
q("q117_hai_clusters", f"""SELECT facility_id, ward, hai_type, organism, MAX(cluster_size) AS cluster, CAST(SUM(infection_count_72h) AS BIGINT) AS infections, MAX(event_timestamp) AS last_seen FROM mortality_hai_events WHERE {back('event_timestamp', '72 hours')} GROUP BY 1, 2, 3, 4 HAVING MAX(cluster_size) >= 2""")
q("q118_quality_drift", f"SELECT alert_timestamp, provider_name, metric_name, metric_value, benchmark_value, severity FROM provider_alerts WHERE alert_type = 'QUALITY_DRIFT' AND {back('alert_timestamp', '8 hours')}")
q("q119_just_readmitted", f"SELECT alert_id, patient_id, severity, metric_value AS days_since_discharge FROM provider_alerts WHERE alert_type = 'READMISSION_30DAY' AND {back('alert_timestamp', '24 hours')}")
q("q120_risk_and_adherence", CAND)
backlog("q121_backlog_clinical", "CMO")
q("q122_variance_by_contract", f"SELECT contract_type, {S('CAST(variance_dollars AS DECIMAL(18,2))')} AS total_variance, {R('AVG(variance_pct)', 6)} AS avg_pct FROM net_revenue_variance_events WHERE {_E24} GROUP BY 1")
q("q123_underpayments", f"SELECT event_id, payer_name, contract_id, variance_pct, variance_dollars FROM net_revenue_variance_events WHERE variance_pct < -5 AND {back('event_timestamp', '6 hours')}")
q("q124_fraud_exposure", QUERIES["j07_fraud_top_providers"].replace("LIMIT 10", "LIMIT 25"))
q("q125_accelerating_cost", ACC)
backlog("q126_backlog_revenue", "CFO")
q("q127_gap_closures", """SELECT measure_id, COUNT(*) FILTER (WHERE status = 'CLOSED') AS closed, COUNT(*) FILTER (WHERE status = 'OPEN') AS open FROM care_gap_alerts JOIN (SELECT alert_id, status FROM alert_mttr WHERE alert_type = 'CARE_GAP') m USING (alert_id) GROUP BY 1""")
q("q128_ed_boarding", f"""SELECT event_timestamp, facility_id, current_value, threshold_value, utilization_pct FROM {newest('ops_capacity_events', 'facility_id', _E24 + " AND capacity_type = 'ED_BOARDING'")}""")
q("q129_full_units", f"""SELECT facility_id, utilization_pct FROM {newest('ops_capacity_events', 'facility_id', _EW + " AND capacity_type = 'BED_OCCUPANCY'")} WHERE utilization_pct >= 95""")
q("q130_slow_turnover", f"""SELECT facility_id, ward, current_value FROM {newest('ops_capacity_events', 'facility_id', _EW + " AND capacity_type = 'OR_TURNOVER'")} WHERE current_value > 60""")
q("q131_staffing_gaps", f"SELECT facility_id, ward, nurse_count, patient_count, acuity_score, ratio_actual, ratio_target, staffing_gap FROM {newest('staffing_acuity_events', 'facility_id, ward', _E24)} WHERE staffing_gap >= 1")
q("q132_long_stays", QUERIES["k17_los_outliers"])
backlog("q133_backlog_operations", "COO")
q("q134_rules_in_breach", f"""SELECT md5('DQ_THRESHOLD_BREACH|' || event_id) AS alert_id, source_table AS source_system, CASE WHEN violation_pct >= 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, violation_pct AS metric_value
    FROM {newest('dq_violation_events', 'source_table, rule_name', _E24)} WHERE violation_pct >= 1""")
_L = "date_diff('second', event_ts, ingest_ts)"
q("q135_lag_by_type", f"""SELECT tag, event_type, quantile_disc({_L}, 0.5) AS p50, quantile_disc({_L}, 0.9) AS p90, quantile_disc({_L}, 0.99) AS p99, COUNT(*) AS event_count FROM (SELECT tag, json_extract_string(body, '$.event_type') AS event_type,
    TRY_CAST(json_extract_string(body, '$.event_timestamp') AS TIMESTAMP) AS event_ts, ingest_ts FROM landing WHERE ok) t WHERE event_ts IS NOT NULL GROUP BY 1, 2""")
q("q136_phi_anomalies", f"SELECT event_timestamp, user_principal, action_type, resource_accessed, geo_country, anomaly_score FROM audit_access_events WHERE {_E24} AND anomaly_score > 0.6::DOUBLE ORDER BY anomaly_score DESC, event_id LIMIT 50")
q("q137_drifting_models", f"SELECT model_name, model_version, feature_name, psi_value, ks_value, drift_score, severity FROM {newest('model_drift_events', 'model_name, feature_name', _EW)} WHERE psi_value >= 0.1::DOUBLE")
backlog("q138_backlog_platform", "CTO")
