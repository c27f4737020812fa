"""Expected SQL for the measures and the ways of evaluating them."""

from __future__ import annotations

from oracle.base import A, M, R, S, cte, div, q

# Facts with the columns of their dimensions.
_PAT = "LEFT JOIN (SELECT patient_key, patient_id, first_name AS patient_first_name, last_name AS patient_last_name, age, age_group, gender, insurance_type, zip_code FROM dim_patient) pt USING (patient_key)"
_PRV = "LEFT JOIN (SELECT provider_key, provider_id, display_name, specialty, documentation_score FROM dim_provider) pv USING (provider_key)"
_PAY = "LEFT JOIN (SELECT payer_key, payer_id, payer_name, payer_type, plan_type AS payer_plan_type FROM dim_payer) py USING (payer_key)"
_SDOH = "LEFT JOIN (SELECT zip_code, risk_tier AS sdoh_tier, social_vulnerability_index, poverty_rate, food_desert_flag FROM dim_sdoh) sd USING (zip_code)"
_FAC = "LEFT JOIN (SELECT facility_key, facility_id, facility_name, facility_type FROM dim_facility) fa USING (facility_key)"
_MED = "LEFT JOIN (SELECT medication_key, rxnorm_code, medication_name, generic_name, drug_class, therapeutic_area, is_chronic AS chronic_med FROM dim_medication) md USING (medication_key)"


def _date(key: str) -> str:
    return f"LEFT JOIN (SELECT date_key, full_date, year, quarter, month_number, month_name FROM dim_date) dt ON dt.date_key = f.{key}"


cte("claim_star", f"SELECT f.*, pt.* EXCLUDE (patient_key), pv.* EXCLUDE (provider_key), py.* EXCLUDE (payer_key), sd.* EXCLUDE (zip_code), fa.* EXCLUDE (facility_key), dt.* FROM fact_claim f {_PAT} {_PRV} {_PAY} {_SDOH} {_FAC} {_date('claim_date_key')}")
cte("enc_star", f"SELECT f.*, pt.* EXCLUDE (patient_key), pv.* EXCLUDE (provider_key), sd.* EXCLUDE (zip_code), fa.* EXCLUDE (facility_key), dt.* FROM fact_encounter f {_PAT} {_PRV} {_SDOH} {_FAC} {_date('encounter_date_key')}")
cte("rx_star", f"SELECT f.*, pt.* EXCLUDE (patient_key), pv.* EXCLUDE (provider_key), py.* EXCLUDE (payer_key), sd.* EXCLUDE (zip_code), md.* EXCLUDE (medication_key) FROM fact_prescription f {_PAT} {_PRV} {_PAY} {_SDOH} {_MED}")
cte("dx_star", f"SELECT f.*, pt.* EXCLUDE (patient_key), g.* EXCLUDE (diagnosis_key, icd_code) FROM fact_diagnosis f {_PAT} LEFT JOIN (SELECT diagnosis_key, icd_code, icd_description, icd_category, is_chronic FROM dim_diagnosis) g USING (diagnosis_key)")
cte("adh_star", f"SELECT f.*, pt.* EXCLUDE (patient_key), sd.* EXCLUDE (zip_code), md.* EXCLUDE (medication_key, drug_class, therapeutic_area) FROM agg_medication_adherence f {_PAT} {_SDOH} {_MED}")
cte("pat_star", "SELECT p.*, s.risk_tier AS sdoh_tier, s.social_vulnerability_index, s.poverty_rate, s.food_desert_flag FROM dim_patient p LEFT JOIN dim_sdoh s USING (zip_code)")
cte("prem_star", "SELECT f.*, metal_tier, payer_name, payer_type FROM fact_premium f LEFT JOIN dim_plan l USING (plan_key) LEFT JOIN (SELECT payer_key, payer_name, payer_type FROM dim_payer) y USING (payer_key)")
cte("auth_star", f"SELECT f.*, pv.specialty, pv.display_name, py.payer_type, py.payer_name FROM fact_authorization f {_PRV} {_PAY}")
cte("cap_star", f"SELECT f.*, pv.specialty, pv.display_name, pv.provider_id FROM fact_capitation f {_PRV}")
cte("appeal_star", f"SELECT f.*, py.payer_type, py.payer_name FROM fact_appeal f {_PAY}")
cte("raf_star", "SELECT f.*, metal_tier FROM agg_raf_score f LEFT JOIN dim_plan USING (plan_key)")
cte("contract_star", f"SELECT f.*, py.payer_type, py.payer_name FROM bridge_provider_contract f {_PAY}")
cte("overall_star", f"SELECT f.*, py.payer_type FROM agg_star_rating_overall f {_PAY}")


def n(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


def share(cond: str) -> str:
    return div(n(cond), "COUNT(*)")


def blankd(c: str) -> str:
    return f"COUNT(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS INTEGER)"


def m(number: int, name: str, table: str, by: str, expr: str, alias: str | None = None) -> None:
    q(f"m{number:03d}_{name}", f"SELECT {by} AS {alias or by}, {expr} AS {name} FROM {table} GROUP BY 1")


DENIED = "denial_flag = 1"
for _args in [
    (1, "high_risk_denials", "claim_star", "payer_type", n("denial_risk_category = 'High'")), (2, "adherent_rate", "adh_star", "drug_class", share("adherence_category = 'Adherent'")),
    (3, "avg_pdc_score", "adh_star", "drug_class", M("pdc_score")), (4, "total_patients", "dim_patient", "age_group", "COUNT(*)"), (5, "chronic_patients", "dx_star", "age_group", "COUNT(DISTINCT patient_key) FILTER (WHERE is_chronic = 1)"),
    (7, "avg_patient_age", "dim_patient", "gender", M("age")), (8, "female_patients", "dim_patient", "age_group", n("gender = 'Female'")), (9, "male_patients", "dim_patient", "age_group", n("gender = 'Male'")),
    (10, "avg_satisfaction_score", "dim_provider", "specialty", M("patient_satisfaction_score")), (11, "avg_documentation_score", "dim_provider", "specialty", M("documentation_score")),
    (12, "avg_ehr_adoption_score", "dim_provider", "specialty", M("ehr_adoption_score")), (13, "telehealth_enabled_rate", "dim_provider", "specialty", share("telehealth_enabled")), (14, "board_certified_rate", "dim_provider", "specialty", share("board_certified")),
    (15, "avg_panel_size", "dim_provider", "specialty", M("patient_panel_size")), (16, "avg_rvu_target", "dim_provider", "specialty", M("annual_rvu_target")), (17, "value_based_provider_rate", "dim_provider", "specialty", share("contract_type = 'Value-Based'")),
    (18, "avg_actual_rvu", "dim_provider", "specialty", M("actual_rvu")), (19, "rvu_attainment_pct", "dim_provider", "specialty", div("SUM(actual_rvu)", "SUM(annual_rvu_target)")),
    (22, "total_claims", "claim_star", "payer_type", "COUNT(*)"), (23, "denial_rate", "claim_star", "payer_type", share(DENIED)), (24, "total_billed", "claim_star", "payer_type", S("billed_amount")), (25, "total_paid", "claim_star", "payer_type", S("paid_amount")),
    (26, "collection_rate", "claim_star", "payer_type", div("SUM(paid_amount)", "SUM(billed_amount)")), (27, "at_risk_revenue", "claim_star", "payer_type", S("CASE WHEN denial_risk_category IN ('High', 'Medium') THEN billed_amount ELSE 0 END")),
    (28, "avg_denial_risk", "claim_star", "payer_type", M("denial_risk_score")), (29, "avg_days_to_payment", "claim_star", "payer_type", M("days_to_payment")), (30, "net_collection_rate", "claim_star", "payer_type", M("net_collection_rate")),
    (31, "appeal_success_rate", "claim_star", "payer_type", div(n("appeal_outcome IN ('Overturned', 'Partial')"), "COUNT(appeal_outcome)")), (32, "total_appeal_recovery", "claim_star", "payer_type", S("appeal_amount_recovered")),
    (35, "unique_diagnoses", "dx_star", "age_group", blankd("diagnosis_key")), (36, "chronic_diagnoses", "dx_star", "age_group", "COUNT(DISTINCT diagnosis_key) FILTER (WHERE is_chronic = 1)"),
    (37, "patients_with_chronic_conditions", "dx_star", "icd_category", "COUNT(DISTINCT patient_key) FILTER (WHERE is_chronic = 1)"), (38, "total_encounters", "enc_star", "specialty", "COUNT(*)"), (39, "readmission_rate", "enc_star", "specialty", share("readmission_flag = 1")),
    (40, "high_risk_readmissions", "enc_star", "specialty", n("readmission_risk_category = 'High'")), (41, "medium_risk_readmissions", "enc_star", "specialty", n("readmission_risk_category = 'Medium'")), (42, "low_risk_readmissions", "enc_star", "specialty", n("readmission_risk_category = 'Low'")),
    (43, "avg_length_of_stay", "enc_star", "encounter_type", M("length_of_stay")), (44, "avg_readmission_risk", "enc_star", "specialty", M("readmission_risk_score")), (49, "total_cost", "enc_star", "year", S("total_cost")),
    (50, "avg_drg_weight", "enc_star", "drg_code", M("drg_weight")), (51, "total_expected_reimbursement", "enc_star", "drg_code", S("expected_reimbursement")),
    (52, "drg_margin", "enc_star", "drg_code", R(div(f"{S('expected_reimbursement')} - {S('total_cost')}", S("expected_reimbursement")), 6)), (54, "avg_cost_per_encounter", "enc_star", "specialty", f"{S('total_cost')} / COUNT(*)"),
    (58, "total_fills", "rx_star", "drug_class", "COUNT(*)"), (59, "total_rx_cost", "rx_star", "drug_class", S("total_cost")), (60, "avg_rx_cost_per_fill", "rx_star", "drug_class", f"{S('total_cost')} / COUNT(*)"), (61, "generic_fill_rate", "rx_star", "drug_class", share("is_generic = 1")),
    (62, "payer_rx_cost", "rx_star", "payer_type", S("payer_paid")), (63, "patient_copay_total", "rx_star", "payer_type", S("patient_copay")), (64, "hedis_compliance_pct", "agg_hedis_compliance", "measure_id", div("SUM(numerator_met)", "SUM(denominator_eligible)")),
    (65, "hedis_eligible_members", "agg_hedis_compliance", "measure_id", "CAST(SUM(denominator_eligible) AS BIGINT)"), (66, "hedis_numerator_met", "agg_hedis_compliance", "measure_id", "CAST(SUM(numerator_met) AS BIGINT)"),
    (67, "mlr_pct", "agg_mlr_by_payer_month", "payer_type", div("SUM(CAST(medical_paid AS DECIMAL(18,2)))", "SUM(CAST(premium_collected AS DECIMAL(18,2)))")), (68, "premium_collected", "agg_mlr_by_payer_month", "payer_type", S("CAST(premium_collected AS DECIMAL(18,2))")),
    (69, "medical_paid", "agg_mlr_by_payer_month", "payer_type", S("CAST(medical_paid AS DECIMAL(18,2))")), (70, "avg_raf_score", "raf_star", "metal_tier", M("raf_score")), (71, "avg_hcc_count", "raf_star", "metal_tier", M("hcc_count")),
    (72, "members_with_hccs", "raf_star", "metal_tier", "COUNT(DISTINCT member_key) FILTER (WHERE hcc_count > 0)"), (73, "avg_star_score", "agg_star_rating", "domain", M("star_score")), (74, "weighted_star_score", "agg_star_rating", "domain", R("SUM(weighted_score) / SUM(weight)", 6)),
    (75, "overall_star_score", "overall_star", "payer_type", M("overall_star_score")), (76, "contract_count", "contract_star", "payer_type", "COUNT(*)"), (77, "in_network_contract_rate", "contract_star", "payer_type", share("is_in_network")),
    (78, "total_payers", "dim_payer", "payer_type", "COUNT(*)"), (79, "avg_reimbursement_rate", "dim_payer", "payer_type", M("avg_reimbursement_pct")), (80, "large_network_payers", "dim_payer", "payer_type", n("network_size = 'Large'")),
    (81, "commercial_payers", "dim_payer", "plan_type", n("payer_type = 'Commercial'")), (82, "government_payers", "dim_payer", "plan_type", n("payer_type = 'Government'")), (83, "total_plans", "dim_plan", "metal_tier", "COUNT(*)"),
    (84, "capitated_plan_count", "dim_plan", "metal_tier", n("is_capitated")), (85, "total_appeals", "appeal_star", "payer_type", "COUNT(*)"), (86, "appeal_recovery", "appeal_star", "payer_type", S("appeal_amount_recovered")),
    (87, "appeal_win_rate", "appeal_star", "payer_type", share("appeal_outcome = 'Won'")), (88, "total_auths", "auth_star", "payer_type", "COUNT(*)"), (89, "pa_approval_rate", "auth_star", "payer_type", div(n("auth_outcome = 'Approved'"), n("auth_outcome <> ''"))),
    (90, "pa_denial_rate", "auth_star", "specialty", div(n("auth_outcome = 'Denied'"), n("auth_outcome <> ''"))), (91, "avg_decision_tat", "auth_star", "specialty", M("decision_tat_hours")), (92, "total_capitation_paid", "cap_star", "specialty", S("capitation_pmpm")),
    (93, "avg_capitation_pmpm", "cap_star", "specialty", A("capitation_pmpm")), (94, "avg_withhold_pct", "cap_star", "specialty", M("withhold_pct")), (95, "collection_rate_of_totals", "claim_star", "payer_type", div(S("paid_amount"), S("billed_amount"))),
    (96, "at_risk_revenue_high", "claim_star", "payer_type", S("CASE WHEN denial_risk_category = 'High' THEN billed_amount END")), (97, "appeal_success_rate_won", "claim_star", "payer_type", div(n("appeal_outcome = 'Won'"), "COUNT(appeal_outcome)")),
    (101, "total_premium_revenue", "prem_star", "metal_tier", S("premium_amount")), (102, "member_months", "prem_star", "metal_tier", "COUNT(*)"), (103, "premium_pmpm", "prem_star", "metal_tier", f"{S('premium_amount')} / COUNT(*)"),
    (104, "total_subsidy", "prem_star", "metal_tier", S("subsidy_amount")), (105, "total_member_paid", "prem_star", "metal_tier", S("member_paid")), (106, "total_providers", "dim_provider", "specialty", "COUNT(*)"),
    (107, "full_time_providers", "dim_provider", "specialty", n("fte_status = 'Full-time'")), (108, "avg_years_experience", "dim_provider", "specialty", M("years_experience")), (109, "high_risk_sdoh_patients", "pat_star", "age_group", n("sdoh_tier = 'High'")),
    (110, "avg_svi", "dim_sdoh", "risk_tier", M("social_vulnerability_index")), (111, "provider_denial_count", "claim_star", "specialty", n(DENIED)), (114, "unique_medications_prescribed", "rx_star", "specialty", blankd("medication_key")),
]:
    m(*_args)

# Figures by year list every year of the calendar the fact's dates reach.
for _number, _name, _expr in ((45, "total_charges", S("total_charges")), (55, "inpatient_encounters", n("encounter_type = 'Inpatient'")), (56, "emergency_encounters", n("encounter_type = 'Emergency'")),
                              (112, "telehealth_encounters", n("encounter_type = 'Telehealth'")), (113, "telehealth_rate", div(n("encounter_type = 'Telehealth'"), "COUNT(*)"))):
    m(_number, _name, "enc_star", "year", _expr)
q("m034_paid_by_payment_date", f"SELECT year, {S('paid_amount')} AS paid_by_payment_date FROM fact_claim LEFT JOIN dim_date ON date_key = payment_date_key GROUP BY 1")
q("m006_chronic_rate", "SELECT age_group, CAST(c AS DOUBLE) / t AS chronic_rate FROM (SELECT age_group, COUNT(*) AS t FROM dim_patient GROUP BY 1) a LEFT JOIN (SELECT age_group, COUNT(DISTINCT patient_key) FILTER (WHERE is_chronic = 1) AS c FROM dx_star GROUP BY 1) b USING (age_group)")
_PANEL = f"""SELECT COALESCE(a.specialty, b.specialty) AS specialty, CAST(pats AS DOUBLE) / provs AS panel, size FROM (SELECT specialty, {blankd('patient_key')} AS pats FROM enc_star GROUP BY 1) a
    FULL JOIN (SELECT specialty, COUNT(DISTINCT provider_key) AS provs, {M('patient_panel_size')} AS size FROM dim_provider GROUP BY 1) b ON a.specialty IS NOT DISTINCT FROM b.specialty"""
q("m020_actual_panel_count", f"SELECT specialty, panel AS actual_panel_count FROM ({_PANEL}) t")
q("m021_panel_utilization_pct", f"SELECT specialty, panel / size AS panel_utilization_pct FROM ({_PANEL}) t")
q("m053_pmpm", f"""SELECT age_group, {R('(c + COALESCE(r, 0)) / (p * (SELECT COUNT(DISTINCT (year, month_number)) FROM dim_date))', 6)} AS pmpm FROM (SELECT age_group, {S('total_cost')} AS c FROM enc_star GROUP BY 1) a
    LEFT JOIN (SELECT age_group, {S('total_cost')} AS r FROM rx_star GROUP BY 1) b USING (age_group) LEFT JOIN (SELECT age_group, COUNT(*) AS p FROM dim_patient GROUP BY 1) d USING (age_group)""")
q("m057_quality_score", f"""SELECT age_group, {R('((1 - r) + a + (1 - d)) / 3', 6)} AS quality_score FROM (SELECT age_group, {share('readmission_flag = 1')} AS r FROM enc_star GROUP BY 1) x FULL JOIN (SELECT age_group, {share("adherence_category = 'Adherent'")} AS a FROM adh_star GROUP BY 1) y USING (age_group)
    FULL JOIN (SELECT age_group, {share(DENIED)} AS d FROM claim_star GROUP BY 1) z USING (age_group)""")
q("m099_pmpm_charges", f"SELECT specialty, {S('total_charges')} / (({blankd('patient_key')}) * 12) AS pmpm_charges FROM enc_star GROUP BY 1")
cte("daily_claims", "SELECT year, month_number, full_date, COUNT(*) AS total_claims FROM claim_star GROUP BY 1, 2, 3")
q("m033_mtd_claims", "SELECT *, CAST(SUM(total_claims) OVER (PARTITION BY year, month_number ORDER BY full_date) AS BIGINT) AS mtd_claims FROM daily_claims")
q("m098_mtd_claims_of_month", "SELECT year, month_number, CAST(SUM(total_claims) AS BIGINT) AS mtd_claims FROM daily_claims WHERE day(full_date) <= 15 GROUP BY 1, 2")
cte("monthly_charges", f"SELECT year, month_number, {S('total_charges')} AS total_charges, SUM(total_charges) AS exact FROM enc_star GROUP BY 1, 2")
q("m046_py_charges", "SELECT c.year, c.month_number, c.total_charges, p.total_charges AS py_total_charges FROM monthly_charges c LEFT JOIN monthly_charges p ON p.year = c.year - 1 AND p.month_number = c.month_number")
cte("yearly_charges", f"SELECT year, {S('total_charges')} AS total_charges FROM enc_star GROUP BY 1")
q("m047_yoy_charge_growth", f"SELECT c.year, {R('(c.total_charges - p.total_charges) / p.total_charges', 6)} AS yoy_growth FROM yearly_charges c LEFT JOIN yearly_charges p ON p.year = c.year - 1")
_YTD = "SELECT year, month_number, total_charges, CAST(SUM(exact) OVER (PARTITION BY year ORDER BY month_number) AS DOUBLE) AS ytd_charges FROM monthly_charges"
q("m048_ytd_charges", _YTD)
q("m100_ytd_charges_by_quarter", f"SELECT year, quarter, CAST(x AS DOUBLE) AS total_charges, CAST(SUM(x) OVER (PARTITION BY year ORDER BY quarter) AS DOUBLE) AS ytd_charges FROM (SELECT year, quarter, SUM(total_charges) AS x FROM enc_star GROUP BY 1, 2) t")

q("l01_measures_by_columns", f"""SELECT payer_name, payer_type, c.total_claims, denial_rate, total_premium_revenue, total_auths, (SELECT COUNT(*) FROM dim_patient) AS total_patients FROM (SELECT payer_name, payer_type, COUNT(*) AS total_claims, {share(DENIED)} AS denial_rate FROM claim_star GROUP BY 1, 2) c
    LEFT JOIN (SELECT payer_name, {S('premium_amount')} AS total_premium_revenue FROM prem_star GROUP BY 1) p USING (payer_name) LEFT JOIN (SELECT payer_name, COUNT(*) AS total_auths FROM auth_star GROUP BY 1) a USING (payer_name)""")
q("l02_scalar_measures", f"""SELECT COUNT(*) AS total_claims, {S('billed_amount')} AS total_billed, {share(DENIED)} AS denial_rate, {S("CASE WHEN denial_risk_category IN ('High', 'Medium') THEN billed_amount ELSE 0 END")} AS at_risk_revenue, (SELECT COUNT(*) FROM dim_patient) AS total_patients,
    (SELECT {M('pdc_score')} FROM agg_medication_adherence) AS avg_pdc_score, (SELECT {div('SUM(CAST(medical_paid AS DECIMAL(18,2)))', 'SUM(CAST(premium_collected AS DECIMAL(18,2)))')} FROM agg_mlr_by_payer_month) AS mlr_pct,
    (SELECT {div('SUM(numerator_met)', 'SUM(denominator_eligible)')} FROM agg_hedis_compliance) AS hedis_compliance_pct FROM fact_claim""")
q("l03_top_measures", f"SELECT payer_name, {share(DENIED)} AS denial_rate FROM claim_star GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
q("l04_filtered_measure", f"""SELECT specialty, SUM(billed_amount) FILTER (WHERE claim_status = 'Approved') AS approved_billed, {S("CASE WHEN denial_risk_category IN ('High', 'Medium') THEN billed_amount ELSE 0 END")} AS at_risk_revenue FROM claim_star GROUP BY 1""")
q("l05_safe_ratio", f"""SELECT claim_status, {div(n("appeal_outcome IN ('Overturned', 'Partial')"), 'COUNT(appeal_outcome)')} AS appeal_success_rate, {div('SUM(paid_amount)', 'SUM(allowed_amount)')} AS net_collection_ratio, {div('SUM(paid_amount)', 'SUM(billed_amount)')} AS collection_rate_of_totals FROM fact_claim GROUP BY 1""")
q("l06_distinct_with_blank", f"SELECT {blankd('diagnosis_key')} AS unique_diagnoses, COUNT(DISTINCT diagnosis_key) FILTER (WHERE is_chronic = 1) AS chronic_diagnoses FROM dx_star")
q("l07_time_comparison", f"""SELECT c.*, p.total_charges AS py_total_charges, {R('(c.total_charges - p.total_charges) / p.total_charges', 6)} AS yoy_growth FROM ({_YTD}) c LEFT JOIN monthly_charges p ON p.year = c.year - 1 AND p.month_number = c.month_number""")
q("l08_other_date", f"""SELECT year, quarter, total_paid, paid_by_payment_date FROM (SELECT year, quarter, {S('paid_amount')} AS total_paid FROM fact_claim LEFT JOIN dim_date ON date_key = claim_date_key GROUP BY 1, 2) a
    FULL JOIN (SELECT year, quarter, {S('paid_amount')} AS paid_by_payment_date FROM fact_claim LEFT JOIN dim_date ON date_key = payment_date_key GROUP BY 1, 2) b USING (year, quarter)""")
q("l09_snowflake_filter", f"""SELECT age_group, total_patients, readmission_rate, denial_rate FROM (SELECT age_group, COUNT(*) AS total_patients FROM pat_star WHERE sdoh_tier = 'High' GROUP BY 1) a FULL JOIN (SELECT age_group, {share('readmission_flag = 1')} AS readmission_rate FROM enc_star
    WHERE sdoh_tier = 'High' GROUP BY 1) b USING (age_group) FULL JOIN (SELECT age_group, {share(DENIED)} AS denial_rate FROM claim_star WHERE sdoh_tier = 'High' GROUP BY 1) c USING (age_group)""")
q("l10_blank_member", f"SELECT facility_type, COUNT(*) AS total_claims, {S('billed_amount')} AS total_billed FROM claim_star GROUP BY 1")
q("l11_benchmark_bands", f"SELECT *, CASE WHEN denial_rate < 0.05 THEN 'green' WHEN denial_rate <= 0.08 THEN 'amber' ELSE 'red' END AS band FROM (SELECT payer_name, {share(DENIED)} AS denial_rate FROM claim_star GROUP BY 1) t")
q("l11_benchmark_bands_adherence", f"""SELECT *, CASE WHEN adherent_rate > 0.85 THEN 'green' WHEN adherent_rate >= 0.80 THEN 'amber' ELSE 'red' END AS band FROM (SELECT drug_class, {share("adherence_category = 'Adherent'")} AS adherent_rate FROM adh_star GROUP BY 1) t""")
q("l12_inpatient_readmissions", f"""SELECT specialty, {div(n("readmission_flag = 1 AND encounter_type = 'Inpatient'"), n("encounter_type = 'Inpatient'"))} AS inpatient_readmission_rate, {share('readmission_flag = 1')} AS readmission_rate FROM enc_star GROUP BY 1""")
q("l12_revenue_leakage", f"SELECT payer_type, {S("CASE WHEN claim_status = 'Approved' THEN billed_amount - paid_amount END")} AS revenue_leakage FROM claim_star GROUP BY 1")
q("l12_high_risk_readmissions", f"SELECT encounter_type, {share('readmission_flag = 1')} AS readmission_rate FROM enc_star WHERE sdoh_tier = 'High' GROUP BY 1")
q("l13_calibrated_accuracy", f"""SELECT {R('observed', 6)} AS observed, {R('tpr', 6)} AS tpr, {R('fpr', 6)} AS fpr, {R('GREATEST(0, LEAST(1, (observed - fpr) / CASE WHEN tpr - fpr > 0.000001 THEN tpr - fpr ELSE 1 END))', 6)} AS calibrated FROM (SELECT {div(n('toxic = 0'), 'COUNT(*)')} AS observed,
    {div(n('quality = 1 AND toxic = 0'), f"GREATEST({n('quality = 1')}, 1)")} AS tpr, {div(n('quality <> 1 AND toxic = 0'), f"GREATEST({n('quality <> 1')}, 1)")} AS fpr FROM labels) t""")
