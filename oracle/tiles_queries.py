"""Expected SQL for the dashboard and for graph patterns."""

from __future__ import annotations

import oracle.events_queries  # noqa: F401  (named subqueries used below)
import oracle.metrics_queries  # noqa: F401
from oracle.base import R, S, back, q

FAC = "('nation 3 hospital', 'nation 7 hospital', 'nation 12 hospital')"


def rng(ts: str, some: bool) -> str:
    start = "2024-01-10" if some else "2024-01-01"
    return f"{ts} BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '2024-01-31'"


def claims(some: bool = False, table: str = "claims_events", ts: str = "event_timestamp") -> str:
    extra = f" AND facility_id IN (SELECT facility_id FROM adt_events WHERE lower(facility_name) IN {FAC})" if some else ""
    return f"(SELECT * FROM {table} WHERE {rng(ts, some)}{extra}) c"


def adt(some: bool = False) -> str:
    return f"(SELECT * FROM adt_events WHERE {rng('event_timestamp', some)}{f' AND lower(facility_name) IN {FAC}' if some else ''}) a"


def fraud(some: bool = False) -> str:
    return f"(SELECT * FROM {claims(some, 'fraud_scores', 'score_timestamp')}{' WHERE risk_tier IN (' + chr(39) + 'CRITICAL' + chr(39) + ',' + chr(39) + 'HIGH' + chr(39) + ')' if some else ''}) f"


def gaps(some: bool = False) -> str:
    extra = f" AND lower(facility_name) IN {FAC} AND alert_priority IN ('CRITICAL', 'HIGH')" if some else ""
    return f"(SELECT * FROM care_gap_alerts WHERE {rng('alert_timestamp', some)}{extra}) g"


COSTS = f"(SELECT * FROM highcost_alerts WHERE {rng('alert_timestamp', False)}) h"
BUCKET = "CASE WHEN fraud_score < 30 THEN 'Low (0-30)' WHEN fraud_score < 50 THEN 'Medium (30-50)' WHEN fraud_score < 70 THEN 'High (50-70)' ELSE 'Critical (70+)' END"
NAMES = "(SELECT facility_id, facility_name AS facility FROM adt_events QUALIFY ROW_NUMBER() OVER (PARTITION BY facility_id ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) = 1) nm"
PLACED = "latitude IS NOT NULL AND longitude IS NOT NULL"
MONEY = lambda c: R(f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c})", 2)

for _s, _x in ((False, ""), (True, "_filtered")):
    q(f"k01_event_counts{_x}", f"SELECT (SELECT COUNT(*) FROM {claims(_s)}) AS claims, (SELECT COUNT(*) FROM {adt(_s)}) AS adt, (SELECT COUNT(*) FROM rx_events WHERE {rng('event_timestamp', _s)}) AS rx")
    q(f"k03_claims_by_type{_x}", f"SELECT claim_type, COUNT(*) AS n FROM {claims(_s)} GROUP BY 1")
    q(f"k05_fraud_buckets{_x}", f"SELECT {BUCKET} AS bucket, COUNT(*) AS n FROM {fraud(_s)} GROUP BY 1")
    q(f"k07_care_gap_trend{_x}", f"SELECT date_trunc('hour', alert_timestamp) AS bin, COUNT(*) AS alerts FROM {gaps(_s)} GROUP BY 1")
_H = lambda t: f"(SELECT date_trunc('hour', event_timestamp) AS bin, COUNT(*) AS {t} FROM {t}_events WHERE {rng('event_timestamp', False)} GROUP BY 1) {t}_h"
q("k02_volume_trend", f"SELECT * FROM {_H('claims')} FULL JOIN {_H('adt')} USING (bin) FULL JOIN {_H('rx')} USING (bin)")
q("k03_adt_by_type", f"SELECT event_type, COUNT(*) AS n FROM {adt()} GROUP BY 1")
q("k04_claims_map", f"SELECT latitude, longitude, facility_id, facility, COUNT(*) AS claims, {MONEY('claim_amount')} AS avg_amount FROM {claims()} LEFT JOIN {NAMES} USING (facility_id) WHERE {PLACED} GROUP BY 1, 2, 3, 4")
q("k04_fraud_map", f"SELECT latitude, longitude, facility, COUNT(*) AS alert_count, {R('AVG(fraud_score)', 2)} AS avg_score FROM {fraud()} LEFT JOIN {NAMES} USING (facility_id) WHERE {PLACED} AND fraud_score >= 50 GROUP BY 1, 2, 3")
q("k04_care_gap_map", f"SELECT latitude, longitude, facility_name AS facility, COUNT(*) AS gaps, string_agg(DISTINCT measure_name, ', ' ORDER BY measure_name) AS measures FROM {gaps()} GROUP BY 1, 2, 3")
q("k04_highcost_map", f"SELECT latitude, longitude, facility_name AS facility, COUNT(*) AS patients, {MONEY('rolling_spend_30d')} AS avg_spend, MIN(risk_tier) AS risk_tier FROM {COSTS} WHERE {PLACED} AND facility_name <> '' GROUP BY 1, 2, 3")
q("k05_fraud_total", f"SELECT COUNT(*) AS n FROM {fraud()} WHERE fraud_score >= 50")
q("k06_top_fraud", f"SELECT patient_id, claim_id, fraud_score, fraud_flags, risk_tier, score_timestamp FROM {fraud()} ORDER BY fraud_score DESC, score_id LIMIT 10")
q("k06_top_spend", f"SELECT patient_id, facility_name, risk_tier, rolling_spend_30d, rolling_spend_90d, cost_trend, alert_timestamp FROM {COSTS} ORDER BY rolling_spend_30d DESC, patient_id LIMIT 10")
q("k07_fraud_trend", f"SELECT date_trunc('hour', score_timestamp) AS bin, COUNT(*) AS alerts FROM {fraud()} WHERE fraud_score >= 50 GROUP BY 1")
q("k07_highcost_trend", f"SELECT date_trunc('hour', alert_timestamp) AS bin, COUNT(*) AS alerts FROM {COSTS} GROUP BY 1")
q("k08_fraud_by_flag", f"SELECT flag, COUNT(*) AS n FROM (SELECT unnest(string_split(fraud_flags, '|')) AS flag FROM {fraud()} WHERE fraud_score >= 50) x GROUP BY 1 ORDER BY n DESC, flag LIMIT 10")
q("k09_gaps_by_measure_name", f"SELECT measure_name, COUNT(*) AS n FROM {gaps()} GROUP BY 1")
q("k09_gaps_by_alert_priority", f"SELECT alert_priority, COUNT(*) AS n FROM {gaps()} GROUP BY 1")
q("k09_cost_by_tier", f"SELECT risk_tier, COUNT(*) AS n FROM {COSTS} GROUP BY 1")
q("k09_cost_by_facility", f"SELECT facility_name, COUNT(*) AS patients, {MONEY('rolling_spend_30d')} AS avg_spend, MIN(risk_tier) AS risk_tier FROM {COSTS} GROUP BY 1")
q("k10_mttr_stat", f"""SELECT *, {R('avg_mttr_sec / 60.0::DOUBLE', 1)} AS avg_mttr_min, {R('100.0::DOUBLE * closed / total_alerts', 1)} AS close_rate_pct FROM (SELECT COUNT(*) AS total_alerts, COUNT(*) FILTER (WHERE status = 'CLOSED') AS closed,
    COUNT(*) FILTER (WHERE status = 'OPEN') AS open, {R('AVG(mttr_seconds)', 0)} AS avg_mttr_sec FROM alert_mttr) t""")

WK = back("alert_timestamp", "7 days")
EW = back("event_timestamp", "7 days")
INBOX = "alert_id, alert_timestamp, persona, severity, alert_type, alert_text, recommended_action"
q("k11_open_criticals", f"SELECT COUNT(*) AS open_critical FROM persona_alerts WHERE {WK} AND severity = 'CRITICAL'")
q("k11_by_persona", f"SELECT persona, COUNT(*) AS n FROM persona_alerts WHERE {WK} GROUP BY 1")
q("k11_alert_velocity", f"SELECT time_bucket(INTERVAL '5 minutes', alert_timestamp) AS bin, severity, COUNT(*) AS alerts FROM persona_alerts WHERE {WK} GROUP BY 1, 2")
q("k11_inbox", f"SELECT {INBOX} FROM persona_alerts WHERE {WK} ORDER BY alert_timestamp DESC, alert_id LIMIT 50")
q("k12_mttr_table", "SELECT persona, alert_type, p50_close_minutes, p90_close_minutes, open_count, resolved_count FROM mttr_summary")
q("k12_throughput", f"SELECT *, {R('event_count / 60.0::DOUBLE', 6)} AS events_per_sec FROM (SELECT date_trunc('minute', event_ts) AS bin, tag, COUNT(*) AS event_count FROM landed WHERE {back('event_ts', '2 hours')} GROUP BY 1, 2) t")


def newest(table: str, keys: str, where: str) -> str:
    return f"(SELECT * FROM {table} WHERE {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) = 1) n"


q("k13_deterioration", f"""SELECT event_timestamp, facility_id, ward, patient_id, deterioration_type, news2_score, sirs_score, mews_score, requires_rrt FROM {newest('clinical_deterioration_events', 'patient_id', EW)} WHERE news2_score >= 5 OR sirs_score >= 2 OR mews_score >= 4""")
q("k13_ward_heatmap", f"SELECT date_trunc('hour', event_timestamp) AS bin, ward, COUNT(*) AS cases FROM clinical_deterioration_events WHERE {EW} AND news2_score >= 5 GROUP BY 1, 2")
q("k14_hai_clusters", f"""SELECT facility_id, ward, hai_type, organism, MAX(cluster_size) AS cluster, CAST(SUM(infection_count_72h) AS BIGINT) AS infections, MAX(event_timestamp) AS last_seen FROM mortality_hai_events WHERE {EW} GROUP BY 1, 2, 3, 4 HAVING MAX(cluster_size) >= 2""")
q("k15_readmissions", f"SELECT date_trunc('hour', event_timestamp) AS bin, CASE WHEN days_since_discharge <= 7 THEN '≤7 days' WHEN days_since_discharge <= 14 THEN '≤14 days' ELSE '≤30 days' END AS band, COUNT(*) AS n FROM readmission_events WHERE {EW} GROUP BY 1, 2")
q("k15_drift_watchlist", f"SELECT alert_timestamp, provider_name, metric_name, metric_value, benchmark_value, severity FROM provider_alerts WHERE alert_type = 'QUALITY_DRIFT' AND {WK}")
q("k16_revenue_variance", f"SELECT contract_type, {S('CAST(variance_dollars AS DECIMAL(18,2))')} AS total_variance, {R('AVG(variance_pct)', 6)} AS avg_pct FROM net_revenue_variance_events WHERE {EW} GROUP BY 1")
q("k16_underpayments", f"SELECT event_timestamp, payer_name, contract_id, contract_type, expected_payment, actual_payment, variance_pct, variance_dollars FROM net_revenue_variance_events WHERE {EW} AND variance_pct < -5 ORDER BY variance_dollars, event_id LIMIT 50")
q("k16_fraud_heatmap", f"SELECT provider_id, MAX(fraud_score) AS max_score, COUNT(*) AS cases FROM fraud_scores WHERE {back('score_timestamp', '7 days')} GROUP BY 1 HAVING MAX(fraud_score) > 15")
q("k16_highcost_watchlist", f"SELECT alert_timestamp, patient_id, rolling_spend_30d, rolling_spend_90d, cost_trend, risk_tier FROM highcost_alerts WHERE {WK} ORDER BY rolling_spend_30d DESC, patient_id LIMIT 25")
q("k16_gap_volume", f"SELECT measure_id, alert_priority, COUNT(*) AS n FROM care_gap_alerts WHERE {WK} GROUP BY 1, 2")
_CAP = lambda kind: f"{EW} AND capacity_type = '{kind}'"
q("k17_ed_boarding", f"SELECT event_timestamp, facility_id, current_value, threshold_value, utilization_pct FROM {newest('ops_capacity_events', 'facility_id', _CAP('ED_BOARDING'))}")
q("k17_bed_occupancy", f"SELECT facility_id, utilization_pct FROM {newest('ops_capacity_events', 'facility_id', _CAP('BED_OCCUPANCY'))}")
q("k17_or_turnover", f"SELECT time_bucket(INTERVAL '30 minutes', event_timestamp) AS bin, quantile_disc(current_value, 0.5) AS p50, quantile_disc(current_value, 0.9) AS p90 FROM ops_capacity_events WHERE {_CAP('OR_TURNOVER')} GROUP BY 1")
q("k17_staffing_gap", f"SELECT facility_id, ward, nurse_count, patient_count, acuity_score, ratio_actual, ratio_target, staffing_gap FROM {newest('staffing_acuity_events', 'facility_id, ward', EW)} WHERE staffing_gap >= 1")
q("k17_los_outliers", f"SELECT facility_id, ward, current_value AS los_hours FROM {newest('ops_capacity_events', 'facility_id, ward', _CAP('LOS_HOURS') + ' AND current_value > 168')} ORDER BY los_hours DESC, facility_id, ward LIMIT 25")
q("k17_coo_feed", f"SELECT alert_id, alert_timestamp, severity, alert_type, ward, alert_text, recommended_action FROM coo_alerts WHERE {WK} ORDER BY alert_timestamp DESC, alert_id LIMIT 30")
q("k18_cto_feed", f"SELECT alert_id, alert_timestamp, severity, alert_type, source_system, alert_text, recommended_action FROM cto_alerts WHERE {WK} ORDER BY alert_timestamp DESC, alert_id LIMIT 30")
q("k18_dq_by_source", f"SELECT source_table, rule_type, CAST(SUM(violation_count) AS BIGINT) AS violations, MAX(violation_pct) AS max_pct FROM dq_violation_events WHERE {EW} GROUP BY 1, 2")
q("k18_phi_map", f"SELECT event_timestamp, user_principal, action_type, resource_accessed, geo_country, anomaly_score FROM audit_access_events WHERE {EW} AND anomaly_score > 0.6::DOUBLE ORDER BY anomaly_score DESC, event_id LIMIT 50")
q("k18_model_drift", f"SELECT model_name, model_version, feature_name, psi_value, ks_value, drift_score, severity FROM {newest('model_drift_events', 'model_name, feature_name', EW)} WHERE psi_value >= 0.1::DOUBLE")
_L = "date_diff('second', event_ts, ingest_ts)"
q("k18_ingest_lag", f"SELECT date_trunc('minute', event_ts) AS bin, tag, quantile_disc({_L}, 0.5) AS p50, quantile_disc({_L}, 0.9) AS p90, quantile_disc({_L}, 0.99) AS p99 FROM landed WHERE {back('event_ts', '2 hours')} GROUP BY 1, 2")
q("k19_open_alerts", f"SELECT {INBOX} FROM persona_alerts p WHERE {WK} AND NOT EXISTS (SELECT 1 FROM alert_closure_events c WHERE c.alert_id = p.alert_id AND action_taken = 'RESOLVED')")
q("k19_mttr_heatmap", "SELECT persona, alert_type, p50_close_minutes, p90_close_minutes FROM mttr_summary")

EDGES = """livesIn dim_patient patient_key zip_code;references fact_diagnosis fact_diagnosis_key diagnosis_key;affects fact_diagnosis fact_diagnosis_key patient_key;dispenses fact_prescription prescription_key medication_key
PrescriptionHasPayer fact_prescription prescription_key payer_key;prescribedBy fact_prescription prescription_key provider_key;serves fact_prescription prescription_key patient_key;ClaimHasPayer fact_claim claim_key payer_key
submittedBy fact_claim claim_key provider_key;covers fact_claim claim_key patient_key;involves fact_encounter encounter_key patient_key;treatedBy fact_encounter encounter_key provider_key;billsFor fact_claim claim_key encounter_key
originatesFrom fact_prescription prescription_key encounter_key;occursIn fact_diagnosis fact_diagnosis_key encounter_key;adherenceFor agg_medication_adherence adherence_key patient_key;adherenceMedication agg_medication_adherence adherence_key medication_key"""
EDGE_ROWS = [e.split() for line in EDGES.split("\n") for e in line.split(";")]
for _e, _t, _a, _b in EDGE_ROWS:
    q(f"n01_edge_{_e}", f"SELECT {_a} AS src, {_b} AS dst FROM {_t} WHERE {_b} IS NOT NULL")
for _t in ("agg_days_in_ar", "agg_appeal_outcomes"):
    q(f"n02_payer_edge_{_t}", f"SELECT payer_name, p.payer_key, COUNT(*) AS edges FROM {_t} JOIN dim_payer p USING (payer_name) GROUP BY 1, 2")
NODES = {"Patient": "dim_patient", "Provider": "dim_provider", "Payer": "dim_payer", "Medication": "dim_medication", "Diagnosis": "dim_diagnosis", "CommunityHealth": "dim_sdoh", "Encounter": "fact_encounter", "Claim": "fact_claim",
         "Prescription": "fact_prescription", "PatientDiagnosis": "fact_diagnosis", "MedicationAdherence": "agg_medication_adherence"}
q("n03_graph_counts", " UNION ALL ".join([f"SELECT 'node' AS kind, '{k}' AS name, COUNT(*) AS n FROM {v}" for k, v in NODES.items()] + [f"SELECT 'edge', '{e}', COUNT({b}) FROM {t}" for e, t, a, b in EDGE_ROWS]))
for _t, _n in (("fact_encounter", "encounters"), ("fact_claim", "claims"), ("fact_prescription", "prescriptions")):
    q(f"n04_provider_{_n}", f"SELECT provider_id, display_name, specialty, COUNT(*) AS {_n} FROM {_t} JOIN dim_provider USING (provider_key) GROUP BY 1, 2, 3")
q("n05_denied_claims", "SELECT claim_id, display_name, payer_name, primary_denial_reason, billed_amount FROM claim_star WHERE denial_flag = 1 AND provider_id IS NOT NULL AND payer_id IS NOT NULL")
q("n06_patient_panel", "SELECT display_name, patient_id, encounter_id, encounter_type, readmission_risk_category FROM enc_star WHERE provider_id = 'PRV000000000003' AND patient_id IS NOT NULL")
q("n06_prescribing", "SELECT provider_id, display_name, medication_name, drug_class, COUNT(*) AS prescriptions FROM rx_star WHERE specialty = 'Internal Medicine' AND medication_name IS NOT NULL GROUP BY 1, 2, 3, 4")
q("n06_prescribing_via_encounter", """SELECT e.provider_id, e.display_name, medication_name, COUNT(*) AS prescriptions FROM rx_star r JOIN (SELECT encounter_key, provider_id, display_name, specialty FROM enc_star) e USING (encounter_key)
    WHERE e.specialty = 'Internal Medicine' AND medication_name IS NOT NULL GROUP BY 1, 2, 3""")
q("n07_high_risk_patients", "SELECT display_name, patient_id, encounter_id, readmission_risk_score FROM enc_star WHERE readmission_risk_category = 'High' AND provider_id IS NOT NULL AND patient_id IS NOT NULL")
q("n07_vulnerable_communities", "SELECT provider_id, display_name, patient_id, zip_code, sdoh_tier, social_vulnerability_index, COUNT(*) AS encounters FROM enc_star WHERE social_vulnerability_index > 0.2::DOUBLE AND provider_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6")
q("n08_adherence_candidates", "SELECT DISTINCT patient_id, patient_first_name AS first_name, patient_last_name AS last_name, age, gender FROM adh_star WHERE patient_first_name = 'First7' AND patient_last_name = 'Last7'")
q("n08_adherence_of_patient", "SELECT patient_id, drug_class, medication_name, is_chronic, pdc_score, adherence_category, gap_days FROM adh_star WHERE patient_id = 'PAT000000000007'")
q("n09_non_adherent_ranking", """SELECT patient_id, patient_first_name AS first_name, patient_last_name AS last_name, age, gender, COUNT(*) AS non_adherent_drug_classes FROM adh_star WHERE adherence_category = 'Non-Adherent' GROUP BY 1, 2, 3, 4, 5
    ORDER BY non_adherent_drug_classes DESC, patient_id LIMIT 20""")
q("n10_readmission_by_payer", f"""SELECT payer_name, high_risk, total, CAST(high_risk AS DOUBLE) / total AS rate FROM (SELECT payer_name, COUNT(*) FILTER (WHERE readmission_risk_category = 'High') AS high_risk, COUNT(*) AS total
    FROM claim_star JOIN (SELECT encounter_key, readmission_risk_category FROM fact_encounter) e USING (encounter_key) WHERE payer_name IS NOT NULL GROUP BY 1) t""")
_P = "provider_id = 'PRV000000000003'"
q("n11_provider_profile", f"""SELECT 'provider' AS part, COUNT(*) AS n FROM dim_provider WHERE {_P} UNION ALL SELECT 'patients', COUNT(DISTINCT patient_key) FROM enc_star WHERE {_P} UNION ALL SELECT 'encounters', COUNT(*) FROM enc_star WHERE {_P}
    UNION ALL SELECT 'claims', COUNT(*) FROM claim_star WHERE {_P} UNION ALL SELECT 'prescriptions', COUNT(*) FROM rx_star WHERE {_P}""")
q("n12_provider_payer_network", f"""SELECT provider_id, display_name, payer_name, COUNT(*) AS claims, {S('billed_amount')} AS billed, COUNT(*) FILTER (WHERE denial_flag = 1) AS denied, COUNT(DISTINCT patient_key) AS patients FROM claim_star
    WHERE provider_id IS NOT NULL AND payer_name IS NOT NULL GROUP BY 1, 2, 3""")
q("n13_edge_coverage", " UNION ALL ".join(f"SELECT '{e}' AS edge, '{b}' AS fk, COUNT(*) AS row_count, COUNT({b}) AS matched, {R(f'COUNT({b}) * 100.0::DOUBLE / COUNT(*)', 6)} AS match_pct FROM {t}" for e, t, a, b in EDGE_ROWS))
