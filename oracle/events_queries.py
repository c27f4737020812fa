"""Expected SQL for event routing, time windows, scoring and alerts."""

from __future__ import annotations

from oracle.base import NOW, R, back, cte, minutes, q
from oracle.tables import EVENT_COLUMNS, capacity, spikes, unified

_GROUPS = {"h01": "claims_events adt_events rx_events readmission_events", "h02": "quality_metric_events denial_adjudication_events ar_snapshot_events auth_lifecycle_events",
           "h03": "clinical_deterioration_events mortality_hai_events net_revenue_variance_events ops_capacity_events staffing_acuity_events dq_violation_events audit_access_events model_drift_events alert_closure_events"}
for _g, _names in _GROUPS.items():
    for _n in _names.split():
        q(f"{_g}_route_{_n}", f"SELECT * FROM {_n}")

q("h04_router_stream", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in EVENT_COLUMNS) + " UNION ALL SELECT 'dead_letters', COUNT(*) FROM landing WHERE NOT ok OR tag = 'unknown_events'")
q("h05_typed_defaults", "SELECT event_timestamp IS NULL AS untimed, facility_name = '' AS unnamed, has_open_care_gaps, open_gap_measures, COUNT(*) AS row_count FROM adt_events GROUP BY 1, 2, 3, 4")
q("h06_backfill", "SELECT event_id, event_timestamp, claim_amount FROM claims_events WHERE NOT claim_amount > 2000")
EV = "json_extract_string(body, '$.event_id')"
q("h07_landing_status", f"""SELECT tag, COUNT(*) AS row_count, COUNT(DISTINCT CASE WHEN ok THEN {EV} END) AS event_count, COUNT(*) FILTER (WHERE NOT ok) AS corrupt_count FROM landing GROUP BY 1""")
_DAYS = {"clinical_deterioration_events": 90, "mortality_hai_events": 365, "net_revenue_variance_events": 365, "ops_capacity_events": 90, "staffing_acuity_events": 90, "dq_violation_events": 90,
         "audit_access_events": 365, "model_drift_events": 180, "coo_alerts": 365, "cto_alerts": 365, "alert_closure_events": 730}


def _ts(table: str) -> str:
    return "closure_timestamp" if table == "alert_closure_events" else "alert_timestamp" if table.endswith("_alerts") else "event_timestamp"


_MID = "TIMESTAMP '2024-04-15 12:00:00'"
q("h08_retention", " UNION ALL ".join(f"""SELECT '{t}' AS table_name, {n} AS days, COUNT(*) FILTER (WHERE {_ts(t)} >= {_MID} - INTERVAL '{n} days') AS kept,
    COUNT(*) FILTER (WHERE {_ts(t)} < {_MID} - INTERVAL '{n} days') AS dropped FROM {t}""" for t, n in _DAYS.items()))
q("h08_retention_dropped", " UNION ALL ".join(f"""SELECT CAST({_ts(t)} AS DATE) AS day, COUNT(*) AS row_count, MIN({_ts(t)}) AS oldest, '{t}' AS table_name
    FROM {t} WHERE {_ts(t)} IS NULL OR {_ts(t)} >= {_MID} - INTERVAL '{n} days' GROUP BY 1""" for t, n in _DAYS.items()))
q("h08_retention_rows", f"SELECT event_id, event_timestamp FROM ops_capacity_events WHERE event_timestamp >= {_MID} - INTERVAL '90 days'")
for _label, _size in (("5m", "5 minutes"), ("1h", "1 hour"), ("15m", "15 minutes"), ("1m", "1 minute"), ("30m", "30 minutes")):
    q(f"h09_tumbling_{_label}", f"SELECT time_bucket(INTERVAL '{_size}', event_timestamp) AS bin, claim_type, COUNT(*) AS event_count FROM claims_events WHERE event_timestamp IS NOT NULL GROUP BY 1, 2")
q("h10_lookback_counts", " UNION ALL ".join(f"SELECT '{s}' AS span, COUNT(*) AS event_count FROM claims_events WHERE {back('event_timestamp', s)}" for s in ("15 minutes", "30 minutes", "1 hour", "2 hours", "6 hours", "24 hours", "72 hours", "7 days")))
_RAGGED = NOW.replace(":00:00'", ":03:41'")
for _name in ("h10_lookback_rollups", "h10_rollup_stream"):
    q(_name, " UNION ALL ".join(f"""SELECT '{s}' AS span, claim_type, COUNT(*) AS event_count, MIN(claim_amount) AS min_claim_amount, MAX(claim_amount) AS max_claim_amount FROM claims_events
        WHERE event_timestamp > {_RAGGED} - INTERVAL '{s}' AND event_timestamp <= {_RAGGED} GROUP BY 2""" for s in ("15 minutes", "30 minutes", "1 hour", "2 hours", "6 hours", "24 hours", "72 hours", "7 days")))
q("h10_sliding_windows", """SELECT time_bucket(INTERVAL '15 minutes', event_timestamp) - i * INTERVAL '15 minutes' AS bin, COUNT(*) AS event_count FROM claims_events, range(4) r(i) WHERE event_timestamp IS NOT NULL GROUP BY 1""")
q("h10_sliding_stream", """SELECT bin, tag, COUNT(*) AS event_count FROM (SELECT time_bucket(INTERVAL '15 minutes', event_ts) - i * INTERVAL '15 minutes' AS bin, tag FROM landed, range(4) r(i) WHERE event_ts IS NOT NULL) t
    WHERE bin + INTERVAL '1 hour' <= (SELECT MAX(event_ts) FROM landed) - INTERVAL '10 minutes' GROUP BY 1, 2""")
_LATEST = "FROM ops_capacity_events QUALIFY ROW_NUMBER() OVER (PARTITION BY facility_id, capacity_type ORDER BY event_timestamp DESC NULLS LAST, event_id DESC) = 1"
q("h11_latest_by_key", f"SELECT * {_LATEST}")
q("h11_latest_stream", f"SELECT facility_id, capacity_type, event_id, event_timestamp, current_value {_LATEST}")
q("h12_dedup_batch", "SELECT event_id, claim_id, claim_amount FROM claims_events")
cte("landed", f"SELECT {EV} AS event_id, tag, TRY_CAST(json_extract_string(body, '$.event_timestamp') AS TIMESTAMP) AS event_ts, ingest_ts FROM landing WHERE ok")
q("h12_dedup_stream", "SELECT event_id, tag, event_ts FROM landed WHERE event_ts IS NOT NULL")
q("h13_late_rows", "SELECT event_id, tag, event_ts, ingest_ts FROM landed WHERE ingest_ts > event_ts + INTERVAL '2 minutes'")
q("h13_window_stream", """SELECT time_bucket(INTERVAL '5 minutes', event_ts) AS bin, tag, COUNT(*) AS event_count FROM landed WHERE event_ts IS NOT NULL
    AND time_bucket(INTERVAL '5 minutes', event_ts) + INTERVAL '5 minutes' <= (SELECT MAX(event_ts) FROM landed) - INTERVAL '10 minutes' GROUP BY 1, 2""")
_LAG = "date_diff('second', event_ts, ingest_ts)"
q("h14_ingest_lag", f"SELECT tag, quantile_disc({_LAG}, 0.5) AS p50, quantile_disc({_LAG}, 0.9) AS p90, quantile_disc({_LAG}, 0.99) AS p99, COUNT(*) AS event_count FROM landed WHERE event_ts IS NOT NULL GROUP BY 1")
q("h15_throughput", f"""SELECT *, {R('event_count / 60.0::DOUBLE', 6)} AS events_per_sec FROM (SELECT date_trunc('minute', event_ts) AS bin, tag, COUNT(*) AS event_count FROM landed WHERE {back('event_ts', '1 hour')} GROUP BY 1, 2) t""")
q("h16_freshness", " UNION ALL ".join(f"""SELECT '{t}' AS table_name, last_event, m AS minutes_ago, CASE WHEN m > 60 THEN 'CRITICAL' WHEN m > 15 THEN 'WARNING' ELSE 'OK' END AS status FROM (
    SELECT MAX(event_timestamp) AS last_event, COALESCE(date_diff('minute', MAX(event_timestamp), {NOW}), 9999) AS m FROM {t}) x""" for t in ("claims_events", "adt_events", "rx_events", "ar_snapshot_events", "model_drift_events")))
q("h17_velocity", " UNION ALL ".join(f"SELECT time_bucket(INTERVAL '5 minutes', event_timestamp) AS bin, '{t}' AS event_type, COUNT(*) AS event_count FROM {t}_events WHERE {back('event_timestamp', '1 hour')} GROUP BY 1" for t in ("claims", "adt", "rx")))
q("h18_replay", """SELECT event_id, n AS claims_in_window, CASE WHEN n > 5 THEN LEAST(30, (n - 5) * 6) ELSE 0 END AS velocity_score, 'run7' AS scoring_run_id FROM (SELECT event_id, COUNT(claim_id) OVER (PARTITION BY provider_id
    ORDER BY event_timestamp RANGE BETWEEN INTERVAL '3600 seconds' PRECEDING AND CURRENT ROW) AS n FROM claims_events WHERE event_timestamp >= TIMESTAMP '2024-01-20') t""")
q("h19_sessions", """SELECT provider_id, MIN(event_timestamp) AS session_start, MAX(event_timestamp) + INTERVAL '10 minutes' AS session_end, COUNT(*) AS event_count FROM (SELECT *, SUM(fresh) OVER (PARTITION BY provider_id ORDER BY event_timestamp ROWS UNBOUNDED PRECEDING) AS sid
    FROM (SELECT *, CASE WHEN event_timestamp < lag(event_timestamp) OVER (PARTITION BY provider_id ORDER BY event_timestamp) + INTERVAL '10 minutes' THEN 0 ELSE 1 END AS fresh FROM claims_events WHERE event_timestamp IS NOT NULL) a) b GROUP BY provider_id, sid""")
q("h19_session_stream", """SELECT * FROM (SELECT tag, MIN(event_ts) AS session_start, MAX(event_ts) + INTERVAL '10 minutes' AS session_end, COUNT(*) AS event_count FROM (SELECT *, SUM(fresh) OVER (PARTITION BY tag ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS sid
    FROM (SELECT *, CASE WHEN event_ts < lag(event_ts) OVER (PARTITION BY tag ORDER BY event_ts) + INTERVAL '10 minutes' THEN 0 ELSE 1 END AS fresh FROM landed WHERE event_ts IS NOT NULL) a) b GROUP BY tag, sid) s
    WHERE session_end <= (SELECT MAX(event_ts) FROM landed) - INTERVAL '10 minutes'""")
_ENRICH = "SELECT event_id, event_type, patient_key, age_group, facility_type FROM adt_events LEFT JOIN dim_patient USING (patient_id) LEFT JOIN dim_facility USING (facility_id)"
q("h20_enrich", _ENRICH)
q("h20_enrich_stream", _ENRICH)

q("j01_provider_baseline", f"SELECT provider_id, hist_avg_amount, {R('hist_std_amount', 4)} AS hist_std_amount, hist_claim_count FROM provider_baseline")
q("j02_velocity", "SELECT event_id, claims_in_window, velocity_score FROM velocity")

def _closed(tables: str) -> str:
    """The last time of the tables less the delay: what lies before has been given out."""
    return f"((SELECT MAX(event_ts) FROM landed WHERE tag IN ({tables})) - INTERVAL '10 minutes')"


q("j02_velocity_stream", "SELECT event_id, claims_in_window, velocity_score FROM velocity")
q("j03_amount", f"SELECT event_id, amount_zscore, {R('amount_score', 5)} AS amount_score FROM fraud_scored")
q("j04_geo", f"SELECT event_id, geo_distance_deg, {R('geo_score', 5)} AS geo_score FROM fraud_scored")
q("j04_geo_haversine", f"""SELECT event_id, {R('''2 * 6371.0 * asin(sqrt(LEAST(1.0, pow(sin(radians(f.latitude - c.latitude) / 2), 2) + cos(radians(c.latitude)) * cos(radians(f.latitude)) * pow(sin(radians(f.longitude - c.longitude) / 2), 2))))''', 3)} AS km
    FROM claims_events c LEFT JOIN dim_facility f USING (facility_id)""")
q("j05_upcoding", "SELECT event_id, procedure_code, upcoding_score FROM fraud_scored")
q("j06_fraud_scores", f"SELECT * REPLACE ({R('amount_score', 5)} AS amount_score, {R('geo_score', 5)} AS geo_score) FROM fraud_scores")
_AMOUNT = "CAST(SUM(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE)"
q("j07_fraud_summary", f"SELECT risk_tier, COUNT(*) AS claim_count, {R('AVG(fraud_score)', 1)} AS avg_score, {R('MAX(fraud_score)', 1)} AS max_score, {_AMOUNT} AS total_amount FROM fraud_scores GROUP BY 1")
q("j07_fraud_top_providers", f"""SELECT provider_id, flagged_claims, avg_fraud_score, total_flagged_amount, display_name AS provider_name, specialty FROM (SELECT provider_id, COUNT(*) AS flagged_claims, {R('AVG(fraud_score)', 1)} AS avg_fraud_score,
    {_AMOUNT} AS total_flagged_amount FROM fraud_scores WHERE risk_tier IN ('CRITICAL', 'HIGH') GROUP BY 1) t LEFT JOIN dim_provider USING (provider_id) ORDER BY avg_fraud_score DESC, provider_id LIMIT 10""")

q("j08_care_gap_alerts", "SELECT * FROM care_gap_alerts")
q("j09_care_gap_priority", """SELECT md5('CARE_GAP|' || event_id || '|' || g.measure_id) AS alert_id, g.measure_id, COALESCE(g.measure_name, g.measure_id) AS measure_name, a.gap_days_overdue, alert_priority,
    'Open measure ' || g.measure_id || ' [' || COALESCE(g.measure_name, g.measure_id) || ']: ' || COALESCE(patient_first_name, '') || ' ' || COALESCE(patient_last_name, '') || ' is in the house; due since ' || a.gap_days_overdue || ' days.' AS alert_text
    FROM care_gap_alerts a JOIN care_gaps g ON a.patient_id = g.patient_id AND a.measure_id = g.measure_id""")
q("j10_care_gap_by_priority", "SELECT alert_priority, COUNT(*) AS alert_count, COUNT(DISTINCT patient_id) AS unique_patients, COUNT(DISTINCT facility_id) AS facilities_involved, COUNT(DISTINCT measure_id) AS measures_flagged FROM care_gap_alerts GROUP BY 1")
q("j10_care_gap_by_measure", f"SELECT measure_id, measure_name, COUNT(*) AS alerts, COUNT(DISTINCT patient_id) AS patients, {R('AVG(gap_days_overdue)', 0)} AS avg_days_overdue FROM care_gap_alerts GROUP BY 1, 2")
q("j10_care_gap_by_facility", "SELECT facility_name, COUNT(*) AS total_alerts, COUNT(*) FILTER (WHERE alert_priority = 'CRITICAL') AS critical_alerts, COUNT(DISTINCT patient_id) AS unique_patients FROM care_gap_alerts GROUP BY 1")
q("j11_rolling_spend", "SELECT event_id, patient_id, rolling_spend_30d, rolling_spend_90d, claims_count_30d FROM rolling_spend")
q("j12_ed_visits", "SELECT * FROM ed_visits")
q("j13_readmissions", "SELECT * FROM readmission_counts")
q("j13_readmission_stream", "SELECT * FROM readmission_counts WHERE readmission_count_30d > 0")
q("j14_latest_spend", "SELECT patient_id, rolling_spend_30d, rolling_spend_90d, claims_count_30d, latitude, longitude FROM latest_spend")
q("j15_highcost_alerts", "SELECT * FROM highcost_alerts")
_MEAN = lambda c, n=0: R(f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c})", n)
q("j16_highcost_by_risk_tier", f"""SELECT risk_tier, COUNT(*) AS patients, {_MEAN('rolling_spend_30d')} AS avg_spend_30d, {_MEAN('rolling_spend_90d')} AS avg_spend_90d, {R('AVG(ed_visits_30d)', 1)} AS avg_ed_visits,
    COUNT(*) FILTER (WHERE readmission_flag) AS readmissions FROM highcost_alerts GROUP BY 1""")
q("j16_highcost_by_cost_trend", f"SELECT cost_trend, COUNT(*) AS members, {_MEAN('rolling_spend_30d')} AS avg_30d_spend, {R('AVG(ed_visits_30d)', 1)} AS avg_ed_visits FROM highcost_alerts GROUP BY 1")
q("j16_highcost_top", """SELECT patient_id, patient_first_name, patient_last_name, risk_tier, cost_trend, rolling_spend_30d, rolling_spend_90d, ed_visits_30d, readmission_flag FROM highcost_alerts WHERE risk_tier IN ('CRITICAL', 'HIGH')
    ORDER BY rolling_spend_30d DESC, patient_id LIMIT 15""")

for _n, _t in {"j17_readmission_alerts": "readmission_alerts", "j18_quality_drift": "quality_drift_alerts", "j19_denial_spikes": "spikes_week", "j20_high_dollar_denials": "high_dollar_week", "j21_ar_breaches": "ar_breach_alerts",
               "j22_auth_expiring": "auth_alerts", "j29_provider_alerts": "provider_alerts", "j29_payer_alerts": "payer_alerts", "j29_coo_alerts": "coo_alerts", "j29_cto_alerts": "cto_alerts"}.items():
    q(_n, f"SELECT * FROM {_t}")
q("j19_denial_spikes_hour", spikes("1 hour", 1))
q("j23_capacity_alerts", "SELECT * FROM coo_alerts WHERE alert_type <> 'STAFFING_GAP'")
q("j23_capacity_alerts_hour", capacity("1 hour"))
q("j24_staffing_alerts", "SELECT * FROM coo_alerts WHERE alert_type = 'STAFFING_GAP'")
for _n, _k in {"j25_dq_alerts": "DQ_THRESHOLD_BREACH", "j26_phi_alerts": "PHI_ANOMALY", "j27_drift_alerts": "MODEL_DRIFT"}.items():
    q(_n, f"SELECT * FROM cto_alerts WHERE alert_type = '{_k}'")
q("j28_thresholds", """SELECT threshold_key, warn, crit, over_warn, over_crit FROM (SELECT threshold_key, warn_value AS warn, critical_value AS crit FROM dashboard_thresholds WHERE threshold_key IN ('ed_boarding_count', 'bed_occupancy_pct', 'or_turnover_minutes',
    'staffing_gap_count', 'dq_violation_pct', 'phi_anomaly_score', 'model_drift_psi') UNION ALL SELECT 'unknown_key', 1.5, 2.5) t LEFT JOIN (SELECT 'ed_boarding_count' AS threshold_key, COUNT(*) FILTER (WHERE current_value >= 10) AS over_warn,
    COUNT(*) FILTER (WHERE current_value >= 20) AS over_crit FROM ops_capacity_events WHERE capacity_type = 'ED_BOARDING' HAVING COUNT(*) > 0) c USING (threshold_key)""")

q("j30_all_alerts", unified("7 days"))
q("j31_cross_stream_patients", f"""SELECT *, CASE WHEN stream_count >= 3 THEN 'CRITICAL' ELSE 'HIGH' END AS severity_rank FROM (SELECT patient_id, COUNT(DISTINCT source_table) AS stream_count, string_agg(DISTINCT source_table, ', ' ORDER BY source_table) AS streams,
    COUNT(*) AS total_alerts, MAX(score) AS max_score, MAX(alert_timestamp) AS last_alert, MIN(alert_text) AS sample_text FROM all_alerts WHERE {back('alert_timestamp', '7 days', True)} GROUP BY 1) t WHERE stream_count >= 2""")


def _spells(found: str, keys: str) -> str:
    """Of windows in breach those more severe than the window a day before."""
    level = "CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 ELSE 1 END"
    return f"""SELECT * EXCLUDE (level, before) FROM (SELECT *, CASE WHEN lag(window_start) OVER w = window_start - INTERVAL '1 day' THEN lag(level) OVER w END AS before
        FROM (SELECT *, {level} AS level FROM ({found}) a) b WINDOW w AS (PARTITION BY {keys} ORDER BY window_start)) c WHERE before IS NULL OR level > before"""


_WINDOWS = "time_bucket(INTERVAL '1 day', event_timestamp) - i * INTERVAL '1 day' AS window_start"
_DENIALS = _spells(f"""SELECT window_start, window_start + INTERVAL '7 days' AS window_end, payer_id, payer_name, COUNT(*) AS total, COUNT(*) FILTER (WHERE hit) AS denied, COUNT(*) FILTER (WHERE hit) / COUNT(*) AS denial_rate,
    CAST(COALESCE(SUM(CAST(billed_amount AS DECIMAL(18,2))) FILTER (WHERE hit), 0) AS DOUBLE) AS denied_dollars,
    (SELECT denial_reason FROM (SELECT denial_reason, COUNT(*) AS n FROM denial_adjudication_events d WHERE d.adjudication_result = 'DENIED' AND d.payer_id = t.payer_id AND d.payer_name = t.payer_name
        AND d.event_timestamp >= t.window_start AND d.event_timestamp < t.window_start + INTERVAL '7 days' GROUP BY 1) r ORDER BY n DESC, denial_reason LIMIT 1) AS top_reason,
    CASE WHEN denial_rate >= 0.2 THEN 'CRITICAL' WHEN denial_rate >= 0.15 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM (SELECT *, adjudication_result = 'DENIED' AS hit, {_WINDOWS} FROM denial_adjudication_events, range(7) r(i) WHERE event_timestamp IS NOT NULL) t
    GROUP BY window_start, payer_id, payer_name HAVING COUNT(*) >= 20 AND denial_rate > 0.12""", "payer_id, payer_name")
q("j19_denial_spells", _DENIALS)
q("j19_denial_spike_stream", f"""SELECT * FROM ({_DENIALS}) s WHERE window_end <= {_closed("'denial_adjudication_events'")}""")
_SIGNALS = ("clinical_deterioration_events", "denial_adjudication_events", "readmission_events")
_PATIENTS = _spells(f"""SELECT window_start, window_start + INTERVAL '7 days' AS window_end, patient_id, COUNT(DISTINCT source_table) AS stream_count, string_agg(DISTINCT source_table, ', ' ORDER BY source_table) AS streams,
    COUNT(*) AS total_alerts, MAX(score) AS max_score, CASE WHEN COUNT(DISTINCT source_table) >= 3 THEN 'CRITICAL' ELSE 'HIGH' END AS severity FROM (SELECT *, {_WINDOWS} FROM (
    SELECT patient_id, news2_score AS score, 'clinical_deterioration_events' AS source_table, event_timestamp FROM clinical_deterioration_events WHERE news2_score >= 5
    UNION ALL SELECT patient_id, billed_amount, 'denial_adjudication_events', event_timestamp FROM denial_adjudication_events WHERE adjudication_result = 'DENIED'
    UNION ALL SELECT patient_id, readmission_risk_score, 'readmission_events', event_timestamp FROM readmission_events) s, range(7) r(i) WHERE event_timestamp IS NOT NULL) t
    GROUP BY window_start, patient_id HAVING COUNT(DISTINCT source_table) >= 2""", "patient_id")
q("j31_patient_spells", _PATIENTS)
_SIGNAL_WEEK = " UNION ALL ".join(f"""SELECT '{t}' AS source_table, patient_id FROM {t} WHERE patient_id IS NOT NULL
    AND CAST(event_timestamp AS DATE) BETWEEN CAST({NOW} AS DATE) - 6 AND CAST({NOW} AS DATE)""" for t in _SIGNALS)
q("l06_distinct_by_sketch", f"""SELECT source_table, COUNT(DISTINCT patient_id) AS patients, TRUE AS within_bound FROM ({_SIGNAL_WEEK}) a GROUP BY 1
    UNION ALL SELECT 'shared by all', COUNT(*) FILTER (WHERE n = {len(_SIGNALS)}), TRUE FROM (SELECT patient_id, COUNT(DISTINCT source_table) AS n FROM ({_SIGNAL_WEEK}) b GROUP BY 1) c""")
# Of three streams the slowest one holds the watermark back.
q("j31_cross_patient_stream", f"""SELECT * FROM ({_PATIENTS}) s WHERE window_end <= LEAST({', '.join(_closed(f"'{t}'") for t in _SIGNALS)})""")
_W = lambda ts: f"{back(ts, '7 days', True)} AND provider_id <> ''"
q("j32_provider_scorecard", f"""SELECT *, {R('fraud_score_p95 * 0.4 + denial_rate_pct * 2.0 + readmit_count * 5.0', 1)} AS composite_risk FROM (SELECT provider_id, COALESCE(p95, 0) AS fraud_score_p95, COALESCE(fa, 0) AS fraud_alerts, COALESCE(n, 0) AS total_claims, COALESCE(dn, 0) AS denied_claims,
    COALESCE({R('100.0::DOUBLE * dn / n', 1)}, 0) AS denial_rate_pct, COALESCE(rn, 0) AS readmit_count FROM (SELECT provider_id FROM fraud_scores WHERE {_W('score_timestamp')} UNION SELECT provider_id FROM denial_adjudication_events WHERE {_W('event_timestamp')}
    UNION SELECT provider_id FROM readmission_events WHERE {_W('event_timestamp')}) ids LEFT JOIN (SELECT provider_id, {R('quantile_disc(fraud_score, 0.95)', 1)} AS p95, COUNT(*) FILTER (WHERE fraud_score >= 50) AS fa FROM fraud_scores WHERE {_W('score_timestamp')} GROUP BY 1) f USING (provider_id)
    LEFT JOIN (SELECT provider_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE adjudication_result = 'DENIED') AS dn FROM denial_adjudication_events WHERE {_W('event_timestamp')} GROUP BY 1) d USING (provider_id)
    LEFT JOIN (SELECT provider_id, COUNT(*) AS rn FROM readmission_events WHERE {_W('event_timestamp')} GROUP BY 1) r USING (provider_id)) t""")
cte("alert_mttr", """SELECT a.alert_id, alert_timestamp, source_table, a.alert_type, patient_id, severity, score, alert_text, closure_timestamp, resolved_by, action_taken, COALESCE(date_diff('second', alert_timestamp, closure_timestamp), 0) AS mttr_seconds,
    CASE WHEN closure_timestamp IS NOT NULL THEN 'CLOSED' ELSE 'OPEN' END AS status FROM all_alerts a LEFT JOIN (SELECT * FROM alert_closure_events QUALIFY ROW_NUMBER() OVER (PARTITION BY alert_id ORDER BY closure_timestamp, closure_id) = 1) c USING (alert_id)""")
q("j33_alert_mttr", "SELECT * FROM alert_mttr")
cte("mttr_summary", f"""SELECT persona, alert_type, COUNT(*) FILTER (WHERE close_time IS NULL AND ack_time IS NULL) AS open_count, COUNT(*) FILTER (WHERE close_time IS NULL AND ack_time IS NOT NULL) AS ack_count, COUNT(*) FILTER (WHERE close_time IS NOT NULL) AS resolved_count,
    quantile_disc(am, 0.5) AS p50_ack_minutes, quantile_disc(am, 0.9) AS p90_ack_minutes, quantile_disc(cm, 0.5) AS p50_close_minutes, quantile_disc(cm, 0.9) AS p90_close_minutes, {R('AVG(cm)', 6)} AS avg_close_minutes FROM (
    SELECT *, {minutes('ack_time', 'alert_timestamp')} AS am, {minutes('close_time', 'alert_timestamp')} AS cm FROM persona_alerts LEFT JOIN (SELECT alert_id, MIN(closure_timestamp) FILTER (WHERE action_taken = 'ACKNOWLEDGED') AS ack_time,
    MIN(closure_timestamp) FILTER (WHERE action_taken = 'RESOLVED') AS close_time FROM alert_closure_events WHERE {back('closure_timestamp', '7 days')} GROUP BY 1) c USING (alert_id) WHERE {back('alert_timestamp', '7 days')}) t GROUP BY 1, 2""")
q("j34_mttr_summary", "SELECT * FROM mttr_summary")
_SEED = lambda ts: back(ts, "7 days", True)
q("j35_tagged_events", f"""SELECT event_timestamp AS alert_timestamp, 'claims_events' AS source, injected_fraud_flags AS seed_label, patient_id, provider_id, facility_id, 'Claim $' || CAST(trunc(claim_amount) AS BIGINT) || ' ' || procedure_code AS detail
    FROM claims_events WHERE {_SEED('event_timestamp')} AND injected_fraud_flags LIKE 'SEED:%' UNION ALL SELECT event_timestamp, 'readmission_events', current_encounter_id, patient_id, provider_id, facility_id, 'Readmit ' || days_since_discharge || 'd DRG=' || drg_code
    FROM readmission_events WHERE {_SEED('event_timestamp')} AND current_encounter_id LIKE 'SEED-%' UNION ALL SELECT alert_timestamp, 'care_gap_alerts', alert_id, patient_id, '', facility_id, alert_text FROM care_gap_alerts WHERE {_SEED('alert_timestamp')} AND alert_id LIKE 'SEED-%'
    UNION ALL SELECT alert_timestamp, 'highcost_alerts', alert_id, patient_id, '', '', '' FROM highcost_alerts WHERE alert_id LIKE 'SEED-%'
    UNION ALL SELECT event_timestamp, 'ops_capacity_events', event_type, '', '', facility_id, capacity_type || ' = ' || current_value || ' / ' || threshold_value FROM ops_capacity_events WHERE {_SEED('event_timestamp')} AND event_type LIKE 'SEED\\_%' ESCAPE '\\'""")
q("j36_alerts_enriched", f"""SELECT a.*, p.first_name || ' ' || p.last_name AS patient_name, p.date_of_birth AS patient_dob, p.gender AS patient_gender, v.display_name AS provider_name, v.specialty AS provider_specialty, v.npi_number AS provider_npi,
    v.facility_id AS provider_home_facility, f.facility_name, f.latitude AS facility_lat, f.longitude AS facility_lon FROM all_alerts a LEFT JOIN dim_patient p USING (patient_id) LEFT JOIN dim_provider v ON a.provider_id = v.provider_id
    LEFT JOIN dim_facility f ON a.facility_id = f.facility_id WHERE {back('alert_timestamp', '30 days', True)}""")
q("j37_worklist", "SELECT * FROM worklist")
q("j37_worklist_alerts", "SELECT * FROM worklist_alerts WHERE patient_id IN (SELECT patient_id FROM worklist)")
q("j38_route_actions", """SELECT md5('ACTION|' || alert_id) AS action_id, alert_type, alert_id, patient_id, CASE alert_type WHEN 'FRAUD' THEN 'SIU_REFERRAL' WHEN 'CARE_GAP' THEN 'PROVIDER_ALERT' ELSE 'CM_REFERRAL' END AS action_type,
    CASE alert_type WHEN 'FRAUD' THEN 'Special Investigations Unit Queue' WHEN 'CARE_GAP' THEN 'Provider Care Team / EHR Alert' ELSE 'Care Management Program Referral' END AS destination, 'ROUTED' AS status, detail
    FROM worklist_alerts WHERE risk_tier = 'CRITICAL' AND patient_id IN (SELECT patient_id FROM worklist WHERE max_priority = 1)""")
q("j39_sla_burndown", f"""SELECT time_bucket(INTERVAL '15 minutes', alert_timestamp) AS bin, COUNT(*) FILTER (WHERE close_time IS NULL) AS open, COUNT(*) FILTER (WHERE close_time IS NOT NULL) AS resolved
    FROM persona_alerts LEFT JOIN closure_times USING (alert_id) WHERE {back('alert_timestamp', '7 days')} GROUP BY 1""")


def _check(name: str, table: str, ts: str, span: str, value: str = "COUNT(*)") -> str:
    return f"SELECT '{name}' AS check_id, {value} AS value FROM {table} WHERE {back(ts, span, True)}"


_E = "event_timestamp"
q("j40_stream_checks", "SELECT *, value > 0 AS ok FROM (" + " UNION ALL ".join([
    _check("claims_fresh", "claims_events", _E, "5 minutes"), _check("adt_fresh", "adt_events", _E, "5 minutes"), _check("rx_fresh", "rx_events", _E, "5 minutes"),
    _check("fraud_scored", "fraud_scores", "score_timestamp", "30 minutes"), _check("fraud_coverage", "fraud_scores", "score_timestamp", "1 hour", "COUNT(*) FILTER (WHERE fraud_score >= 50)"),
    _check("readmissions_landed", "readmission_events", _E, "1 hour"),
    _check("adt_kinds", "adt_events", _E, "1 day", "LEAST(COUNT(*) FILTER (WHERE event_type = 'ADMIT'), COUNT(*) FILTER (WHERE event_type = 'DISCHARGE'))"),
    f"SELECT 'patient_overlap', COUNT(DISTINCT patient_id) FROM claims_events WHERE {back(_E, '1 day', True)} AND patient_id IN (SELECT patient_id FROM dim_patient)"]) + ") t")
q("j41_trigger_rules", """SELECT 'SIU_REFERRAL' AS rule, patient_id, fraud_score AS monitored_value, risk_tier AS card_label FROM fraud_scores WHERE fraud_score >= 50
    UNION ALL SELECT 'CARE_GAP_OUTREACH', patient_id, CAST(gap_days_overdue AS DOUBLE), alert_priority FROM care_gap_alerts WHERE gap_days_overdue > 90
    UNION ALL SELECT 'CARE_MANAGEMENT', patient_id, rolling_spend_30d, risk_tier FROM highcost_alerts WHERE rolling_spend_30d > 50000
    UNION ALL SELECT 'CARE_TRANSITIONS', patient_id, readmission_risk_score, drg_code FROM readmission_events WHERE readmission_risk_score >= 70 OR days_since_discharge <= 7 AND readmission_risk_score >= 50""")
