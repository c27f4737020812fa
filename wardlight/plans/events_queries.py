"""Queries for event routing, time windows, scoring and alerts, in batch and as streams."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import reference_data as ref
from wardlight.functions import scalars as s
from wardlight.operators import alerts, caregaps, events, fraud, highcost, retention, rollups, sketches, spells, views
from wardlight.operators.latest import latest_by
from wardlight.plans.registry import plain, query, tables
from wardlight.plans.warehouse import WEEK, Warehouse, coo_limits, cto_limits
from wardlight.sources import files, landing
from wardlight.streaming import jobs, stateful

# --- routing -----------------------------------------------------------------------------------

tables({f"h01_route_{t}": f"{t}" for t in ("claims_events", "adt_events", "rx_events", "readmission_events")})
tables({f"h02_route_{t}": f"{t}" for t in ("quality_metric_events", "denial_adjudication_events", "ar_snapshot_events", "auth_lifecycle_events")})
tables({f"h03_route_{t}": f"{t}" for t in ("clinical_deterioration_events", "mortality_hai_events", "net_revenue_variance_events", "ops_capacity_events",
                                            "staffing_acuity_events", "dq_violation_events", "audit_access_events", "model_drift_events", "alert_closure_events")})


def _fresh(w: Warehouse, name: str) -> str:
    return f"{w.folder}/{name}-{uuid.uuid4().hex[:8]}"


def _landing_folder(w: Warehouse) -> str:
    w["landing_raw"]  # written by the warehouse; the stream reads its files
    return f"{w.folder}/landing_raw"


def _stream(w: Warehouse) -> DataFrame:
    return jobs.landing_stream(w.spark, _landing_folder(w))


def _run(w: Warehouse, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    out = _fresh(w, name)
    jobs.finish(jobs.to_table(df, f"{out}/rows", f"{out}/checkpoint", mode))
    return w.spark.read.parquet(f"{out}/rows")


@query("h04_router_stream")
def _(w):
    out = _fresh(w, "router")
    jobs.finish(jobs.run_router(_stream(w), f"{out}/tables", f"{out}/checkpoint"))
    parts = [jobs.routed(w.spark, f"{out}/tables", t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in [*landing.EVENT_TABLES, "dead_letters"]]
    return events.union_all(parts)


@query("h05_typed_defaults")
def _(w):
    return w["adt_events"].groupBy(
        F.col("event_timestamp").isNull().alias("untimed"), (F.col("facility_name") == "").alias("unnamed"), "has_open_care_gaps", "open_gap_measures").agg(F.count(F.lit(1)).alias("row_count"))


@query("h06_backfill")
def _(w):
    existing = w["claims_events"].filter(F.col("claim_amount") > 2000)
    return landing.backfill(w["landing_parsed"], "claims_events", existing).select("event_id", "event_timestamp", "claim_amount")


@query("h07_landing_status")
def _(w):
    return landing.landing_status(w["landing_parsed"]).withColumnRenamed("_table", "tag")


RETAINED_AT = "2024-04-15 12:00:00"


def _time_of(table: str) -> str:
    return "closure_timestamp" if table == "alert_closure_events" else "alert_timestamp" if table.endswith("_alerts") else "event_timestamp"


@query("h08_retention")
def _(w):
    return events.retention_report({t: (w[t], _time_of(t)) for t in ref.RETENTION_DAYS}, RETAINED_AT)


@query("h08_retention_dropped")
def _(w):
    folder, parts = _fresh(w, "retention"), []
    for t, days in ref.RETENTION_DAYS.items():
        ts = _time_of(t)
        schema = w[t].drop(events.DAY).withColumn(events.DAY, F.to_date(ts)).schema
        retention.save_by_day(w[t].drop(events.DAY), f"{folder}/{t}", ts)
        retention.drop_before(w.spark, f"{folder}/{t}", ts, retention.cut_of(RETAINED_AT, days))
        left = files.read_table(w.spark, f"{folder}/{t}", schema)
        parts.append(left.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("oldest")).withColumn("table_name", F.lit(t)))
    return events.union_all(parts)


@query("h08_retention_rows")
def _(w):
    return events.apply_retention(w["ops_capacity_events"], "event_timestamp", 90, RETAINED_AT).select("event_id", "event_timestamp")


for _size, _label in (("5 minutes", "5m"), ("1 hour", "1h"), ("15 minutes", "15m"), ("1 minute", "1m"), ("30 minutes", "30m")):
    query(f"h09_tumbling_{_label}")(lambda w, size=_size: events.tumbling(w["claims_events"], "event_timestamp", size, ["claim_type"]))


SPANS = {label: datetime.timedelta(minutes=m) for label, m in (("15 minutes", 15), ("30 minutes", 30), ("1 hour", 60), ("2 hours", 120), ("6 hours", 360),
                                                               ("24 hours", 1440), ("72 hours", 4320), ("7 days", 10080))}


@query("h10_lookback_counts")
def _(w):
    spans = list(SPANS)
    longest = events.lookback(w["claims_events"], "event_timestamp", w.now, spans[-1])
    counts = longest.agg(*[F.count_if(F.col("event_timestamp") > events.moment(w.now) - s.spark_interval(span)).alias(span) for span in spans])
    return counts.unpivot([], spans, "span", "event_count")


# Amounts of events are doubles: compared, not added, since sums would depend on their order.
CLAIM_ROLLUP = rollups.Rollup("event_timestamp", ("claim_type",), {}, ("claim_amount",), ("claim_amount",))


def _off_the_minute(w: Warehouse) -> str:
    """A moment amid a minute, so that both ends of a look-back are ragged."""
    return w.now.replace(":00:00", ":03:41")


@query("h10_lookback_rollups")
def _(w):
    path = _fresh(w, "rollups")
    rows = w["claims_events"]
    rollups.add_batch(rows, CLAIM_ROLLUP, path, 0)
    return rollups.lookbacks(w.spark, path, CLAIM_ROLLUP, rows, _off_the_minute(w), SPANS)


@query("h10_rollup_stream")
def _(w):
    out = _fresh(w, "rollup-stream")
    path = f"{out}/rollups"
    jobs.finish(jobs.run_rollup(_stream(w), "claims_events", CLAIM_ROLLUP, path, f"{out}/checkpoint"))
    rollups.fold(w.spark, path, CLAIM_ROLLUP)
    return rollups.lookbacks(w.spark, path, CLAIM_ROLLUP, w["claims_events"], _off_the_minute(w), SPANS)


@query("h10_sliding_windows")
def _(w):
    return events.tumbling(w["claims_events"], "event_timestamp", "1 hour", slide="15 minutes")


@query("h10_sliding_stream")
def _(w):
    return _run(w, jobs.window_counts(_stream(w), "10 minutes", "1 hour", ["_table"], "15 minutes"), "sliding").withColumnRenamed("_table", "tag")


@query("h11_latest_by_key")
def _(w):
    return plain(latest_by(w["ops_capacity_events"], ["facility_id", "capacity_type"], "event_timestamp", "event_id"))


@query("h11_latest_stream")
def _(w):
    columns = ["event_id", "event_timestamp", "current_value"]
    keys, out = ["facility_id", "capacity_type"], _fresh(w, "latest")
    latest = jobs.latest_stream(jobs.landing_stream(w.spark, _landing_folder(w), 1), "ops_capacity_events", keys, columns)
    jobs.finish(jobs.to_table(latest, f"{out}/rows", f"{out}/checkpoint", "update"))
    return jobs.read_latest(w.spark, f"{out}/rows", keys)


@query("h12_dedup_batch")
def _(w):
    twice = w["claims_events"].unionByName(w["claims_events"])
    return events.dedup_events(twice).select("event_id", "claim_id", "claim_amount")


@query("h12_dedup_stream")
def _(w):
    folder = _fresh(w, "twice")
    for _n in range(2):
        w["landing_raw"].write.mode("append").parquet(folder)
    once = jobs.dedup_stream(jobs.landing_stream(w.spark, folder), "40 days")
    return _run(w, once.select("event_id", F.col("_table").alias("tag"), "event_ts"), "dedup")


@query("h13_late_rows")
def _(w):
    late = events.split_late(w["landing_parsed"].filter(F.col("_corrupt_record").isNull()), "2 minutes")[1]
    return late.select("event_id", F.col("_table").alias("tag"), "event_ts", "ingest_ts")


@query("h13_window_stream")
def _(w):
    return _run(w, jobs.window_counts(_stream(w), "10 minutes", "5 minutes", ["_table"]), "windows").withColumnRenamed("_table", "tag")


@query("h14_ingest_lag")
def _(w):
    return events.ingest_lag(w["landing_parsed"]).withColumnRenamed("_table", "tag")


@query("h15_throughput")
def _(w):
    return events.throughput(w["landing_parsed"], w.now, "1 hour").withColumnRenamed("_table", "tag")


STREAMS = ("claims_events", "adt_events", "rx_events")


@query("h16_freshness")
def _(w):
    return events.freshness(w.pick(*STREAMS, "ar_snapshot_events", "model_drift_events"), w.now)


@query("h17_velocity")
def _(w):
    return events.velocity({n.removesuffix("_events"): w[n] for n in STREAMS}, w.now)


@query("h18_replay")
def _(w):
    again = events.replay(w["claims_events"], "2024-01-20 00:00:00", "run7")
    return fraud.velocity_score(again).select("event_id", "claims_in_window", "velocity_score", "scoring_run_id")


@query("h19_sessions")
def _(w):
    return events.sessions(w["claims_events"], "10 minutes", ["provider_id"])


@query("h19_session_stream")
def _(w):
    return _run(w, jobs.session_counts(_stream(w), "10 minutes", "10 minutes", ["_table"]), "sessions").withColumnRenamed("_table", "tag")


@query("h20_enrich")
def _(w):
    people = w["dim_patient"].select("patient_id", "patient_key", "age_group")
    places = w["dim_facility"].select("facility_id", "facility_type")
    return events.enrich_stream(w["adt_events"], [(people, "patient_id"), (places, "facility_id")]).select("event_id", "event_type", "patient_key", "age_group", "facility_type")


@query("h20_enrich_stream")
def _(w):
    people = w["dim_patient"].select("patient_id", "patient_key", "age_group")
    places = w["dim_facility"].select("facility_id", "facility_type")
    joined = jobs.enrich(_stream(w), "adt_events", [(people, "patient_id"), (places, "facility_id")])
    return _run(w, joined.select("event_id", "event_type", "patient_key", "age_group", "facility_type"), "enriched")


# --- fraud ---------------------------------------------------------------------------------------

@query("j01_provider_baseline")
def _(w):
    return fraud.provider_baseline(w["fact_claim"], w["dim_provider"]).withColumn("hist_std_amount", s.rounded("hist_std_amount", 4))


@query("j02_velocity")
def _(w):
    return fraud.velocity_score(w["claims_events"]).select("event_id", "claims_in_window", "velocity_score")


DELAY = "10 minutes"


@query("j02_velocity_stream")
def _(w):
    out = _fresh(w, "velocity")
    jobs.finish(jobs.to_table(stateful.velocity_stream(_stream(w), DELAY), f"{out}/rows", f"{out}/checkpoint"))
    scored = w.spark.read.parquet(f"{out}/rows").unionByName(stateful.velocity_rest(w.spark, f"{out}/checkpoint"))
    return scored.select("event_id", "claims_in_window", "velocity_score")


@query("j03_amount")
def _(w):
    scored = fraud.amount_score(w["claims_events"].join(fraud.provider_baseline(w["fact_claim"], w["dim_provider"]), "provider_id", "left"))
    return scored.select("event_id", "amount_zscore", s.rounded("amount_score", 5).alias("amount_score"))


def _placed(w: Warehouse) -> DataFrame:
    places = w["dim_facility"].select("facility_id", F.col("latitude").alias("fac_lat"), F.col("longitude").alias("fac_lon"))
    return w["claims_events"].join(places, "facility_id", "left")


@query("j04_geo")
def _(w):
    return fraud.geo_score(_placed(w)).select("event_id", "geo_distance_deg", s.rounded("geo_score", 5).alias("geo_score"))


@query("j04_geo_haversine")
def _(w):
    km = fraud.haversine_km(F.col("latitude"), F.col("longitude"), F.col("fac_lat"), F.col("fac_lon"))
    return _placed(w).select("event_id", s.rounded(km, 3).alias("km"))


@query("j05_upcoding")
def _(w):
    return fraud.upcoding_score(w["claims_events"]).select("event_id", "procedure_code", "upcoding_score")


@query("j06_fraud_scores")
def _(w):
    scored = fraud.fraud_scores(w["claims_events"], w["dim_provider"], w["dim_facility"], fraud.provider_baseline(w["fact_claim"], w["dim_provider"]))
    return scored.withColumns({c: s.rounded(c, 5) for c in ("amount_score", "geo_score")})


@query("j07_fraud_summary")
def _(w):
    return fraud.fraud_summary(w["fraud_scores"])


@query("j07_fraud_top_providers")
def _(w):
    return fraud.fraud_top_providers(w["fraud_scores"], w["dim_provider"])


# --- care gaps and cost -----------------------------------------------------------------------------

@query("j08_care_gap_alerts")
def _(w):
    return caregaps.care_gap_alerts(w["adt_events"], w["care_gaps"], w["dim_patient"], w["dim_facility"], w["hedis_measures"])


@query("j09_care_gap_priority")
def _(w):
    bare = caregaps.care_gap_alerts(w["adt_events"], w["care_gaps"], w["dim_patient"], w["dim_facility"])
    return bare.select("alert_id", "measure_id", "measure_name", "gap_days_overdue", "alert_priority", "alert_text")


for _by in ("priority", "measure", "facility"):
    query(f"j10_care_gap_by_{_by}")(lambda w, by=_by: caregaps.care_gap_summary(w["care_gap_alerts"], by))


@query("j11_rolling_spend")
def _(w):
    return highcost.rolling_spend(w["claims_events"]).select("event_id", "patient_id", "rolling_spend_30d", "rolling_spend_90d", "claims_count_30d")


@query("j12_ed_visits")
def _(w):
    return highcost.ed_visits(w["adt_events"])


@query("j13_readmissions")
def _(w):
    return highcost.readmissions(w["adt_events"])


@query("j13_readmission_stream")
def _(w):
    again = _run(w, stateful.readmission_stream(_stream(w), DELAY), "readmissions")
    return again.groupBy("patient_id").agg(F.count(F.lit(1)).alias("readmission_count_30d"))


@query("j14_latest_spend")
def _(w):
    return highcost.latest_spend(w["claims_events"])


@query("j15_highcost_alerts")
def _(w):
    return highcost.highcost_alerts(w["claims_events"], w["adt_events"], w["dim_patient"], w["dim_facility"], w.now)


for _by in ("risk_tier", "cost_trend"):
    query(f"j16_highcost_by_{_by}")(lambda w, by=_by: highcost.highcost_summary(w["highcost_alerts"], by))


@query("j16_highcost_top")
def _(w):
    return highcost.highcost_top(w["highcost_alerts"])


# --- persona alerts --------------------------------------------------------------------------------------

_ALERTS = {
    "j17_readmission_alerts": lambda w: alerts.readmission_alerts(w["readmission_events"], w["dim_provider"]),
    "j18_quality_drift": lambda w: alerts.quality_drift(w["quality_metric_events"]),
    "j19_denial_spikes": lambda w: alerts.denial_spikes(w["denial_adjudication_events"], w.now, WEEK),
    "j19_denial_spikes_hour": lambda w: alerts.denial_spikes(w["denial_adjudication_events"], w.now, min_claims=1),
    "j20_high_dollar_denials": lambda w: alerts.high_dollar_denials(w["denial_adjudication_events"], w.now, WEEK),
    "j21_ar_breaches": lambda w: alerts.ar_breaches(w["ar_snapshot_events"]),
    "j22_auth_expiring": lambda w: alerts.auth_expiring(w["auth_lifecycle_events"]),
    "j23_capacity_alerts": lambda w: alerts.capacity_alerts(w["ops_capacity_events"], coo_limits(w), w.now, WEEK),
    "j23_capacity_alerts_hour": lambda w: alerts.capacity_alerts(w["ops_capacity_events"], coo_limits(w), w.now),
    "j24_staffing_alerts": lambda w: alerts.staffing_alerts(w["staffing_acuity_events"], coo_limits(w), w.now, WEEK),
    "j25_dq_alerts": lambda w: alerts.dq_alerts(w["dq_violation_events"], cto_limits(w), w.now, WEEK),
    "j26_phi_alerts": lambda w: alerts.phi_alerts(w["audit_access_events"], cto_limits(w), w.now, WEEK),
    "j27_drift_alerts": lambda w: alerts.drift_alerts(w["model_drift_events"], cto_limits(w), w.now, WEEK),
    "j29_provider_alerts": lambda w: w["provider_alerts"], "j29_payer_alerts": lambda w: w["payer_alerts"],
    "j29_coo_alerts": lambda w: w["coo_alerts"], "j29_cto_alerts": lambda w: w["cto_alerts"],
}
for _name, _build in _ALERTS.items():
    query(_name)(_build)


@query("j28_thresholds")
def _(w):
    limits = alerts.thresholds(w["dashboard_thresholds"], {**alerts.COO_DEFAULTS, **alerts.CTO_DEFAULTS, "unknown_key": (1.5, 2.5)})
    boarding = w["ops_capacity_events"].filter(F.col("capacity_type") == "ED_BOARDING")
    warn, crit = (limits.filter(F.col("threshold_key") == "ed_boarding_count").select(c).scalar() for c in ("warn", "crit"))
    counts = boarding.agg(F.count_if(F.col("current_value") >= warn).alias("over_warn"), F.count_if(F.col("current_value") >= crit).alias("over_crit"))
    here = F.col("threshold_key") == "ed_boarding_count"
    return limits.withColumns({c: F.when(here, counts.select(c).scalar()) for c in ("over_warn", "over_crit")})


# --- views over alerts --------------------------------------------------------------------------------------

@query("j30_all_alerts")
def _(w):
    return views.all_alerts(w, w.now)


@query("j19_denial_spells")
def _(w):
    return spells.denial_spells(w["denial_adjudication_events"], "event_timestamp", WEEK, "1 day")


@query("j19_denial_spike_stream")
def _(w):
    return _run(w, stateful.denial_spike_stream(_stream(w), DELAY, WEEK, "1 day"), "spikes")


@query("j31_patient_spells")
def _(w):
    signals = events.union_all([spells.signal_rows(w[t], t, "event_timestamp") for t in spells.SIGNALS])
    return spells.patient_spells(signals, "event_timestamp", tuple(spells.SIGNALS), WEEK, "1 day")


@query("j31_cross_patient_stream")
def _(w):
    return _run(w, stateful.cross_patient_stream(_stream(w), DELAY, WEEK, "1 day"), "patients")


def _signal_sets(w: Warehouse) -> DataFrame:
    return events.union_all([w[t].select("event_timestamp", "patient_id", F.lit(t).alias("source_table")) for t in spells.SIGNALS])


@query("l06_distinct_by_sketch")
def _(w):
    """Patients of each stream, and of all, over a week of days: out of stored sketches, held against the rows."""
    path, rows = _fresh(w, "sketches"), _signal_sets(w)
    files.save_table(sketches.by_day(rows, "event_timestamp", "patient_id", ["source_table"]), path, partition_by=[events.DAY])
    last = F.to_date(events.moment(w.now))
    week = files.read_table(w.spark, path).filter(F.col(events.DAY).between(F.date_sub(last, 6), last))
    exact = rows.filter(F.to_date("event_timestamp").between(F.date_sub(last, 6), last)).filter(F.col("patient_id").isNotNull())
    each = sketches.distinct(week, ["source_table"]).join(exact.groupBy("source_table").agg(F.count_distinct("patient_id").alias("patients")), "source_table")
    each = each.select("source_table", "patients", (F.abs(F.col("distinct_count") - F.col("patients")) <= sketches.allowed(F.col("patients"))).alias("within_bound"))
    streams = list(spells.SIGNALS)
    of_patient = exact.groupBy("patient_id").agg(F.count_distinct("source_table").alias("n"))
    counted = of_patient.agg(F.count_if(F.col("n") == len(streams)).alias("patients"), F.count(F.lit(1)).alias("everyone")).withColumn("source_table", F.lit("shared by all"))
    both = sketches.shared(week, "source_table", streams).withColumn("source_table", F.lit("shared by all")).join(counted, "source_table")
    both = both.select("source_table", "patients", (F.abs(F.col("shared_count") - F.col("patients")) <= sketches.allowed(F.col("patients"), F.col("everyone"))).alias("within_bound"))
    return each.unionByName(both)


@query("j31_cross_stream_patients")
def _(w):
    return views.cross_stream_patients(w["all_alerts"], w.now, WEEK)


@query("j32_provider_scorecard")
def _(w):
    return views.provider_scorecard(w["fraud_scores"], w["denial_adjudication_events"], w["readmission_events"], w.now)


@query("j33_alert_mttr")
def _(w):
    return views.alert_mttr(w["all_alerts"], w["alert_closure_events"])


@query("j34_mttr_summary")
def _(w):
    return views.mttr_summary(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)


@query("j35_tagged_events")
def _(w):
    return views.tagged_events(w, w.now)


@query("j36_alerts_enriched")
def _(w):
    return views.alerts_enriched(w["all_alerts"], w["dim_patient"], w["dim_provider"], w["dim_facility"], w.now, "30 days")


@query("j37_worklist")
def _(w):
    return views.worklist(w["worklist_alerts"])


@query("j37_worklist_alerts")
def _(w):
    return w["worklist_alerts"].join(views.worklist(w["worklist_alerts"]).select("patient_id"), "patient_id", "left_semi")


@query("j38_route_actions")
def _(w):
    return views.route_actions(w["worklist_alerts"], views.worklist(w["worklist_alerts"]))


@query("j39_sla_burndown")
def _(w):
    return views.sla_burndown(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)


@query("j40_stream_checks")
def _(w):
    return views.stream_checks(w, w["dim_patient"], w.now)


@query("j41_trigger_rules")
def _(w):
    fired = alerts.trigger_rules(w["fraud_scores"], w["care_gap_alerts"], w["highcost_alerts"], w["readmission_events"])
    tier = F.coalesce(F.get_json_object("card", "$.risk_tier"), F.get_json_object("card", "$.alert_priority"), F.get_json_object("card", "$.drg_code"))
    return fired.select("rule", "patient_id", "monitored_value", tier.alias("card_label"))


