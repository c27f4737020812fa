"""Queries for the dashboard and for graph patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlight.operators import events, graph, tiles
from wardlight.plans.registry import query
from wardlight.plans.warehouse import WEEK

ALL = tiles.Filters("2024-01-01 00:00:00", "2024-01-31 00:00:00")
SOME = tiles.Filters("2024-01-10 00:00:00", "2024-01-31 00:00:00", ("nation 3 hospital", "NATION 7 Hospital", "NATION 12 HOSPITAL"), ("critical", "HIGH"))

for _name in ("k01_event_counts", "k02_volume_trend", "k03_claims_by_type", "k03_adt_by_type", "k04_claims_map", "k04_fraud_map", "k04_care_gap_map", "k04_highcost_map", "k05_fraud_total",
              "k05_fraud_buckets", "k06_top_fraud", "k06_top_spend", "k07_fraud_trend", "k07_care_gap_trend", "k07_highcost_trend", "k08_fraud_by_flag", "k09_cost_by_tier", "k09_cost_by_facility"):
    query(_name)(lambda w, fn=getattr(tiles, _name): fn(w, ALL))
for _name in ("k01_event_counts", "k03_claims_by_type", "k05_fraud_buckets", "k07_care_gap_trend"):
    query(f"{_name}_filtered")(lambda w, fn=getattr(tiles, _name): fn(w, SOME))
for _col in ("measure_name", "alert_priority"):
    query(f"k09_gaps_by_{_col}")(lambda w, col=_col: tiles.k09_gaps_by(w, ALL, col))

_PERSONA = {"k11_open_criticals": tiles.k11_open_criticals, "k11_by_persona": tiles.k11_by_persona, "k11_alert_velocity": tiles.k11_alert_velocity, "k11_inbox": tiles.k11_inbox}
for _name, _fn in _PERSONA.items():
    query(_name)(lambda w, fn=_fn: fn(w["persona_alerts"], w.now, WEEK))

_EVENTS = {
    "k13_deterioration": (tiles.k13_deterioration, "clinical_deterioration_events"), "k13_ward_heatmap": (tiles.k13_ward_heatmap, "clinical_deterioration_events"),
    "k14_hai_clusters": (tiles.k14_hai_clusters, "mortality_hai_events"), "k15_readmissions": (tiles.k15_readmissions, "readmission_events"), "k15_drift_watchlist": (tiles.k15_drift_watchlist, "provider_alerts"),
    "k16_revenue_variance": (tiles.k16_revenue_variance, "net_revenue_variance_events"), "k16_underpayments": (tiles.k16_underpayments, "net_revenue_variance_events"),
    "k16_fraud_heatmap": (tiles.k16_fraud_heatmap, "fraud_scores"), "k16_gap_volume": (tiles.k16_gap_volume, "care_gap_alerts"),
    "k17_ed_boarding": (tiles.k17_ed_boarding, "ops_capacity_events"), "k17_bed_occupancy": (tiles.k17_bed_occupancy, "ops_capacity_events"), "k17_or_turnover": (tiles.k17_or_turnover, "ops_capacity_events"),
    "k17_staffing_gap": (tiles.k17_staffing_gap, "staffing_acuity_events"), "k17_los_outliers": (tiles.k17_los_outliers, "ops_capacity_events"),
    "k18_dq_by_source": (tiles.k18_dq_by_source, "dq_violation_events"), "k18_phi_map": (tiles.k18_phi_map, "audit_access_events"), "k18_model_drift": (tiles.k18_model_drift, "model_drift_events"),
}
for _name, (_fn, _table) in _EVENTS.items():
    query(_name)(lambda w, fn=_fn, table=_table: fn(w[table], w.now, WEEK))


@query("k10_mttr_stat")
def _(w):
    return tiles.k10_mttr_stat(w["all_alerts"], w["alert_closure_events"])


@query("k12_mttr_table")
def _(w):
    return tiles.k12_mttr_table(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)


@query("k12_throughput")
def _(w):
    return events.throughput(w["landing_parsed"], w.now, "2 hours").withColumnRenamed("_table", "tag")


@query("k16_highcost_watchlist")
def _(w):
    return tiles.k16_highcost_watchlist(w["highcost_alerts"], w.now)


@query("k17_coo_feed")
def _(w):
    return tiles.feed(w["coo_alerts"], w.now, WEEK, ["ward"])


@query("k18_cto_feed")
def _(w):
    return tiles.feed(w["cto_alerts"], w.now, WEEK, ["source_system"])


@query("k18_ingest_lag")
def _(w):
    return events.ingest_lag_by_minute(w["landing_parsed"], w.now, "2 hours").withColumnRenamed("_table", "tag")


@query("k19_open_alerts")
def _(w):
    return tiles.k19_open_alerts(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)


@query("k19_mttr_heatmap")
def _(w):
    return tiles.k19_mttr_heatmap(w["persona_alerts"], w["alert_closure_events"], w.now, WEEK)


# --- graph ---------------------------------------------------------------------------------

for _edge in graph.EDGES:
    query(f"n01_edge_{_edge}")(lambda w, e=_edge: graph.edge(w, e))
for _table in ("agg_days_in_ar", "agg_appeal_outcomes"):
    query(f"n02_payer_edge_{_table}")(lambda w, t=_table: graph.payer_name_edge(w, t))

ONE_PROVIDER, ONE_PATIENT = "PRV000000000003", "PAT000000000007"


@query("n03_graph_counts")
def _(w):
    return graph.node_counts(w).unionByName(graph.edge_counts(w))


for _fact, _label in (("fact_encounter", "encounters"), ("fact_claim", "claims"), ("fact_prescription", "prescriptions")):
    query(f"n04_provider_{_label}")(lambda w, f=_fact, n=_label: graph.per_provider(w, f, n))


@query("n05_denied_claims")
def _(w):
    return graph.denied_claims(w)


@query("n06_patient_panel")
def _(w):
    return graph.patient_panel(w, ONE_PROVIDER)


@query("n06_prescribing")
def _(w):
    return graph.prescribing(w, "Internal Medicine")


@query("n06_prescribing_via_encounter")
def _(w):
    return graph.prescribing_via_encounter(w, "Internal Medicine")


@query("n07_high_risk_patients")
def _(w):
    return graph.high_risk_patients(w)


@query("n07_vulnerable_communities")
def _(w):
    return graph.vulnerable_communities(w, F.col("social_vulnerability_index") > 0.2)


@query("n08_adherence_candidates")
def _(w):
    return graph.adherence_candidates(w, "First7", "Last7")


@query("n08_adherence_of_patient")
def _(w):
    return graph.adherence_of(w, ONE_PATIENT)


@query("n09_non_adherent_ranking")
def _(w):
    return graph.non_adherent_ranking(w)


@query("n10_readmission_by_payer")
def _(w):
    return graph.readmission_by_payer(w)


@query("n11_provider_profile")
def _(w):
    return graph.profile_counts(w, ONE_PROVIDER)


@query("n12_provider_payer_network")
def _(w):
    return graph.provider_payer_network(w)


@query("n13_edge_coverage")
def _(w):
    return graph.edge_coverage(w)
