"""Dashboard queries over event and alert tables.

Filters follow one rule: no value given means all rows. Facility names are matched
without regard to case; claims and scores reach a facility name through the admissions
seen there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import views
from wardlight.operators.aggregates import quantile
from wardlight.operators.events import TS, lookback, moment, tumbling
from wardlight.operators.fraud import money_of
from wardlight.operators.latest import latest_by

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Filters:
    """Time range, facility names and risk tiers of a dashboard."""

    start: str
    end: str
    facilities: tuple[str, ...] = ()
    tiers: tuple[str, ...] = ()


def _in_range(df: DataFrame, ts: str, f: Filters) -> DataFrame:
    return df.filter(F.col(ts).between(moment(f.start), moment(f.end)))


def _any_of(df: DataFrame, col: str, values: tuple[str, ...]) -> DataFrame:
    return df.filter(F.lower(F.col(col)).isin([v.lower() for v in values])) if values else df


def _at_facility(df: DataFrame, adt: DataFrame, f: Filters) -> DataFrame:
    """Rows of facilities whose name, as seen in admissions, is asked for."""
    if not f.facilities:
        return df
    ids = _any_of(adt, "facility_name", f.facilities).select("facility_id").distinct()
    return df.join(ids, "facility_id", "left_semi")


def _claims(t: Tables, f: Filters) -> DataFrame:
    return _at_facility(_in_range(t["claims_events"], TS, f), t["adt_events"], f)


def _adt(t: Tables, f: Filters) -> DataFrame:
    return _any_of(_in_range(t["adt_events"], TS, f), "facility_name", f.facilities)


def _fraud(t: Tables, f: Filters) -> DataFrame:
    rows = _at_facility(_in_range(t["fraud_scores"], "score_timestamp", f), t["adt_events"], f)
    return _any_of(rows, "risk_tier", f.tiers)


def _gaps(t: Tables, f: Filters) -> DataFrame:
    return _any_of(_any_of(_in_range(t["care_gap_alerts"], "alert_timestamp", f), "facility_name", f.facilities), "alert_priority", f.tiers)


def _costs(t: Tables, f: Filters) -> DataFrame:
    return _any_of(_any_of(_in_range(t["highcost_alerts"], "alert_timestamp", f), "risk_tier", f.tiers), "facility_name", f.facilities)


def _count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _hourly(df: DataFrame, ts: str, name: str) -> DataFrame:
    return tumbling(df, ts, "1 hour", aggs=[F.count(F.lit(1)).alias(name)])


# --- overview ----------------------------------------------------------------------------

def k01_event_counts(t: Tables, f: Filters) -> DataFrame:
    """Claims, admissions and fills in range."""
    claims, adt, rx = _claims(t, f), _adt(t, f), _in_range(t["rx_events"], TS, f)
    return _count(claims, "claims").withColumns({"adt": _count(adt).scalar(), "rx": _count(rx).scalar()})


def k02_volume_trend(t: Tables, f: Filters) -> DataFrame:
    """Claims, admissions and fills per hour; hours with only some of them stay."""
    parts = [_hourly(_in_range(t[f"{n}_events"], TS, f), TS, n) for n in ("claims", "adt", "rx")]
    return parts[0].join(parts[1], "bin", "full_outer").join(parts[2], "bin", "full_outer")


def k03_claims_by_type(t: Tables, f: Filters) -> DataFrame:
    return _by(_claims(t, f), "claim_type")


def k03_adt_by_type(t: Tables, f: Filters) -> DataFrame:
    return _by(_adt(t, f), "event_type")


def _facility_names(t: Tables) -> DataFrame:
    latest = latest_by(t["adt_events"], ["facility_id"], TS, "event_id")
    return latest.select("facility_id", F.col("facility_name").alias("facility"))


def _placed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def k04_claims_map(t: Tables, f: Filters) -> DataFrame:
    rows = _placed(_claims(t, f)).join(_facility_names(t), "facility_id", "left")
    return rows.groupBy("latitude", "longitude", "facility_id", "facility").agg(
        F.count(F.lit(1)).alias("claims"), s.rounded(s.ratio(money_of("claim_amount"), F.count("claim_amount")), 2).alias("avg_amount"))


def k04_fraud_map(t: Tables, f: Filters) -> DataFrame:
    rows = _placed(_fraud(t, f).filter(F.col("fraud_score") >= 50)).join(_facility_names(t), "facility_id", "left")
    return rows.groupBy("latitude", "longitude", "facility").agg(F.count(F.lit(1)).alias("alert_count"), s.rounded(F.avg("fraud_score"), 2).alias("avg_score"))


def k04_care_gap_map(t: Tables, f: Filters) -> DataFrame:
    rows = _placed(_gaps(t, f))
    return rows.groupBy("latitude", "longitude", F.col("facility_name").alias("facility")).agg(
        F.count(F.lit(1)).alias("gaps"), F.array_join(F.sort_array(F.collect_set("measure_name")), ", ").alias("measures"))


def _spend_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("patients"), s.rounded(s.ratio(money_of("rolling_spend_30d"), F.count("rolling_spend_30d")), 2).alias("avg_spend"),
                                 F.min("risk_tier").alias("risk_tier"))


def k04_highcost_map(t: Tables, f: Filters) -> DataFrame:
    rows = _placed(_costs(t, f)).filter(F.col("facility_name") != "")
    return _spend_by(rows, "latitude", "longitude", F.col("facility_name").alias("facility"))


def k05_fraud_total(t: Tables, f: Filters) -> DataFrame:
    return _count(_fraud(t, f).filter(F.col("fraud_score") >= 50))


def k05_fraud_buckets(t: Tables, f: Filters) -> DataFrame:
    x = F.col("fraud_score")
    bucket = F.when(x < 30, "Low (0-30)").when(x < 50, "Medium (30-50)").when(x < 70, "High (50-70)").otherwise("Critical (70+)")
    return _by(_fraud(t, f).withColumn("bucket", bucket), "bucket")


def k06_top_fraud(t: Tables, f: Filters) -> DataFrame:
    return _fraud(t, f).orderBy(F.col("fraud_score").desc(), "score_id").limit(10).select("patient_id", "claim_id", "fraud_score", "fraud_flags", "risk_tier", "score_timestamp")


def k06_top_spend(t: Tables, f: Filters) -> DataFrame:
    return _costs(t, f).orderBy(F.col("rolling_spend_30d").desc(), "patient_id").limit(10).select(
        "patient_id", "facility_name", "risk_tier", "rolling_spend_30d", "rolling_spend_90d", "cost_trend", "alert_timestamp")


def k07_fraud_trend(t: Tables, f: Filters) -> DataFrame:
    return _hourly(_fraud(t, f).filter(F.col("fraud_score") >= 50), "score_timestamp", "alerts")


def k07_care_gap_trend(t: Tables, f: Filters) -> DataFrame:
    return _hourly(_gaps(t, f), "alert_timestamp", "alerts")


def k07_highcost_trend(t: Tables, f: Filters) -> DataFrame:
    return _hourly(_costs(t, f), "alert_timestamp", "alerts")


def k08_fraud_by_flag(t: Tables, f: Filters) -> DataFrame:
    flags = _fraud(t, f).filter(F.col("fraud_score") >= 50).select(F.explode(F.split("fraud_flags", "[|]")).alias("flag"))
    return _by(flags, "flag").orderBy(F.col("n").desc(), "flag").limit(10)


def k09_gaps_by(t: Tables, f: Filters, col: str) -> DataFrame:
    return _by(_gaps(t, f), col)


def k09_cost_by_tier(t: Tables, f: Filters) -> DataFrame:
    return _by(_costs(t, f), "risk_tier")


def k09_cost_by_facility(t: Tables, f: Filters) -> DataFrame:
    return _spend_by(_costs(t, f), "facility_name")


def k10_mttr_stat(alerts: DataFrame, closures: DataFrame) -> DataFrame:
    """Totals, close rate and mean time over alerts."""
    timed = views.alert_mttr(alerts, closures)
    grouped = timed.agg(F.count(F.lit(1)).alias("total_alerts"), F.count_if(F.col("status") == "CLOSED").alias("closed"), F.count_if(F.col("status") == "OPEN").alias("open"),
                        s.rounded(F.avg("mttr_seconds"), 0).alias("avg_mttr_sec"))
    return grouped.withColumns({"avg_mttr_min": s.rounded(F.col("avg_mttr_sec") / 60.0, 1), "close_rate_pct": s.rounded(s.ratio(F.col("closed") * 100, F.col("total_alerts")), 1)})


# --- executive -----------------------------------------------------------------------------

def _recent(df: DataFrame, as_of: str, interval: str, ts: str = "alert_timestamp") -> DataFrame:
    return lookback(df, ts, as_of, interval)


def k11_open_criticals(alerts: DataFrame, as_of: str, interval: str) -> DataFrame:
    return _count(_recent(alerts, as_of, interval).filter(F.col("severity") == "CRITICAL"), "open_critical")


def k11_by_persona(alerts: DataFrame, as_of: str, interval: str) -> DataFrame:
    return _by(_recent(alerts, as_of, interval), "persona")


def k11_alert_velocity(alerts: DataFrame, as_of: str, interval: str) -> DataFrame:
    return tumbling(_recent(alerts, as_of, interval), "alert_timestamp", "5 minutes", ["severity"], [F.count(F.lit(1)).alias("alerts")])


def k11_inbox(alerts: DataFrame, as_of: str, interval: str, n: int = 50) -> DataFrame:
    rows = _recent(alerts, as_of, interval).orderBy(F.col("alert_timestamp").desc(), "alert_id").limit(n)
    return rows.select("alert_id", "alert_timestamp", "persona", "severity", "alert_type", "alert_text", "recommended_action")


def k12_mttr_table(alerts: DataFrame, closures: DataFrame, as_of: str, interval: str) -> DataFrame:
    return views.mttr_summary(alerts, closures, as_of, interval).select("persona", "alert_type", "p50_close_minutes", "p90_close_minutes", "open_count", "resolved_count")


# --- clinical --------------------------------------------------------------------------------

def k13_deterioration(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    latest = latest_by(lookback(events, TS, as_of, interval), ["patient_id"], TS, "event_id")
    rows = latest.filter((F.col("news2_score") >= 5) | (F.col("sirs_score") >= 2) | (F.col("mews_score") >= 4))
    return rows.select(TS, "facility_id", "ward", "patient_id", "deterioration_type", "news2_score", "sirs_score", "mews_score", "requires_rrt")


def k13_ward_heatmap(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    return tumbling(lookback(events, TS, as_of, interval).filter(F.col("news2_score") >= 5), TS, "1 hour", ["ward"], [F.count(F.lit(1)).alias("cases")])


def k14_hai_clusters(events: DataFrame, as_of: str, interval: str = "72 hours") -> DataFrame:
    grouped = lookback(events, TS, as_of, interval).groupBy("facility_id", "ward", "hai_type", "organism").agg(
        F.max("cluster_size").alias("cluster"), F.sum("infection_count_72h").alias("infections"), F.max(TS).alias("last_seen"))
    return grouped.filter(F.col("cluster") >= 2)


def k15_readmissions(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    days = F.col("days_since_discharge")
    band = F.when(days <= 7, "≤7 days").when(days <= 14, "≤14 days").otherwise("≤30 days")
    return tumbling(lookback(events, TS, as_of, interval).withColumn("band", band), TS, "1 hour", ["band"], [F.count(F.lit(1)).alias("n")])


def k15_drift_watchlist(alerts: DataFrame, as_of: str, interval: str) -> DataFrame:
    rows = _recent(alerts, as_of, interval).filter(F.col("alert_type") == "QUALITY_DRIFT")
    return rows.select("alert_timestamp", "provider_name", "metric_name", "metric_value", "benchmark_value", "severity")


# --- revenue ---------------------------------------------------------------------------------

def k16_revenue_variance(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    return lookback(events, TS, as_of, interval).groupBy("contract_type").agg(money_of("variance_dollars").alias("total_variance"), s.rounded(F.avg("variance_pct"), 6).alias("avg_pct"))


def k16_underpayments(events: DataFrame, as_of: str, interval: str, n: int = 50) -> DataFrame:
    rows = lookback(events, TS, as_of, interval).filter(F.col("variance_pct") < -5).orderBy("variance_dollars", "event_id").limit(n)
    return rows.select(TS, "payer_name", "contract_id", "contract_type", "expected_payment", "actual_payment", "variance_pct", "variance_dollars")


def k16_fraud_heatmap(scores: DataFrame, as_of: str, interval: str, limit: float = 15.0) -> DataFrame:
    grouped = lookback(scores, "score_timestamp", as_of, interval).groupBy("provider_id").agg(F.max("fraud_score").alias("max_score"), F.count(F.lit(1)).alias("cases"))
    return grouped.filter(F.col("max_score") > limit)


def k16_highcost_watchlist(alerts: DataFrame, as_of: str, n: int = 25) -> DataFrame:
    rows = _recent(alerts, as_of, "7 days").orderBy(F.col("rolling_spend_30d").desc(), "patient_id").limit(n)
    return rows.select("alert_timestamp", "patient_id", "rolling_spend_30d", "rolling_spend_90d", "cost_trend", "risk_tier")


def k16_gap_volume(alerts: DataFrame, as_of: str, interval: str) -> DataFrame:
    return _recent(alerts, as_of, interval).groupBy("measure_id", "alert_priority").agg(F.count(F.lit(1)).alias("n"))


# --- operations ---------------------------------------------------------------------------------

def _capacity(events: DataFrame, kind: str, as_of: str, interval: str) -> DataFrame:
    return lookback(events.filter(F.col("capacity_type") == kind), TS, as_of, interval)


def k17_ed_boarding(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    latest = latest_by(_capacity(events, "ED_BOARDING", as_of, interval), ["facility_id"], TS, "event_id")
    return latest.select(TS, "facility_id", "current_value", "threshold_value", "utilization_pct")


def k17_bed_occupancy(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    return latest_by(_capacity(events, "BED_OCCUPANCY", as_of, interval), ["facility_id"], TS, "event_id").select("facility_id", "utilization_pct")


def k17_or_turnover(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    return tumbling(_capacity(events, "OR_TURNOVER", as_of, interval), TS, "30 minutes", aggs=[quantile("current_value", 0.5).alias("p50"), quantile("current_value", 0.9).alias("p90")])


def k17_staffing_gap(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    latest = latest_by(lookback(events, TS, as_of, interval), ["facility_id", "ward"], TS, "event_id").filter(F.col("staffing_gap") >= 1)
    return latest.select("facility_id", "ward", "nurse_count", "patient_count", "acuity_score", "ratio_actual", "ratio_target", "staffing_gap")


def k17_los_outliers(events: DataFrame, as_of: str, interval: str, n: int = 25) -> DataFrame:
    """Stays above seven days, latest reading per facility and ward."""
    long = _capacity(events, "LOS_HOURS", as_of, interval).filter(F.col("current_value") > 168)
    latest = latest_by(long, ["facility_id", "ward"], TS, "event_id")
    return latest.select("facility_id", "ward", F.col("current_value").alias("los_hours")).orderBy(F.col("los_hours").desc(), "facility_id", "ward").limit(n)


def feed(alerts: DataFrame, as_of: str, interval: str, columns: list[str], n: int = 30) -> DataFrame:
    """Latest alerts of one persona."""
    rows = _recent(alerts, as_of, interval).orderBy(F.col("alert_timestamp").desc(), "alert_id").limit(n)
    return rows.select("alert_id", "alert_timestamp", "severity", "alert_type", *columns, "alert_text", "recommended_action")


# --- platform --------------------------------------------------------------------------------------

def k18_dq_by_source(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    return lookback(events, TS, as_of, interval).groupBy("source_table", "rule_type").agg(F.sum("violation_count").alias("violations"), F.max("violation_pct").alias("max_pct"))


def k18_phi_map(events: DataFrame, as_of: str, interval: str, n: int = 50) -> DataFrame:
    rows = lookback(events, TS, as_of, interval).filter(F.col("anomaly_score") > 0.6).orderBy(F.col("anomaly_score").desc(), "event_id").limit(n)
    return rows.select(TS, "user_principal", "action_type", "resource_accessed", "geo_country", "anomaly_score")


def k18_model_drift(events: DataFrame, as_of: str, interval: str) -> DataFrame:
    latest = latest_by(lookback(events, TS, as_of, interval), ["model_name", "feature_name"], TS, "event_id").filter(F.col("psi_value") >= 0.1)
    return latest.select("model_name", "model_version", "feature_name", "psi_value", "ks_value", "drift_score", "severity")


# --- inbox --------------------------------------------------------------------------------------------

def k19_open_alerts(alerts: DataFrame, closures: DataFrame, as_of: str, interval: str) -> DataFrame:
    """Alerts without a resolution."""
    resolved = closures.filter(F.col("action_taken") == "RESOLVED").select("alert_id")
    rows = _recent(alerts, as_of, interval).join(resolved, "alert_id", "left_anti")
    return rows.select("alert_id", "alert_timestamp", "persona", "severity", "alert_type", "alert_text", "recommended_action")


def k19_mttr_heatmap(alerts: DataFrame, closures: DataFrame, as_of: str, interval: str) -> DataFrame:
    return views.mttr_summary(alerts, closures, as_of, interval).select("persona", "alert_type", "p50_close_minutes", "p90_close_minutes")
