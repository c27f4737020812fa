"""Views over all alerts: one shape, cross-stream patients, scorecards, closure times, worklist."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import reference_data as ref
from wardlight.functions import scalars as s
from wardlight.operators.aggregates import quantile, severity_rank
from wardlight.operators.events import TS, lookback, tagged_union, tumbling, union_all
from wardlight.operators.scores import tier

Tables = Mapping[str, DataFrame]
VIEW_COLUMNS = ["alert_id", "alert_timestamp", "source_table", "alert_type", "patient_id", "provider_id", "facility_id", "severity", "score", "alert_text"]
PERSONAS = {"provider_alerts": "CMO", "payer_alerts": "CFO", "coo_alerts": "COO", "cto_alerts": "CTO"}


def _whole(col: str) -> Column:
    return F.col(col).cast("bigint").cast("string")


def _shape(df: DataFrame, source: str, kind: str, **cols: Column | str) -> DataFrame:
    values = {"provider_id": F.lit(""), "facility_id": F.lit(""), "alert_id": F.col("alert_id") if "alert_id" in df.columns else F.lit(None),
              "alert_timestamp": F.col("alert_timestamp") if "alert_timestamp" in df.columns else F.lit(None), "patient_id": F.col("patient_id")}
    values |= {"source_table": F.lit(source), "alert_type": F.lit(kind)} | {k: F.col(v) if isinstance(v, str) else v for k, v in cols.items()}
    values["score"] = values["score"].cast("double")
    return df.select(*[values[c].alias(c) for c in VIEW_COLUMNS])


def all_alerts(tables: Tables, as_of: str, interval: str = "7 days") -> DataFrame:
    """Fraud, care gap, high cost, readmission and deterioration alerts in one shape."""

    def recent(name: str, ts: str) -> DataFrame:
        return lookback(tables[name], ts, as_of, interval, inclusive=True)

    risk, days, news = F.col("readmission_risk_score"), F.col("days_since_discharge"), F.col("news2_score")
    return union_all([
        _shape(recent("fraud_scores", "score_timestamp").filter(F.col("fraud_score") >= 50), "fraud_scores", "FRAUD", alert_id="score_id", alert_timestamp="score_timestamp",
               provider_id="provider_id", facility_id="facility_id", severity="risk_tier", score="fraud_score",
               alert_text=s.text_of("Fraud ", _whole("fraud_score"), "/100 flags=", F.col("fraud_flags"))),
        _shape(recent("care_gap_alerts", "alert_timestamp").filter(F.col("gap_days_overdue") > 90), "care_gap_alerts", "CARE_GAP", facility_id="facility_id",
               severity="alert_priority", score="gap_days_overdue", alert_text="alert_text"),
        _shape(recent("highcost_alerts", "alert_timestamp"), "highcost_alerts", "HIGH_COST", severity="risk_tier", score="rolling_spend_30d",
               alert_text=s.text_of("Spend30d $", _whole("rolling_spend_30d"), " ED=", F.col("ed_visits_30d"))),
        _shape(recent("readmission_events", TS).filter((risk >= 70) | ((days <= 7) & (risk >= 50))), "readmission_events", "READMISSION", alert_id="event_id", alert_timestamp=TS,
               provider_id="provider_id", facility_id="facility_id", severity=tier(risk, (80, "CRITICAL"), (70, "HIGH"), otherwise="MEDIUM"), score="readmission_risk_score",
               alert_text=s.text_of("Readmit ", days, "d DRG=", F.col("drg_code"), " risk=", _whole("readmission_risk_score"))),
        _shape(recent("clinical_deterioration_events", TS).filter(news >= 5), "clinical_deterioration_events", "DETERIORATION", alert_id="event_id", alert_timestamp=TS,
               facility_id="facility_id", severity=tier(news, (7, "CRITICAL"), otherwise="HIGH"), score="news2_score",
               alert_text=s.text_of(F.col("deterioration_type"), " NEWS2=", news, " ward=", F.col("ward"))),
    ])


def cross_stream_patients(alerts: DataFrame, as_of: str, interval: str = "1 day") -> DataFrame:
    """Patients with alerts of at least two streams."""
    grouped = lookback(alerts, "alert_timestamp", as_of, interval, inclusive=True).groupBy("patient_id").agg(
        F.countDistinct("source_table").alias("stream_count"), F.array_join(F.sort_array(F.collect_set("source_table")), ", ").alias("streams"),
        F.count(F.lit(1)).alias("total_alerts"), F.max("score").alias("max_score"), F.max("alert_timestamp").alias("last_alert"), F.min("alert_text").alias("sample_text"))
    found = grouped.filter(F.col("stream_count") >= 2)
    return found.withColumn("severity_rank", tier(F.col("stream_count"), (3, "CRITICAL"), otherwise="HIGH"))


def provider_scorecard(fraud: DataFrame, denials: DataFrame, readmits: DataFrame, as_of: str, interval: str = "7 days") -> DataFrame:
    """Fraud, denial and readmission figures per clinician and their weighted sum."""

    def recent(df: DataFrame, ts: str) -> DataFrame:
        return lookback(df, ts, as_of, interval, inclusive=True).filter(F.col("provider_id") != "")

    f, d, r = recent(fraud, "score_timestamp"), recent(denials, TS), recent(readmits, TS)
    fraud_agg = f.groupBy("provider_id").agg(s.rounded(quantile("fraud_score", 0.95), 1).alias("fraud_score_p95"), F.count_if(F.col("fraud_score") >= 50).alias("fraud_alerts"))
    denial_agg = d.groupBy("provider_id").agg(F.count(F.lit(1)).alias("total_claims"), F.count_if(F.col("adjudication_result") == "DENIED").alias("denied_claims"))
    denial_agg = denial_agg.withColumn("denial_rate_pct", s.rounded(s.ratio(F.col("denied_claims") * 100, F.col("total_claims")), 1))
    readmit_agg = r.groupBy("provider_id").agg(F.count(F.lit(1)).alias("readmit_count"))
    joined = fraud_agg.join(denial_agg, "provider_id", "full_outer").join(readmit_agg, "provider_id", "full_outer")
    filled = joined.fillna({"fraud_score_p95": 0.0, "fraud_alerts": 0, "total_claims": 0, "denied_claims": 0, "denial_rate_pct": 0.0, "readmit_count": 0})
    total = F.col("fraud_score_p95") * 0.4 + F.col("denial_rate_pct") * 2.0 + F.col("readmit_count") * 5.0
    return filled.withColumn("composite_risk", s.rounded(total, 1))


def alert_mttr(alerts: DataFrame, closures: DataFrame) -> DataFrame:
    """Each alert with its first closure, the seconds until then, and its status."""
    first = closures.groupBy("alert_id").agg(F.min_by(F.struct("closure_timestamp", "resolved_by", "action_taken"), F.struct("closure_timestamp", "closure_id")).alias("c"))
    closed = F.col("c.closure_timestamp")
    return alerts.join(first, "alert_id", "left").select(
        "alert_id", "alert_timestamp", "source_table", "alert_type", "patient_id", "severity", "score", "alert_text", closed.alias("closure_timestamp"),
        F.col("c.resolved_by").alias("resolved_by"), F.col("c.action_taken").alias("action_taken"),
        F.when(closed.isNotNull(), F.timestamp_diff("SECOND", F.col("alert_timestamp"), closed)).otherwise(F.lit(0)).alias("mttr_seconds"),
        F.when(closed.isNotNull(), "CLOSED").otherwise("OPEN").alias("status"))


def persona_alerts(tables: Tables) -> DataFrame:
    """Alerts of the four personas with the columns they share."""
    shared = ["alert_id", "alert_timestamp", "alert_type", "severity", "alert_text", "recommended_action"]
    return tagged_union({p: tables[t] for t, p in PERSONAS.items()}, shared, "persona")


def closure_times(closures: DataFrame) -> DataFrame:
    """First acknowledgement and first resolution per alert."""
    at = F.col("closure_timestamp")
    return closures.groupBy("alert_id").agg(F.min(F.when(F.col("action_taken") == "ACKNOWLEDGED", at)).alias("ack_time"),
                                            F.min(F.when(F.col("action_taken") == "RESOLVED", at)).alias("close_time"))


def mttr_summary(alerts: DataFrame, closures: DataFrame, as_of: str, interval: str = "1 day") -> DataFrame:
    """Open, acknowledged and resolved alerts per persona and type, with minutes taken."""
    times = closure_times(lookback(closures, "closure_timestamp", as_of, interval))
    rows = lookback(alerts, "alert_timestamp", as_of, interval).join(times, "alert_id", "left")
    ack, close = s.minutes_between(F.col("ack_time"), F.col("alert_timestamp")), s.minutes_between(F.col("close_time"), F.col("alert_timestamp"))
    status = F.when(F.col("close_time").isNotNull(), "RESOLVED").when(F.col("ack_time").isNotNull(), "ACKNOWLEDGED").otherwise("OPEN")
    rows = rows.select("persona", "alert_type", ack.alias("_ack"), close.alias("_close"), status.alias("_status"))
    return rows.groupBy("persona", "alert_type").agg(
        F.count_if(F.col("_status") == "OPEN").alias("open_count"), F.count_if(F.col("_status") == "ACKNOWLEDGED").alias("ack_count"),
        F.count_if(F.col("_status") == "RESOLVED").alias("resolved_count"), quantile("_ack", 0.5).alias("p50_ack_minutes"), quantile("_ack", 0.9).alias("p90_ack_minutes"),
        quantile("_close", 0.5).alias("p50_close_minutes"), quantile("_close", 0.9).alias("p90_close_minutes"), s.rounded(F.avg("_close"), 6).alias("avg_close_minutes"))


def tagged_events(tables: Tables, as_of: str, interval: str = "7 days") -> DataFrame:
    """Rows planted for a scenario, found by the prefix of their tag."""

    def rows(name: str, ts: str, label: str, prefix: str, detail: Column, provider: bool, facility: bool, patient: bool = True) -> DataFrame:
        recent = lookback(tables[name], ts, as_of, interval, inclusive=True).filter(F.col(label).startswith(prefix))
        pick = lambda c, there: F.col(c) if there else F.lit("")
        return recent.select(F.col(ts).alias("alert_timestamp"), F.lit(name).alias("source"), F.col(label).alias("seed_label"), pick("patient_id", patient).alias("patient_id"),
                             pick("provider_id", provider).alias("provider_id"), pick("facility_id", facility).alias("facility_id"), detail.alias("detail"))

    spend = s.text_of("Spend30d $", _whole("rolling_spend_30d"), " ED=", F.col("ed_visits_30d"))
    return union_all([
        rows("claims_events", TS, "injected_fraud_flags", "SEED:", s.text_of("Claim $", _whole("claim_amount"), " ", F.col("procedure_code")), True, True),
        rows("readmission_events", TS, "current_encounter_id", "SEED-", s.text_of("Readmit ", F.col("days_since_discharge"), "d DRG=", F.col("drg_code")), True, True),
        rows("care_gap_alerts", "alert_timestamp", "alert_id", "SEED-", F.col("alert_text"), False, True),
        rows("highcost_alerts", "alert_timestamp", "alert_id", "SEED-", spend, False, False),
        rows("ops_capacity_events", TS, "event_type", "SEED_", s.text_of(F.col("capacity_type"), " = ", F.col("current_value"), " / ", F.col("threshold_value")), False, True, patient=False),
    ])


def alerts_enriched(alerts: DataFrame, patients: DataFrame, providers: DataFrame, facilities: DataFrame, as_of: str, interval: str = "7 days") -> DataFrame:
    """Alerts with names and attributes of patient, clinician and facility."""
    current = F.col("is_current") == 1
    people = patients.filter(current).select("patient_id", F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
                                             F.col("date_of_birth").alias("patient_dob"), F.col("gender").alias("patient_gender"))
    clinicians = providers.filter(current).select("provider_id", F.col("display_name").alias("provider_name"), F.col("specialty").alias("provider_specialty"),
                                                  F.col("npi_number").alias("provider_npi"), F.col("facility_id").alias("provider_home_facility"))
    places = facilities.select("facility_id", "facility_name", F.col("latitude").alias("facility_lat"), F.col("longitude").alias("facility_lon"))
    recent = lookback(alerts, "alert_timestamp", as_of, interval, inclusive=True)
    return recent.join(people, "patient_id", "left").join(clinicians, "provider_id", "left").join(places, "facility_id", "left")


# --- worklist ---------------------------------------------------------------------------------------------

def worklist_alerts(fraud: DataFrame, gaps: DataFrame, costs: DataFrame, as_of: str, interval: str = "1 day") -> DataFrame:
    """Alerts of the three scorers as one list with priority and detail."""

    def rows(df: DataFrame, ts: str, kind: str, id: str, rank: str, detail: Column) -> DataFrame:
        recent = lookback(df, ts, as_of, interval)
        return recent.select("patient_id", F.lit(kind).alias("alert_type"), F.col(id).alias("alert_id"), severity_rank(F.col(rank)).alias("priority"),
                             F.col(rank).alias("risk_tier"), detail.alias("detail"), F.col(ts).alias("alert_time"))

    return union_all([
        rows(fraud, "score_timestamp", "FRAUD", "score_id", "risk_tier", s.text_of("Fraud score: ", F.col("fraud_score"), " | Flags: ", F.col("fraud_flags"))),
        rows(gaps, "alert_timestamp", "CARE_GAP", "alert_id", "alert_priority", s.text_of("Gap: ", F.col("measure_name"), " | Overdue: ", F.col("gap_days_overdue"), "d")),
        rows(costs, "alert_timestamp", "HIGH_COST", "alert_id", "risk_tier",
             s.text_of("30d spend: $", F.col("rolling_spend_30d"), " | ED visits: ", F.col("ed_visits_30d"), " | Trend: ", F.col("cost_trend"))),
    ])


def worklist(alerts: DataFrame, n: int = 100) -> DataFrame:
    """Patients by most urgent alert, then by number of alerts.

    The alerts themselves stay rows of ``worklist_alerts``: a patient may have any
    number of them. Types are a set of at most three.
    """
    grouped = alerts.groupBy("patient_id").agg(F.array_join(F.sort_array(F.collect_set("alert_type")), ",").alias("alert_types"),
                                               F.min("priority").alias("max_priority"), F.count(F.lit(1)).alias("alert_count"))
    return grouped.orderBy("max_priority", F.col("alert_count").desc(), "patient_id").limit(n)


def route_actions(alerts: DataFrame, top: DataFrame) -> DataFrame:
    """Where each critical alert of the listed patients goes."""
    spark = alerts.sparkSession
    routes = spark.createDataFrame(ref.ACTION_ROUTES, "alert_type string, action_type string, destination string")
    urgent = alerts.filter(F.col("risk_tier") == "CRITICAL").join(top.filter(F.col("max_priority") == 1).select("patient_id"), "patient_id", "left_semi")
    action, place = ref.DEFAULT_ROUTE
    return urgent.join(routes, "alert_type", "left").select(
        s.content_id("ACTION", F.col("alert_id")).alias("action_id"), "alert_type", "alert_id", "patient_id", F.coalesce("action_type", F.lit(action)).alias("action_type"),
        F.coalesce("destination", F.lit(place)).alias("destination"), F.lit("ROUTED").alias("status"), "detail")


def sla_burndown(alerts: DataFrame, closures: DataFrame, as_of: str, interval: str = "1 day") -> DataFrame:
    """Open and resolved alerts per quarter of an hour in which they were raised."""
    rows = lookback(alerts, "alert_timestamp", as_of, interval).join(closure_times(closures), "alert_id", "left")
    done = F.col("close_time").isNotNull()
    return tumbling(rows, "alert_timestamp", "15 minutes", aggs=[F.count_if(~done).alias("open"), F.count_if(done).alias("resolved")])


def stream_checks(tables: Tables, patients: DataFrame, as_of: str) -> DataFrame:
    """Readiness checks as (check_id, value, ok)."""

    def check(id: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.cast("bigint").alias("value")).select(F.lit(id).alias("check_id"), "value", (F.col("value") > 0).alias("ok"))

    def recent(name: str, ts: str, interval: str) -> DataFrame:
        return lookback(tables[name], ts, as_of, interval, inclusive=True)

    n = F.count(F.lit(1))
    kinds = recent("adt_events", TS, "1 day").agg(F.count_if(F.col("event_type") == "ADMIT").alias("a"), F.count_if(F.col("event_type") == "DISCHARGE").alias("d"))
    ids = recent("claims_events", TS, "1 day").select("patient_id").distinct().join(patients.select("patient_id").distinct(), "patient_id")
    return union_all([
        check("claims_fresh", recent("claims_events", TS, "5 minutes"), n), check("adt_fresh", recent("adt_events", TS, "5 minutes"), n),
        check("rx_fresh", recent("rx_events", TS, "5 minutes"), n), check("fraud_scored", recent("fraud_scores", "score_timestamp", "30 minutes"), n),
        check("fraud_coverage", recent("fraud_scores", "score_timestamp", "1 hour"), F.count_if(F.col("fraud_score") >= 50)),
        check("readmissions_landed", recent("readmission_events", TS, "1 hour"), n), check("adt_kinds", kinds, F.least(F.max("a"), F.max("d"))), check("patient_overlap", ids, n),
    ])
