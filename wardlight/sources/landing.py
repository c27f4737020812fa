"""Event landing: one wide row per JSON message, routed to typed tables.

The functions take and give DataFrames and hold for batch and streaming input alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.operators.latest import dedup_latest

# Column lists of the typed event tables: "name:type". Types are those of the tables,
# ``real`` is a double, ``datetime`` a timestamp. A ``!`` marks columns without a default.
# --- fixed values: event table columns ---
_HEAD = "event_id:string! event_timestamp:datetime! event_type:string! "
EVENT_TABLES: dict[str, str] = {
    "claims_events": _HEAD + "claim_id:string patient_id:string! provider_id:string facility_id:string payer_id:string diagnosis_code:string procedure_code:string claim_type:string claim_amount:real latitude:real! longitude:real! injected_fraud_flags:string",
    "adt_events": _HEAD + "patient_id:string! facility_id:string facility_name:string admission_type:string primary_diagnosis:string latitude:real! longitude:real! has_open_care_gaps:bool open_gap_measures:string",
    "rx_events": _HEAD + "patient_id:string! provider_id:string medication_code:string medication_name:string drug_class:string quantity:int days_supply:int latitude:real! longitude:real!",
    "readmission_events": _HEAD + "patient_id:string! provider_id:string facility_id:string current_encounter_id:string prior_discharge_date:datetime! days_since_discharge:int current_diagnosis:string prior_diagnosis:string readmission_risk_score:real drg_code:string latitude:real! longitude:real!",
    "quality_metric_events": _HEAD + "provider_id:string provider_name:string specialty:string facility_id:string metric_name:string metric_value:real benchmark_value:real direction:string rolling_window_days:int denominator:int numerator:int",
    "denial_adjudication_events": _HEAD + "claim_id:string patient_id:string! provider_id:string payer_id:string payer_name:string adjudication_result:string denial_reason:string billed_amount:real allowed_amount:real paid_amount:real is_preventable:bool recommended_action:string",
    "ar_snapshot_events": _HEAD + "payer_id:string payer_name:string open_claims_count:int total_ar_balance:real avg_days_in_ar:real claims_over_45_days:int claims_over_90_days:int net_collection_rate:real prior_period_avg_days:real trend_direction:string",
    "auth_lifecycle_events": _HEAD + "auth_id:string patient_id:string! provider_id:string payer_id:string payer_name:string procedure_code:string procedure_description:string auth_status:string auth_expiry_date:string days_until_expiry:int scheduled_procedure_date:string estimated_charge:real",
    "clinical_deterioration_events": _HEAD + "patient_id:string! encounter_id:string facility_id:string ward:string news2_score:real sirs_score:real mews_score:real deterioration_type:string requires_rrt:bool primary_diagnosis:string latitude:real! longitude:real!",
    "mortality_hai_events": _HEAD + "facility_id:string ward:string hai_type:string organism:string cluster_size:int infection_count_72h:int severity:string latitude:real! longitude:real!",
    "net_revenue_variance_events": _HEAD + "claim_id:string payer_id:string payer_name:string contract_id:string contract_type:string expected_payment:real actual_payment:real variance_pct:real variance_dollars:real provider_id:string facility_id:string",
    "ops_capacity_events": _HEAD + "facility_id:string facility_name:string capacity_type:string current_value:real threshold_value:real utilization_pct:real los_hours:real ward:string latitude:real! longitude:real!",
    "staffing_acuity_events": _HEAD + "facility_id:string ward:string nurse_count:int patient_count:int acuity_score:real ratio_actual:real ratio_target:real staffing_gap:int",
    "dq_violation_events": _HEAD + "source_table:string rule_name:string rule_type:string expected_value:real actual_value:real violation_count:int violation_pct:real severity:string",
    "audit_access_events": _HEAD + "user_principal:string action_type:string resource_accessed:string anomaly_score:real geo_country:string severity:string",
    "model_drift_events": _HEAD + "model_name:string model_version:string feature_name:string drift_score:real psi_value:real ks_value:real baseline_period:string severity:string",
    "alert_closure_events": "closure_id:string! closure_timestamp:datetime! alert_id:string! alert_source_table:string alert_type:string persona:string action_taken:string resolved_by:string resolution_notes:string mttr_seconds:long outcome:string",
}

_JSON_TYPES = {"string": T.StringType(), "datetime": T.StringType(), "real": T.DoubleType(),
               "int": T.LongType(), "long": T.LongType(), "bool": T.BooleanType()}


def columns_of(table: str) -> list[tuple[str, str, bool]]:
    """(name, type, has_default) of each column of an event table."""
    out = []
    for item in EVENT_TABLES[table].split():
        name, kind = item.split(":")
        out.append((name, kind.rstrip("!"), not kind.endswith("!")))
    return out


def landing_schema() -> T.StructType:
    """The wide message schema: every column of every event table, plus the routing tag."""
    fields = {"_table": T.StringType()}
    for table in EVENT_TABLES:
        for name, kind, _ in columns_of(table):
            fields.setdefault(name, _JSON_TYPES[kind])
    fields["_corrupt_record"] = T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def parse_events(raw: DataFrame, body: str = "body") -> DataFrame:
    """Wide rows from JSON messages; a message that does not parse keeps its text."""
    parsed = F.from_json(F.col(body), landing_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    keep = [c for c in raw.columns if c != body]
    return raw.select(*keep, F.col(body).alias("_body"), parsed.alias("_e")).select(*keep, "_body", "_e.*")


def _is_dead() -> Column:
    known = F.coalesce(F.col("_table").isin(list(EVENT_TABLES)), F.lit(False))
    return F.col("_corrupt_record").isNotNull() | ~known


def split_dead_letter(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(routable rows, dead letters with the reason)."""
    reason = F.when(F.col("_corrupt_record").isNotNull(), "unparsable").otherwise("unrouted")
    dead = parsed.filter(_is_dead()).select("_body", "_table", reason.alias("reason"))
    return parsed.filter(~_is_dead()).drop("_corrupt_record", "_body"), dead


def typed(name: str, kind: str, has_default: bool) -> Column:
    """One column of a typed table: parsed type, blank default."""
    col = F.col(name)
    if kind == "datetime":
        return F.try_to_timestamp(col).alias(name)
    if kind == "int":
        col = col.cast("int") if not has_default else F.coalesce(col, F.lit(0)).try_cast("int")
    elif has_default:
        blank = {"string": "", "real": 0.0, "long": 0, "bool": False}[kind]
        col = F.coalesce(col, F.lit(blank))
    return col.alias(name)


def typed_defaults(df: DataFrame, table: str) -> DataFrame:
    """Project wide rows onto the columns of one typed table."""
    return df.select(*[typed(*c) for c in columns_of(table)])


def route(parsed: DataFrame, table: str) -> DataFrame:
    """Rows of one typed table out of the landing rows."""
    return typed_defaults(parsed.filter((F.col("_table") == table) & F.col("_corrupt_record").isNull()), table)


def backfill(parsed: DataFrame, table: str, existing: DataFrame) -> DataFrame:
    """Rows of the landing not yet in the typed table, each event once, its last arrival.

    Rows without an id can't be told apart and all count as missing.
    """
    key = columns_of(table)[0][0]
    own = parsed.filter(F.col("_table") == table)
    order = [c for c in ("ingest_ts", "event_timestamp") if c in own.columns]
    last = dedup_latest(own.filter(F.col(key).isNotNull()), [key], order).unionByName(own.filter(F.col(key).isNull()))
    return route(last, table).join(existing.select(key), key, "left_anti")


def landing_status(parsed: DataFrame) -> DataFrame:
    """Rows and distinct events per routing tag."""
    return parsed.groupBy("_table").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("event_id").alias("event_count"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt_count"),
    )
