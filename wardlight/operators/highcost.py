"""Cost trajectory of members: trailing spend, emergency visits, readmissions, trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.latest import latest_by
from wardlight.operators.scans import DAY, Trailing, null_safe_join, previous_instant, trailing, with_trailing

# --- fixed values: limits of the cost tiers ---
SPEND_30D, SPEND_90D, ED_VISITS_30D, READMIT_DAYS = 15000, 40000, 3, 30

_SPEND = [
    ("rolling_spend_30d", 30, lambda: F.coalesce(F.col("claim_amount"), F.lit(0)).cast("decimal(18,2)")),
    ("rolling_spend_90d", 90, lambda: F.coalesce(F.col("claim_amount"), F.lit(0)).cast("decimal(18,2)")),
    ("claims_count_30d", 30, lambda: F.when(F.col("claim_id").isNotNull(), 1).otherwise(0)),
]


def _timed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_timestamp").isNotNull()).withColumn("event_epoch", F.unix_timestamp("event_timestamp"))


def _spend_measures() -> list[Trailing]:
    return [Trailing(name, value(), days * DAY) for name, days, value in _SPEND]


def rolling_spend(claims: DataFrame) -> DataFrame:
    """Each claim with the patient's spend of the trailing 30 and 90 days; 0 for a claim without a time."""
    df = with_trailing(_timed(claims), ["patient_id"], "event_epoch", _spend_measures())
    untimed = claims.filter(F.col("event_timestamp").isNull()).withColumn("event_epoch", F.lit(None).cast("bigint"))
    df = df.unionByName(untimed.withColumns({n: F.lit(0).cast(df.schema[n].dataType) for n, _, _ in _SPEND}))
    return df.withColumns({c: F.col(c).cast("double") for c in ("rolling_spend_30d", "rolling_spend_90d")})


def latest_spend(claims: DataFrame) -> DataFrame:
    """Trailing spend at each patient's last claim, with the place of that claim."""
    timed = _timed(claims)
    points = trailing(timed, ["patient_id"], "event_epoch", _spend_measures())
    names = [n for n, _, _ in _SPEND]
    last = points.groupBy("patient_id").agg(*[F.max_by(n, "event_epoch").alias(n) for n in names])
    place = latest_by(timed.select("patient_id", "event_epoch", "event_id", "latitude", "longitude"), ["patient_id"], "event_epoch", "event_id")
    joined = null_safe_join(last, place.select("patient_id", "latitude", "longitude"), ["patient_id"])
    return joined.withColumns({c: F.col(c).cast("double") for c in ("rolling_spend_30d", "rolling_spend_90d")})


def ed_visits(adt: DataFrame) -> DataFrame:
    """Emergency visits of the trailing 30 days at each patient's last one."""
    ed = _timed(adt.filter(F.col("admission_type") == "EMERGENCY"))
    points = trailing(ed, ["patient_id"], "event_epoch", [Trailing("ed_visits_30d", F.lit(1), 30 * DAY)])
    last = latest_by(ed.select("patient_id", "event_epoch", "event_id", "event_timestamp", "facility_id"), ["patient_id"], "event_epoch", "event_id")
    return null_safe_join(last, points, ["patient_id", "event_epoch"]).select(
        "patient_id", F.col("event_timestamp").alias("ed_event_ts"), "ed_visits_30d", F.col("facility_id").alias("ed_facility_id"))


def readmissions(adt: DataFrame, days: int = READMIT_DAYS) -> DataFrame:
    """Admissions within the days after the patient's previous one, counted per patient."""
    steps = previous_instant(adt.filter(F.col("event_type") == "ADMIT"), ["patient_id"], "event_timestamp")
    again = F.when(F.datediff("event_timestamp", "prev") <= days, 1).otherwise(0)
    return steps.groupBy("patient_id").agg(F.sum(again + F.col("n") - 1).alias("readmission_count_30d"))


def highcost_alerts(claims: DataFrame, adt: DataFrame, patients: DataFrame, facilities: DataFrame, as_of: str) -> DataFrame:
    """Spend, visits and readmissions of each member with claims, cost trend and tier."""
    people = patients.filter(F.col("is_current") == 1).select("patient_id", "first_name", "last_name")
    places = facilities.select(F.col("facility_id").alias("ed_facility_id"), "facility_name", F.col("latitude").alias("fac_lat"), F.col("longitude").alias("fac_lon"))
    df = (latest_spend(claims).join(ed_visits(adt).drop("ed_event_ts"), "patient_id", "left").join(readmissions(adt), "patient_id", "left")
          .join(people, "patient_id", "left").join(places, "ed_facility_id", "left"))
    df = df.fillna({"ed_visits_30d": 0, "readmission_count_30d": 0, "rolling_spend_30d": 0.0, "rolling_spend_90d": 0.0})
    spend, month = F.col("rolling_spend_30d"), F.col("rolling_spend_90d") / 3
    trend = (F.when(spend > month * 1.5, "ACCELERATING").when(spend > month * 1.1, "RISING").when(spend < month * 0.8, "DECLINING").otherwise("STABLE"))
    df = df.withColumns({"cost_trend": trend, "readmission_flag": F.col("readmission_count_30d") > 0})
    rich, often = spend >= SPEND_30D, F.col("ed_visits_30d") >= ED_VISITS_30D
    tier = (F.when(rich & often, "CRITICAL").when(rich | (F.col("rolling_spend_90d") >= SPEND_90D), "HIGH")
            .when(often | F.col("readmission_flag") | (F.col("cost_trend") == "ACCELERATING"), "MEDIUM").otherwise("LOW"))
    return df.select(
        s.content_id("HIGH_COST", F.col("patient_id"), F.lit(as_of)).alias("alert_id"), F.to_timestamp(F.lit(as_of)).alias("alert_timestamp"), "patient_id",
        F.col("first_name").alias("patient_first_name"), F.col("last_name").alias("patient_last_name"), F.col("ed_facility_id").alias("facility_id"),
        F.coalesce("facility_name", F.lit("Unknown")).alias("facility_name"), "rolling_spend_30d", "rolling_spend_90d", "claims_count_30d", "ed_visits_30d",
        "readmission_count_30d", "readmission_flag", tier.alias("risk_tier"), "cost_trend",
        F.coalesce("latitude", "fac_lat").alias("latitude"), F.coalesce("longitude", "fac_lon").alias("longitude"))


def _mean_spend(col: str, places: int = 0):
    return s.rounded(s.ratio(F.sum(F.col(col).cast("decimal(18,2)")), F.count(col)), places)


def highcost_summary(alerts: DataFrame, by: str) -> DataFrame:
    """Members by ``risk_tier`` or ``cost_trend``."""
    if by == "risk_tier":
        return alerts.groupBy("risk_tier").agg(
            F.count(F.lit(1)).alias("patients"), _mean_spend("rolling_spend_30d").alias("avg_spend_30d"), _mean_spend("rolling_spend_90d").alias("avg_spend_90d"),
            s.rounded(F.avg("ed_visits_30d"), 1).alias("avg_ed_visits"), F.count_if(F.col("readmission_flag")).alias("readmissions"))
    return alerts.groupBy("cost_trend").agg(F.count(F.lit(1)).alias("members"), _mean_spend("rolling_spend_30d").alias("avg_30d_spend"),
                                            s.rounded(F.avg("ed_visits_30d"), 1).alias("avg_ed_visits"))


def highcost_top(alerts: DataFrame, n: int = 15) -> DataFrame:
    chosen = alerts.filter(F.col("risk_tier").isin("CRITICAL", "HIGH"))
    columns = ["patient_id", "patient_first_name", "patient_last_name", "risk_tier", "cost_trend", "rolling_spend_30d", "rolling_spend_90d", "ed_visits_30d", "readmission_flag"]
    return chosen.select(*columns).orderBy(F.col("rolling_spend_30d").desc(), "patient_id").limit(n)
