"""Claim fraud rules: velocity, amount, distance, upcoding, and their sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.aggregates import severity_rank
from wardlight.operators.scans import Trailing, with_trailing
from wardlight.operators.scores import tier


def provider_baseline(fc: DataFrame, prov: DataFrame) -> DataFrame:
    """Mean, deviation and count of billed amounts per clinician over all claims."""
    rows = fc.join(prov.select("provider_key", "provider_id"), "provider_key")
    return rows.groupBy("provider_id").agg(
        s.mean_money("billed_amount").alias("hist_avg_amount"), F.stddev_samp(F.col("billed_amount").cast("double")).alias("hist_std_amount"),
        F.count(F.lit(1)).alias("hist_claim_count"))


def _epoch(df: DataFrame) -> DataFrame:
    return df.withColumn("_epoch", F.unix_timestamp("event_timestamp"))


def velocity_score(df: DataFrame, secs: int = 3600) -> DataFrame:
    """Claims of the clinician in the trailing seconds, this one and ties included."""
    timed = _epoch(df)
    counted = with_trailing(timed.filter(F.col("_epoch").isNotNull()), ["provider_id"], "_epoch",
                            [Trailing("claims_in_window", F.when(F.col("claim_id").isNotNull(), 1).otherwise(0), secs)], chunk=3600)
    untimed = timed.filter(F.col("_epoch").isNull()).withColumn("claims_in_window", F.lit(0).cast("bigint"))
    both = counted.unionByName(untimed).drop("_epoch")
    n = F.col("claims_in_window")
    return both.withColumn("velocity_score", F.when(n > 5, F.least(F.lit(30), (n - 5) * 6)).otherwise(0))


def amount_score(df: DataFrame) -> DataFrame:
    """Deviations above the clinician's mean; needs the baseline columns."""
    std = F.col("hist_std_amount")
    z = F.when(std > 0, (F.col("claim_amount") - F.col("hist_avg_amount")) / std).otherwise(F.lit(0.0))
    df = df.withColumn("amount_zscore", s.rounded(z, 6))
    z = F.col("amount_zscore")
    return df.withColumn("amount_score", F.when(z > 2, F.least(F.lit(25.0), (z - 2) * 10)).otherwise(F.lit(0.0)))


def degrees_apart(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * 6371.0)


def geo_score(df: DataFrame) -> DataFrame:
    """Distance in degrees between claim and facility; needs fac_lat and fac_lon."""
    d = degrees_apart(F.col("latitude"), F.col("longitude"), F.col("fac_lat"), F.col("fac_lon"))
    df = df.withColumn("geo_distance_deg", s.rounded(d, 6))
    d = F.col("geo_distance_deg")
    return df.withColumn("geo_score", F.when(d > 1, F.least(F.lit(25.0), d * 5)).otherwise(F.lit(0.0)))


def upcoding_score(df: DataFrame) -> DataFrame:
    return df.withColumn("upcoding_score", F.when(F.col("procedure_code") == "99215", 20).otherwise(0))


def fraud_scores(claims: DataFrame, providers: DataFrame, facilities: DataFrame, baseline: DataFrame) -> DataFrame:
    """All rules per claim event, total, flags and tier.

    The score carries the time of its claim, so a second run gives the same rows.
    """
    names = providers.filter(F.col("is_current") == 1).select("provider_id", F.col("display_name").alias("provider_name"), "specialty")
    places = facilities.select("facility_id", F.col("latitude").alias("fac_lat"), F.col("longitude").alias("fac_lon"))
    df = velocity_score(claims).join(names, "provider_id", "left").join(places, "facility_id", "left").join(baseline, "provider_id", "left")
    df = upcoding_score(geo_score(amount_score(df)))
    parts = {"velocity_burst": "velocity_score", "amount_outlier": "amount_score", "geo_anomaly": "geo_score", "upcoding": "upcoding_score"}
    total = sum((F.col(c) for c in parts.values()), F.lit(0.0))
    df = df.withColumns({
        "fraud_score": s.rounded(total, 2),
        "fraud_flags": F.concat_ws("|", *[F.when(F.col(c) > 0, F.lit(name)) for name, c in parts.items()]),
    })
    return df.select(
        s.content_id("FRAUD", F.col("event_id")).alias("score_id"), F.col("event_timestamp").alias("score_timestamp"),
        "claim_id", "patient_id", "provider_id", "facility_id", "claim_amount", "diagnosis_code", "procedure_code", "claim_type", "fraud_score", "fraud_flags",
        tier(F.col("fraud_score"), (50, "CRITICAL"), (30, "HIGH"), (15, "MEDIUM"), otherwise="LOW").alias("risk_tier"),
        "velocity_score", "amount_score", "geo_score", "upcoding_score", "claims_in_window", "amount_zscore", "geo_distance_deg", "latitude", "longitude")


def money_of(col: str) -> Column:
    """Event amounts summed exactly."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def fraud_summary(scores: DataFrame) -> DataFrame:
    grouped = scores.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("claim_count"), s.rounded(F.avg("fraud_score"), 1).alias("avg_score"),
        s.rounded(F.max("fraud_score"), 1).alias("max_score"), money_of("claim_amount").alias("total_amount"))
    return grouped.orderBy(severity_rank(F.col("risk_tier")))


def fraud_top_providers(scores: DataFrame, providers: DataFrame, n: int = 10) -> DataFrame:
    """Clinicians with the highest mean score over their critical and high claims."""
    names = providers.filter(F.col("is_current") == 1).select("provider_id", F.col("display_name").alias("provider_name"), "specialty")
    grouped = scores.filter(F.col("risk_tier").isin("CRITICAL", "HIGH")).groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("flagged_claims"), s.rounded(F.avg("fraud_score"), 1).alias("avg_fraud_score"), money_of("claim_amount").alias("total_flagged_amount"))
    return grouped.join(names, "provider_id", "left").orderBy(F.col("avg_fraud_score").desc(), "provider_id").limit(n)
