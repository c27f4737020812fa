"""Alerts over sliding windows that are raised once, when a breach begins or gets more severe.

Each window is taken together with the one a slide before it: rows lie in windows that begin one
slide early, and both are added up side by side. So whether an alert was raised already is known
from the same aggregate, in batch and on a stream, without further state.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators.scores import tier

#: Windows and slides of the alerts, and what makes a breach.
DENIAL_SPAN, DENIAL_SLIDE, LEAST_CLAIMS, DENIAL_LIMIT = "1 hour", "15 minutes", 20, 0.12
PATIENT_SPAN, PATIENT_SLIDE, LEAST_STREAMS = "1 day", "6 hours", 2
SEVERITIES = ("MEDIUM", "HIGH", "CRITICAL")


def _seconds(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds())


def _windowed(df: DataFrame, ts: str, span: str, slide: str) -> DataFrame:
    """The rows in their windows `_w`, and whether they lie in the window or in the one before it."""
    both = df.filter(F.col(ts).isNotNull()).withColumn("_w", F.window(ts, f"{_seconds(span) + _seconds(slide)} seconds", slide))
    return both.withColumns({"_now": F.col(ts) >= F.col("_w.start") + s.spark_interval(slide), "_before": F.col(ts) < F.col("_w.end") - s.spark_interval(slide)})


def _level(severity: Column) -> Column:
    """1, 2, 3 from the mildest on; 0 for none."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), severity), F.lit(0))


def _raised(grouped: DataFrame, slide: str, severity: Column, before: Column) -> DataFrame:
    """Windows in breach that are more severe than the window before them."""
    found = grouped.withColumns({"severity": severity, "_earlier": _level(before)}).filter(_level(F.col("severity")) > F.col("_earlier"))
    placed = found.withColumns({"window_start": F.col("_w.start") + s.spark_interval(slide), "window_end": F.col("_w.end")})
    return placed.drop("_w", "_earlier")


def denial_spells(denials: DataFrame, ts: str, span: str = DENIAL_SPAN, slide: str = DENIAL_SLIDE, least: int = LEAST_CLAIMS, limit: float = DENIAL_LIMIT) -> DataFrame:
    """Windows in which a payer begins to deny more than the limit, or denies far more than before.

    Counted by reason first, so that a payer with very many claims is merged before its sums;
    the most frequent reason is picked from these counts, ties by name.
    """
    denied = F.col("adjudication_result") == "DENIED"
    sides = {"now": F.col("_now"), "before": F.col("_before")}
    by_reason = _windowed(denials, ts, span, slide).groupBy("_w", "payer_id", "payer_name", denied.alias("_denied"), F.when(denied, F.col("denial_reason")).alias("_reason")).agg(
        *[F.count_if(side).alias(f"_n_{name}") for name, side in sides.items()],
        F.sum(F.when(F.col("_now"), F.col("billed_amount").cast("decimal(18,2)"))).alias("_dollars"))
    hit, n = F.col("_denied"), F.col("_n_now")
    totals = by_reason.groupBy("_w", "payer_id", "payer_name").agg(
        *[F.sum(f"_n_{name}").alias(f"_total_{name}") for name in sides],
        *[F.coalesce(F.sum(F.when(hit, F.col(f"_n_{name}"))), F.lit(0)).alias(f"_denied_{name}") for name in sides],
        F.coalesce(F.sum(F.when(hit, F.col("_dollars"))), F.lit(0)).cast("double").alias("denied_dollars"),
        F.min_by("_reason", F.when(hit & (n > 0), F.struct(-n, F.col("_reason")))).alias("top_reason"))

    def severity(name: str) -> Column:
        total = F.col(f"_total_{name}")
        rate = F.when(total > 0, F.col(f"_denied_{name}") / total)
        return F.when((total >= least) & (rate > limit), tier(rate, (0.20, "CRITICAL"), (0.15, "HIGH"), otherwise="MEDIUM"))

    found = _raised(totals, slide, severity("now"), severity("before"))
    return found.select("window_start", "window_end", "payer_id", "payer_name", F.col("_total_now").alias("total"), F.col("_denied_now").alias("denied"),
                        (F.col("_denied_now") / F.col("_total_now")).alias("denial_rate"), "denied_dollars", "top_reason", "severity")


def patient_spells(signals: DataFrame, ts: str, streams: tuple[str, ...], span: str = PATIENT_SPAN, slide: str = PATIENT_SLIDE, least: int = LEAST_STREAMS) -> DataFrame:
    """Windows in which a patient begins to have signals of several streams, or of more than before.

    One flag a stream is kept, whatever the number of signals.
    """
    flags = [F.max(F.when(side & (F.col("source_table") == name), 1).otherwise(0)).alias(f"_{when}_{i}")
             for when, side in (("now", F.col("_now")), ("before", F.col("_before"))) for i, name in enumerate(streams)]
    grouped = _windowed(signals, ts, span, slide).groupBy("_w", "patient_id").agg(
        F.count_if(F.col("_now")).alias("total_alerts"), F.max(F.when(F.col("_now"), F.col("score"))).alias("max_score"), *flags)

    def severity(when: str) -> Column:
        n = sum((F.col(f"_{when}_{i}") for i in range(len(streams))), F.lit(0))
        return F.when(n >= least, tier(n, (3, "CRITICAL"), otherwise="HIGH"))

    found = _raised(grouped, slide, severity("now"), severity("before"))
    names = F.concat_ws(", ", *[F.when(F.col(f"_now_{i}") == 1, F.lit(name)) for i, name in enumerate(streams)])
    count = sum((F.col(f"_now_{i}") for i in range(len(streams))), F.lit(0))
    return found.select("window_start", "window_end", "patient_id", count.cast("bigint").alias("stream_count"), names.alias("streams"), "total_alerts", "max_score", "severity")


#: Event tables whose rows are signals of a patient, and the score of each.
SIGNALS = {"clinical_deterioration_events": "news2_score", "denial_adjudication_events": "billed_amount", "readmission_events": "readmission_risk_score"}


def signal_rows(df: DataFrame, table: str, ts: str) -> DataFrame:
    """The signals in one event table: readmissions, patients who get worse, denied claims."""
    wanted = {"clinical_deterioration_events": F.coalesce(F.col("news2_score"), F.lit(0.0)) >= 5,
              "denial_adjudication_events": F.coalesce(F.col("adjudication_result"), F.lit("")) == "DENIED"}.get(table, F.lit(True))
    return df.filter(wanted).select("patient_id", F.coalesce(F.col(SIGNALS[table]), F.lit(0.0)).alias("score"), F.lit(table).alias("source_table"), ts)
