"""Streams that keep state by key: trailing counts, interval joins, alerts raised once.

State goes when the watermark has passed it: claims after the reach of the velocity rule,
admissions after the days of a readmission, counts when their window has closed. Rows later
than the delay are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardlight.functions import scalars as s
from wardlight.operators import spells
from wardlight.sources import landing
from wardlight.streaming.jobs import timed

#: Seconds that a claim counts for those after it, and of the parts into which a clinician's time is cut.
REACH, PART = 3600, 6 * 3600

_VELOCITY = "event_id string, provider_id string, event_timestamp timestamp, claims_in_window bigint"
_PENDING = "seconds array<bigint>, counts array<bigint>, waiting array<struct<event_id: string, at: bigint, micros: bigint>>"


def _score_part(reach: int, part: int):
    """Counts of one clinician's claims in one part of time.

    The state holds claims per second within the reach, and claims that wait until the watermark
    has passed their second: then no claim before them can come any more.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        provider, place = key
        seconds, counts, waiting = state.get if state.exists else ([], [], [])
        seen = dict(zip(seconds, counts, strict=True))
        waiting = [tuple(x) if not isinstance(x, dict) else (x["event_id"], x["at"], x["micros"]) for x in waiting]
        for frame in frames:
            if not len(frame):  # called by the clock, without new claims
                continue
            for at, n in frame.groupby("at").size().items():
                seen[int(at)] = seen.get(int(at), 0) + int(n)
            own = frame[frame["own"]]
            waiting += list(zip(own["event_id"], own["at"].astype(int), own["micros"].astype(int), strict=True))
        known = state.getCurrentWatermarkMs() // 1000  # claims before this second have all arrived
        ready = sorted((x for x in waiting if x[1] < known), key=lambda x: x[1])
        waiting = [x for x in waiting if x[1] >= known]
        if ready:
            order = sorted(seen)
            totals, low, high, out = 0, 0, 0, []
            for _, at, _ in ready:  # both ends move forward only
                while high < len(order) and order[high] <= at:
                    totals += seen[order[high]]
                    high += 1
                while order[low] < at - reach:
                    totals -= seen[order[low]]
                    low += 1
                out.append(totals)
            yield pd.DataFrame({"event_id": [x[0] for x in ready], "provider_id": provider, "event_timestamp": pd.to_datetime([x[2] for x in ready], unit="us"), "claims_in_window": out})
        oldest = min((x[1] for x in waiting), default=known)
        end = (place + 1) * part
        seen = {at: n for at, n in seen.items() if at >= min(oldest, known) - reach}
        if known > end:
            state.remove()
            return
        order = sorted(seen)
        state.update((order, [seen[x] for x in order], waiting))
        state.setTimeoutTimestamp(1000 * (min(max(oldest, known), end) + 1))

    return run


def velocity_stream(stream: DataFrame, delay: str, reach: int = REACH, part: int = PART) -> DataFrame:
    """Claims of the clinician in the trailing seconds, this one and ties included, once the
    watermark has passed the claim; claims without a time count 0.

    A clinician's time is cut into parts that are kept apart, so one with very many claims is
    spread over tasks and its state is let go part by part; a claim near the end of a part also
    counts in the next one.
    """
    parsed = landing.parse_events(stream).filter(F.col("_corrupt_record").isNull() & (F.col("_table") == "claims_events"))
    untimed = parsed.filter(F.try_to_timestamp("event_timestamp").isNull()).select(
        "event_id", F.coalesce("provider_id", F.lit("")).alias("provider_id"), F.lit(None).cast("timestamp").alias("event_timestamp"), F.lit(0).cast("bigint").alias("claims_in_window"))
    at = F.unix_timestamp("event_ts")
    claims = timed(stream, delay, "claims_events").select("event_id", F.coalesce("provider_id", F.lit("")).alias("provider_id"), "event_ts", at.alias("at"), F.unix_micros("event_ts").alias("micros"))
    own = F.floor(F.col("at") / part)
    parts = F.sequence(own, F.floor((F.col("at") + reach) / part))
    dealt = claims.withColumn("place", F.explode(parts)).withColumn("own", F.col("place") == own)
    counted = dealt.groupBy("provider_id", "place").applyInPandasWithState(_score_part(reach, part), _VELOCITY, _PENDING, "append", GroupStateTimeout.EventTimeTimeout)
    return _velocity_scored(counted.unionByName(untimed))


def _velocity_scored(counted: DataFrame) -> DataFrame:
    n = F.col("claims_in_window")
    return counted.withColumn("velocity_score", F.when(n > 5, F.least(F.lit(30), (n - 5) * 6)).otherwise(0))


def velocity_rest(spark: SparkSession, checkpoint: str, reach: int = REACH) -> DataFrame:
    """The claims that still wait when `velocity_stream` has stopped, scored from its state.

    With what the stream gave out these are all claims: none comes after the last file. A stream
    that goes on gives them out itself.
    """
    state = spark.read.format("statestore").load(checkpoint).select("key.provider_id", "key.place", "value.groupState.*").filter(F.size("waiting") > 0)
    trailing = Window.partitionBy("provider_id", "place").orderBy("at").rangeBetween(-reach, 0)
    seconds = state.select("provider_id", "place", F.explode(F.arrays_zip(F.col("seconds").alias("at"), F.col("counts").alias("n"))).alias("x")).select("provider_id", "place", "x.*")
    counts = seconds.select("provider_id", "place", "at", F.sum("n").over(trailing).alias("claims_in_window"))
    waiting = state.select("provider_id", "place", F.explode("waiting").alias("x")).select("provider_id", "place", "x.*")
    found = waiting.join(counts, ["provider_id", "place", "at"])
    return _velocity_scored(found.select("event_id", "provider_id", F.timestamp_micros("micros").alias("event_timestamp"), "claims_in_window"))


def readmission_stream(stream: DataFrame, delay: str, days: int = 30) -> DataFrame:
    """Admissions within the days after an earlier one of the patient, as a semi join of two
    watermarked streams: an admission passes once, however many came before it."""
    admitted = timed(stream, delay, "adt_events").filter(F.col("event_type") == "ADMIT").select("event_id", "patient_id", "event_ts")
    earlier = timed(stream, delay, "adt_events").filter(F.col("event_type") == "ADMIT").select(
        F.col("event_id").alias("prior_id"), F.col("patient_id").alias("prior_patient"), F.col("event_ts").alias("prior_ts"))
    within = (F.col("prior_ts") <= F.col("event_ts")) & (F.col("prior_ts") >= F.col("event_ts") - s.spark_interval(f"{days + 1} days")) & (F.datediff("event_ts", "prior_ts") <= days)
    before = (F.col("prior_ts") < F.col("event_ts")) | (F.col("prior_id") < F.col("event_id"))
    return admitted.join(earlier, F.col("patient_id").eqNullSafe(F.col("prior_patient")) & within & before, "left_semi")


def denial_spike_stream(stream: DataFrame, delay: str, span: str = spells.DENIAL_SPAN, slide: str = spells.DENIAL_SLIDE, least: int = spells.LEAST_CLAIMS) -> DataFrame:
    """Denial spikes, each raised once its window has closed: counts by window, payer and reason,
    and behind them the totals by window and payer."""
    blank = {c: F.coalesce(c, F.lit("")) for c in ("payer_id", "payer_name", "adjudication_result", "denial_reason")}
    typed = timed(stream, delay, "denial_adjudication_events").withColumns(blank | {"billed_amount": F.coalesce("billed_amount", F.lit(0.0))})
    return spells.denial_spells(typed, "event_ts", span, slide, least)


def cross_patient_stream(stream: DataFrame, delay: str, span: str = spells.PATIENT_SPAN, slide: str = spells.PATIENT_SLIDE) -> DataFrame:
    """Patients with signals of two streams and more, raised once, again when it gets more severe.

    Three watermarked streams are put together; the slowest one holds the watermark back.
    """
    parts = [spells.signal_rows(timed(stream, delay, table), table, "event_ts") for table in spells.SIGNALS]
    signals = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return spells.patient_spells(signals, "event_ts", tuple(spells.SIGNALS), span, slide)
