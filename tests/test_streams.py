"""Streams give what their batch twins give; reruns change nothing."""

import uuid

import pytest
from pyspark.sql import functions as F

from wardlight.operators import fraud, highcost, spells
from wardlight.sources import files, landing
from wardlight.streaming import jobs, stateful

HEAD = '{"event_id":"%s","event_timestamp":"%s","_table":"%s"%s}'


def _message(i, at, table, more=""):
    return HEAD % (f"e{i}", at, table, more)


def _claim(i, at, provider="p", amount=10.0):
    return _message(i, at, "claims_events", f',"event_type":"C","claim_id":"c{i}","patient_id":"x","provider_id":"{provider}","claim_amount":{amount}')


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex[:6])


def _land(spark, path, bodies, part):
    df = spark.createDataFrame([(b, "2024-01-01 00:00:00") for b in bodies], "body string, t string").select("body", F.to_timestamp("t").alias("ingest_ts"))
    df.coalesce(1).write.mode("append").parquet(f"{path}")


def test_router_keeps_every_message(spark, folder, rows):
    bodies = [_claim(1, "2024-01-01T10:00:00"), _message(2, "bad", "adt_events", ',"patient_id":"x"'), _message(3, "2024-01-01T10:00:00", "nowhere"), '{"event_id":"e4","_ta', _claim(5, "2024-01-01T10:00:00")]
    _land(spark, f"{folder}/in", bodies[:3], 0)
    _land(spark, f"{folder}/in", bodies[3:], 1)
    jobs.finish(jobs.run_router(jobs.landing_stream(spark, f"{folder}/in", 1), f"{folder}/out", f"{folder}/cp", ["claims_events", "adt_events"]))
    assert rows(jobs.routed(spark, f"{folder}/out", "claims_events"), "event_id", "facility_id", "claim_amount") == [("e1", "", 10.0), ("e5", "", 10.0)]
    assert rows(jobs.routed(spark, f"{folder}/out", "adt_events"), "event_id", "event_timestamp", "has_open_care_gaps") == [("e2", None, False)]
    assert rows(jobs.routed(spark, f"{folder}/out", "dead_letters"), "reason") == [("unparsable",), ("unrouted",)]
    # a second run finds nothing new
    jobs.finish(jobs.run_router(jobs.landing_stream(spark, f"{folder}/in", 1), f"{folder}/out", f"{folder}/cp", ["claims_events", "adt_events"]))
    assert jobs.routed(spark, f"{folder}/out", "claims_events").count() == 2


def _run(df, folder):
    jobs.finish(jobs.to_table(df, f"{folder}/out", f"{folder}/cp"))
    return df.sparkSession.read.parquet(f"{folder}/out")


def test_velocity_over_micro_batches_equals_batch(spark, folder, rows):
    """Files out of order within the delay, one a micro-batch; parts of a quarter of an hour."""
    bodies = [_claim(i, f"2024-01-01T{10 + i // 40}:{i % 40 * 3 // 2:02d}:{i % 2 * 30:02d}", "pq"[i % 3 == 0]) for i in range(120)]
    order = [0, 2, 1, 4, 3, 5]
    for k in order:
        _land(spark, f"{folder}/in", bodies[k * 20:k * 20 + 20] + ([_claim(900, "bad-time")] if k == 1 else []), k)
    _land(spark, f"{folder}/in", [_claim(901, "2024-01-01T10:00:00"), _claim(902, "2024-01-02T00:00:00", "r")], 9)  # 901 is too late
    _land(spark, f"{folder}/in", [_claim(903, "2024-01-02T12:00:00", "r")], 10)
    got = _run(stateful.velocity_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "2 hours", part=900), folder)
    kept = spark.read.parquet(f"{folder}/in").filter("body NOT LIKE '%e901%'")
    want = fraud.velocity_score(landing.route(landing.parse_events(kept), "claims_events")).filter("event_id <> 'e903'")
    assert rows(got, "event_id", "claims_in_window", "velocity_score") == rows(want, "event_id", "claims_in_window", "velocity_score")
    assert got.agg(F.max("claims_in_window")).first()[0] > 20


def test_velocity_leaves_no_claim_out(spark, folder, rows):
    """The last claims, within the delay, come out of the state when the stream has stopped; ties and parts included."""
    bodies = [_claim(i, f"2024-01-01T{10 + i // 40}:{i % 40 * 3 // 2:02d}:{i % 2 * 30:02d}", "pq"[i % 3 == 0]) for i in range(120)] + [_claim(200 + i, "2024-01-01T12:58:30.25") for i in range(4)] + [_claim(900, "bad-time")]
    for k in range(3):
        _land(spark, f"{folder}/in", bodies[42 * k : 42 * k + 42], k)
    given = _run(stateful.velocity_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "1 hour", part=900), folder)
    got = given.unionByName(stateful.velocity_rest(spark, f"{folder}/cp"))
    want = fraud.velocity_score(landing.route(landing.parse_events(spark.read.parquet(f"{folder}/in")), "claims_events"))
    assert rows(got, "event_id", "claims_in_window", "velocity_score") == rows(want, "event_id", "claims_in_window", "velocity_score")
    assert 0 < given.count() < got.count() == len(bodies)


def test_state_of_velocity_is_let_go(spark, folder):
    for k in range(6):
        _land(spark, f"{folder}/in", [_claim(10 * k + i, f"2024-01-0{k + 1}T10:0{i}:00", f"p{k}") for i in range(9)], k)
    query = jobs.to_table(stateful.velocity_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "10 minutes"), f"{folder}/out", f"{folder}/cp")
    jobs.finish(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept[-1] <= 2  # the last day's clinician, not six


def _admit(i, at, patient="x", kind="ADMIT"):
    return _message(i, at, "adt_events", f',"event_type":"{kind}","patient_id":"{patient}"')


def test_readmissions_over_micro_batches_equal_batch(spark, folder, rows):
    files_of = [
        [_admit(1, "2024-01-10T10:00:00"), _admit(2, "2024-01-05T10:00:00", "y")],
        [_admit(3, "2024-01-08T10:00:00"), _admit(4, "2024-01-20T10:00:00", "y", "DISCHARGE"), _admit(5, "2024-01-10T10:00:00")],  # before the first file's, and at one time
        [_admit(6, "2024-02-09T23:00:00"), _admit(7, "2024-02-05T10:00:00", "y"), _admit(8, "2024-02-06T09:00:00", "z")],
        [_admit(9, "2024-03-15T10:00:00", "z"), _admit(10, "2024-03-16T10:00:00", "z")],
    ]
    for k, bodies in enumerate(files_of):
        _land(spark, f"{folder}/in", bodies, k)
    got = _run(stateful.readmission_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "5 days"), folder).groupBy("patient_id").agg(F.count("*").alias("n"))
    adt = landing.route(landing.parse_events(spark.read.parquet(f"{folder}/in")), "adt_events")
    assert rows(got) == rows(highcost.readmissions(adt).filter("readmission_count_30d > 0"))


def _denial(i, at, result="DENIED", reason="A"):
    return _message(i, at, "denial_adjudication_events", f',"payer_id":"P","payer_name":"Payer","patient_id":"x","adjudication_result":"{result}","denial_reason":"{reason}","billed_amount":10.5')


def test_a_spike_is_raised_once(spark, folder, rows):
    """Four hours of denials: raised when they begin, and when they turn worse."""
    bodies = [[_denial(100 * h + i, f"2024-01-01T{10 + h}:{i * 2:02d}:00", "DENIED" if i < bad else "PAID", "AB"[i % 2]) for i in range(25)] for h, bad in enumerate([0, 4, 4, 12, 12, 0])]
    for k, part in enumerate(bodies):
        _land(spark, f"{folder}/in", part, k)
    _land(spark, f"{folder}/in", [_denial(9999, "2024-01-02T10:00:00")], 9)
    got = _run(stateful.denial_spike_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "10 minutes", "1 hour", "1 hour"), folder)
    assert [(r[0].hour, *r[1:]) for r in rows(got, "window_start", "denied", "total", "top_reason", "severity", "denied_dollars")] == [(11, 4, 25, "A", "HIGH", 42.0), (13, 12, 25, "A", "CRITICAL", 126.0)]
    batch = landing.route(landing.parse_events(spark.read.parquet(f"{folder}/in")), "denial_adjudication_events")
    assert rows(got) == rows(spells.denial_spells(batch, "event_timestamp", "1 hour", "1 hour"))


def test_patients_of_several_streams_are_raised_once(spark, folder, rows):
    def low(i, at, patient):
        return _message(i, at, "clinical_deterioration_events", f',"patient_id":"{patient}","news2_score":7.0')

    def back(i, at, patient):
        return _message(i, at, "readmission_events", f',"patient_id":"{patient}","readmission_risk_score":0.5')

    first = [low(1, "2024-01-01T01:00:00", "x"), back(2, "2024-01-01T02:00:00", "x"), low(3, "2024-01-01T03:00:00", "y"), low(4, "2024-01-01T04:00:00", "y")]
    _land(spark, f"{folder}/in", first, 0)
    _land(spark, f"{folder}/in", [_denial(5, "2024-01-01T08:00:00"), low(6, "2024-01-01T09:00:00", "y"), back(7, "2024-01-02T02:00:00", "y")], 1)
    for k, make in enumerate((low, back)):
        _land(spark, f"{folder}/in", [make(20 + k, "2024-01-09T00:00:00", "z")], 2 + k)
    _land(spark, f"{folder}/in", [_denial(30, "2024-01-09T00:00:00").replace('"x"', '"v"')], 5)
    got = _run(stateful.cross_patient_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "1 day"), folder)
    batch = landing.parse_events(spark.read.parquet(f"{folder}/in"))
    signals = [spells.signal_rows(landing.route(batch, t), t, "event_timestamp") for t in spells.SIGNALS]
    want = spells.patient_spells(signals[0].unionByName(signals[1]).unionByName(signals[2]), "event_timestamp", tuple(spells.SIGNALS))
    assert rows(got) == rows(want.filter("window_end <= '2024-01-08 00:00:00'"))
    assert [(r["patient_id"], r["severity"]) for r in got.orderBy("window_start", "patient_id").collect()] == [("x", "HIGH"), ("x", "CRITICAL"), ("y", "HIGH")]


def test_repeated_events_pass_once(spark, folder, rows):
    bodies = [_claim(1, "2024-01-01T10:00:00"), _claim(1, "2024-01-01T10:00:00"), _claim(2, "2024-01-01T10:01:00")]
    _land(spark, f"{folder}/in", bodies, 0)
    _land(spark, f"{folder}/in", bodies[:1], 1)
    once = jobs.dedup_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "1 hour").select("event_id")
    jobs.finish(jobs.to_table(once, f"{folder}/out", f"{folder}/cp"))
    assert rows(spark.read.parquet(f"{folder}/out")) == [("e1",), ("e2",)]


def test_windows_close_after_the_watermark(spark, folder, rows):
    times = ["10:00:00", "10:04:59", "10:05:00", "10:30:00"]
    _land(spark, f"{folder}/in", [_claim(i, f"2024-01-01T{t}") for i, t in enumerate(times)], 0)
    _land(spark, f"{folder}/in", [_claim(8, "2024-01-01T10:30:30")], 1)  # a batch later the watermark counts
    _land(spark, f"{folder}/in", [_claim(9, "2024-01-01T10:01:00"), _claim(10, "2024-01-01T10:31:00")], 2)  # the first one is too late
    counted = jobs.window_counts(jobs.landing_stream(spark, f"{folder}/in", 1), "10 minutes", "5 minutes", ["_table"])
    jobs.finish(jobs.to_table(counted, f"{folder}/out", f"{folder}/cp"))
    assert [(r[0].minute, r[1]) for r in rows(spark.read.parquet(f"{folder}/out"), "bin", "event_count")] == [(0, 2), (5, 1)]


def test_latest_by_key_over_micro_batches(spark, folder, rows):
    def capacity(i, at, value):
        return _message(i, at, "ops_capacity_events", f',"facility_id":"F","capacity_type":"ED_BOARDING","current_value":{value}')

    _land(spark, f"{folder}/in", [capacity(1, "2024-01-01T10:00:00", 1.0), capacity(2, "2024-01-01T12:00:00", 2.0)], 0)
    _land(spark, f"{folder}/in", [capacity(3, "2024-01-01T11:00:00", 3.0)], 1)
    keys = ["facility_id", "capacity_type"]
    latest = jobs.latest_stream(jobs.landing_stream(spark, f"{folder}/in", 1), "ops_capacity_events", keys, ["event_id", "current_value"])
    jobs.finish(jobs.to_table(latest, f"{folder}/out", f"{folder}/cp", "update"))
    assert rows(jobs.read_latest(spark, f"{folder}/out", keys), "event_id", "current_value") == [("e2", 2.0)]


def test_scores_of_a_run_replace_themselves(spark, folder, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, score int")
    for run in ("r1", "r2", "r1"):
        files.write_scores(df, f"{folder}/scores", run)
    assert rows(spark.read.parquet(f"{folder}/scores").groupBy("scoring_run_id").count()) == [("r1", 2), ("r2", 2)]


def test_appended_columns_are_merged(spark, folder, rows):
    files.save_table(spark.createDataFrame([("a", 1)], "id string, x int"), f"{folder}/t")
    files.save_table(spark.createDataFrame([("b", 2)], "id string, y int"), f"{folder}/t", "append")
    assert rows(files.read_table(spark, f"{folder}/t"), "id", "x", "y") == [("a", 1, None), ("b", None, 2)]


def test_no_incremental_files_give_an_empty_table(spark, folder):
    df = files.load_incremental(spark, [f"{folder}/none/*.csv"], files.text_schema(["a", "b"]))
    assert df.count() == 0 and df.columns[:2] == ["a", "b"]


def test_missing_sources(spark, folder):
    files.save_table(spark.range(1), f"{folder}/there")
    wanted = [files.SourceFile("there", f"{folder}/there"), files.SourceFile("gone", f"{folder}/gone"), files.SourceFile("maybe", f"{folder}/maybe", required=False)]
    assert [r["name"] for r in files.missing_sources(spark, wanted).collect()] == ["gone"]
