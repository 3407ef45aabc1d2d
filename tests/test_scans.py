"""Snapshots, baselines, activity and enrichment."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.activity import daily_activity, session_activity
from sluice.operators.scans import baselines, enrich_with_sessions, nest_baselines, snapshots

DDL = (
    "_stream_key string, customerId string, scanId string, eventTime bigint, seq bigint, overallHydrationScore float, "
    "overallPigmentationScore float, overallTextureScore float, overallWrinkleScore float, radianceScore float, "
    "overallSkinScore float, topConcerns array<string>, skinToneLabel string"
)
FIELD = {
    "scan-hydration": 5, "scan-pigmentation": 6, "scan-texture": 7, "scan-wrinkles": 8, "scan-radiance": 9, "scan-overall": 10,
}


def scan(stream, customer, scan_id, time, seq, score=None, concerns=None, tone=None):
    row = [stream, customer, scan_id, time, seq, *[None] * 6, concerns, tone]
    if stream in FIELD:
        row[FIELD[stream]] = score
    return tuple(row)


def test_full_scan(spark):
    values = [("hydration", 72.5), ("pigmentation", 38.0), ("texture", 61.0), ("wrinkles", 45.0), ("radiance", 80.0)]
    rows = [scan(f"scan-{name}", "cust-001", "s1", 1000 + i, i, value) for i, (name, value) in enumerate(values)]
    rows.append(scan("scan-facial", "cust-001", "s1", 1005, 5, tone="II"))
    rows.append(scan("scan-overall", "cust-001", "s1", 1006, 6, 68.5, ["hydration", "pores"]))
    result = snapshots(spark.createDataFrame(rows, DDL), position="seq").collect()
    assert len(result) == 1
    snap = result[0]
    assert snap.customerId == "cust-001" and snap.complete and snap.eventTimeMs == 1006
    assert snap.scores == {"hydration": 72.5, "pigmentation": 38.0, "texture": 61.0, "wrinkle": 45.0, "radiance": 80.0, "overall": 68.5}
    assert snap.extras == {"skinToneLabel": "II", "topConcerns": "[hydration, pores]"} and snap.topConcerns == ["hydration", "pores"]


def test_missing_dimension_and_late_event(spark):
    rows = [
        scan("scan-hydration", "cust-002", "s2", 1, 1, 55.0), scan("scan-overall", None, "s2", 2, 2, 55.0),
        scan("scan-texture", "cust-002", "s2", 3, 3, 40.0), scan("customer-profile", "x", "s2", 4, 4),
    ]
    first, second = snapshots(spark.createDataFrame(rows, DDL), position="seq").orderBy("eventTimeMs").collect()
    assert first.scores == {"hydration": 55.0, "overall": 55.0} and "wrinkle" not in first.scores and first.customerId == "cust-002"
    assert second.scores == {"texture": 40.0} and not second.complete


def brute(rows, timeout):
    open_runs, done = {}, []

    def close(key):
        done.append(open_runs.pop(key))

    for stream, customer, scan_id, time, seq, *rest in sorted(rows, key=lambda r: (r[3], r[4])):
        key = scan_id or customer
        run = open_runs.get(key)
        if run and timeout and time >= run["first"] + timeout:
            close(key)
            run = None
        if run is None:
            run = open_runs[key] = {"key": key, "first": time, "events": 0, "scores": {}}
        run["events"] += 1
        if stream in FIELD and rest[FIELD[stream] - 5] is not None:
            run["scores"][stream] = rest[FIELD[stream] - 5]
        if stream == "scan-overall":
            close(key)
    return sorted((r["key"], r["first"], r["events"], sorted(r["scores"].values())) for r in [*done, *open_runs.values()])


@pytest.mark.parametrize("timeout", [None, 40])
@pytest.mark.parametrize("hot_rows, fold_rows", [(10_000, 10_000), (25, 10)])
def test_snapshots_equal_brute_force(spark, timeout, hot_rows, fold_rows):
    rng = random.Random(11)
    streams = [*FIELD, "scan-session"]
    rows = [
        scan(rng.choice(streams), f"c{rng.randrange(3)}", rng.choice(["hot", "hot", "hot", "s2", None]), rng.randrange(400), i,
             float(rng.randrange(100)) if rng.random() < 0.9 else None)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, DDL)
    result = snapshots(df, position="seq", timeout_ms=timeout, hot_rows=hot_rows, fold_rows=fold_rows).collect()
    assert sorted((r.scanId, r.firstEventMs, r.events, sorted(r.scores.values())) for r in result) == brute(rows, timeout)


def test_baselines(spark):
    rows = [("c", 0, {"hydration": 10.0, "texture": 1.0}), ("c", 1_799_999, {"hydration": 20.0}), ("c", 1_800_000, {"hydration": 5.0})]
    snaps = spark.createDataFrame(rows, "customerId string, eventTimeMs bigint, scores map<string,double>")
    nested = {r.windowStartMs: r.baseline for r in nest_baselines(baselines(snaps)).collect()}
    assert nested == {0: {"hydration": 15.0, "texture": 1.0}, 1_800_000: {"hydration": 5.0}}


def test_enrich_keeps_scans_without_session(spark):
    snaps = spark.createDataFrame([("s1", 1), ("s2", 2)], "scanId string, n int")
    sessions = spark.createDataFrame([("s1", 1, "A"), ("s1", 2, "B")], "scanId string, eventTime bigint, deviceId string")
    assert {(r.scanId, r.deviceId) for r in enrich_with_sessions(snaps, sessions, ["deviceId"]).collect()} == {("s1", "B"), ("s2", None)}


@pytest.mark.parametrize("hot_rows", [1000, 10])
def test_sessions(spark, hot_rows):
    times = [0, 10, 70, 129, 189, 300]
    rows = [("a", t, i) for i, t in enumerate(times)] + [("hot", t * 7 % 400, 100 + t) for t in range(60)]
    df = spark.createDataFrame(rows, "customerId string, eventTime bigint, seq bigint")
    result = session_activity(df, position="seq", gap_ms=60, hot_rows=hot_rows).where("customerId = 'a'").orderBy("sessionStartMs").collect()
    assert [(r.sessionStartMs, r.sessionEndMs, r.events) for r in result] == [(0, 70, 2), (70, 189, 2), (189, 249, 1), (300, 360, 1)]


def test_days(spark):
    df = spark.createDataFrame([("a", 0), ("a", 86_399_999), ("a", 86_400_000)], "customerId string, eventTime bigint")
    assert sorted(r.events for r in daily_activity(df, ["customerId"]).select(F.col("events")).collect()) == [1, 2]
