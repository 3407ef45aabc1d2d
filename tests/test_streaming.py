"""Streams in several micro-batches: equal to batch, restartable, late data."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice.config import AnomalyRule, SourceConfig, load_topology, topology_from_dict
from sluice.operators.anomaly import detect_anomalies
from sluice.operators.dedup import dedup
from sluice.operators.scans import baselines, closing_time, snapshots
from sluice.operators.verdict import ANOMALY, LIVE
from sluice.plans.quality import quality_verdicts
from sluice.session import scratch_path
from sluice.sources.readers import EVENT_TS, decode_json, read_batch, read_stream, stream_table, union_live, with_event_time
from sluice.plans.jobs import scan_analytics
from sluice.streaming.jobs import baselines_stream, ingest_stream, run_available, scan_analytics_stream
from sluice.streaming.late import window_sums_stream
from sluice.streaming.operators import dedup_stream, detect_anomalies_stream, snapshots_stream, stream_verdicts

DDL = "seq bigint, customerId string, eventTime bigint, v double"


def waves(spark, rows, ddl, cuts, label):
    """Write rows in arrival order as one folder per wave."""
    path = scratch_path(spark, label)
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    return path, [lambda p=part, n=n: spark.createDataFrame(p, ddl).coalesce(1).write.parquet(f"{path}/wave={n}") for n, part in enumerate(parts)]


def run_in_waves(spark, rows, ddl, cuts, build, label):
    """One run per wave on the same checkpoint: also a restart test."""
    path, writes = waves(spark, rows, ddl, cuts, label)
    out, state = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")
    for write in writes:
        write()
        live = spark.readStream.schema(spark.createDataFrame([], ddl).schema).parquet(path).drop("wave")
        result = run_available(build(live), label, out, state)
    return result


def events(count=240, seed=1):
    rng = random.Random(seed)
    times = sorted(rng.randrange(0, 6 * 3_600_000) for _ in range(count))
    return [(i, f"c{rng.randrange(4)}", t, rng.gauss(0, 1) if rng.random() < 0.9 else None) for i, t in enumerate(times)]


def test_chain_in_waves_equals_batch(spark):
    rows = events()
    definition = topology_from_dict(
        {
            "streams": [
                {
                    "key": "s",
                    "quality": {
                        "dedupKey": "customerId", "dedupTtlHours": 0.02, "requiredFields": ["customerId"],
                        "anomalyDetection": [{"field": "v", "threshold": 1.2}, {"field": "v", "threshold": 1.8, "windowRows": 8, "onAnomaly": "DLQ"}],
                    },
                }
            ]
        }
    ).streams[0]
    pick = lambda df: df.select("seq", LIVE, ANOMALY, F.size(F.coalesce("_failures", F.array().cast("array<struct<operator:string,reason:string,message:string>>"))).alias("n"))
    expected = pick(quality_verdicts(spark.createDataFrame(rows, DDL), definition, position="seq")).collect()
    build = lambda live: pick(stream_verdicts(with_event_time(live, lag_seconds=30), definition, position="seq"))
    got = run_in_waves(spark, rows, DDL, [70, 180], build, "chain").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
    assert any(r["n"] for r in got) and any(not r[LIVE] for r in got)


def test_single_operators_are_importable_twins(spark):
    rows = events(60, seed=4)
    df = spark.createDataFrame(rows, DDL)
    live = lambda build, label: run_in_waves(spark, rows, DDL, [30], build, label)
    marked = live(lambda s: dedup_stream(with_event_time(s, lag_seconds=1), ["customerId"], 0.5, position="seq").select("seq", LIVE), "d")
    assert sorted(map(tuple, marked.collect())) == sorted(map(tuple, dedup(df, ["customerId"], 0.5, position="seq").select("seq", LIVE).collect()))
    rule = [AnomalyRule("v", "THRESHOLD", threshold=-0.5)]
    flagged = live(lambda s: detect_anomalies_stream(s, rule, position="seq").select("seq", ANOMALY), "a")
    assert sorted(map(tuple, flagged.collect())) == sorted(map(tuple, detect_anomalies(df, rule, position="seq").select("seq", ANOMALY).collect()))


SCAN_DDL = "_stream_key string, customerId string, scanId string, eventTime bigint, seq bigint, overallHydrationScore float, overallSkinScore float"


def test_snapshots_in_waves_equal_batch(spark):
    rng = random.Random(9)
    times = sorted(rng.randrange(0, 3_600_000) for _ in range(150))
    rows = []
    for i, t in enumerate(times):
        done = rng.random() < 0.2
        rows.append(("scan-overall" if done else "scan-hydration", "c", f"s{rng.randrange(5)}", t, i, None if done else float(i), float(i) if done else None))
    rows.append(("scan-overall", "c", "end", 9_000_000, 999, None, 1.0))
    pick = lambda df: df.select("scanId", "firstEventMs", "eventTimeMs", "events", F.to_json("scores").alias("scores"), "complete")
    expected = pick(snapshots(spark.createDataFrame(rows, SCAN_DDL), position="seq", timeout_ms=120_000)).collect()
    build = lambda live: pick(snapshots_stream(with_event_time(live, lag_seconds=30), position="seq", timeout_ms=120_000))
    got = run_in_waves(spark, rows, SCAN_DDL, [40, 100], build, "snaps").collect()
    plain = lambda found: sorted((r.scanId, r.firstEventMs, r.eventTimeMs, r.events, sorted(eval(r.scores).items()), r.complete) for r in found)  # noqa: E731, S307
    assert plain(got) == plain(expected)


def test_streamed_means_equal_batch_means(spark):
    rng = random.Random(3)
    rows = []
    for i, t in enumerate(sorted(rng.randrange(0, 7_200_000) for _ in range(200))):
        done = rng.random() < 0.15
        rows.append(("scan-overall" if done else "scan-hydration", "c", f"s{rng.randrange(6)}", t, i, None if done else float(i), float(i) if done else None))
    rows.append(("scan-overall", "d", "end", 99_000_000, 999, None, 1.0))
    snaps = snapshots(spark.createDataFrame(rows, SCAN_DDL), position="seq", timeout_ms=120_000)
    assert snaps.where(~F.col("complete")).count() > 50
    expected = baselines(snaps.withColumn("closedMs", closing_time(120_000)), time="closedMs").where("customerId = 'c'").collect()
    got = run_in_waves(spark, rows, SCAN_DDL, [60, 150], lambda live: baselines_stream(with_event_time(live, lag_seconds=30), timeout_ms=120_000, position="seq"), "means").collect()
    plain = lambda found: sorted((r.windowStartMs, r.dimension, round(r["mean"], 6), r.snapshots) for r in found)
    assert plain(got) == plain(expected)


def test_scan_analytics_job_writes_both_tables(spark):
    path, root = scratch_path(spark, "scan-input"), scratch_path(spark, "scan-tables")
    ddl = "customerId string, scanId string, eventTime bigint, overallHydrationScore float, overallSkinScore float"
    spark.createDataFrame([("c", "s", 1000, 40.0, None), ("c", "s", 2000, 60.0, None), ("d", "t", 3000, 10.0, None), ("e", "u", 1_790_000, 20.0, None)], ddl).write.parquet(f"{path}/scan-hydration")
    spark.createDataFrame([("c", "s", 4000, None, 50.0), ("z", "end", 90_000_000, None, 1.0)], ddl).write.parquet(f"{path}/scan-overall")
    read = lambda key: spark.readStream.schema(spark.createDataFrame([], ddl).schema).parquet(f"{path}/{key}")
    for _ in range(2):  # the second run finds nothing new
        streams = {key: read(key) for key in ("scan-hydration", "scan-overall")}
        for running in scan_analytics_stream(streams, root, f"{root}-state", timeout_ms=60_000, available_now=True):
            running.awaitTermination()
    snaps = {(r.scanId, r.complete, r.events) for r in spark.read.parquet(f"{root}/snapshots").collect()}
    assert snaps == {("s", True, 3), ("t", False, 1), ("u", False, 1), ("end", True, 1)}
    means = {(r.customerId, r.dimension, r["mean"]) for r in spark.read.parquet(f"{root}/baselines").collect()}
    assert means == {("c", "hydration", 60.0), ("c", "overall", 50.0), ("d", "hydration", 10.0), ("e", "hydration", 20.0)}
    # the batch job counts a snapshot in the same window: "u" closed when its minute was up, after half past
    windows = lambda df: {(r.customerId, r.dimension, r.windowStartMs) for r in df.collect()}
    batch = scan_analytics({key: spark.read.parquet(f"{path}/{key}") for key in ("scan-hydration", "scan-overall")}, timeout_ms=60_000)[1]
    assert windows(batch) - {("z", "overall", 90_000_000)} == windows(spark.read.parquet(f"{root}/baselines"))
    assert ("e", "hydration", 1_800_000) in windows(batch)


def test_null_keys_and_positions_do_not_stop_a_stream(spark):
    rows = [(None, "a", 5, 1.0), (1, "a", 5, 2.0), (2, "a", 6, 3.0), (None, None, 7, 4.0), (3, None, 7, None), (None, "a", 5, 1.0)]
    definition = topology_from_dict(
        {"streams": [{"key": "s", "quality": {"dedupKey": "customerId", "requiredFields": ["seq"], "anomalyDetection": [{"field": "v"}]}}]}
    ).streams[0]
    for position in ("seq", None):
        build = lambda live, p=position: stream_verdicts(with_event_time(live, lag_seconds=30), definition, position=p).select("seq", "v", LIVE)
        got = run_in_waves(spark, rows, DDL, [3], build, "nulls").collect()
        assert len(got) == len(rows) and not any(r[LIVE] for r in got if r.seq is None)
        assert sum(r[LIVE] for r in got) == 2


def test_limits_below_a_millisecond_are_refused(spark):
    frame = spark.createDataFrame(events(5), DDL)
    for hours in (0, 1e-9):
        with pytest.raises(ValueError, match="millisecond"):
            dedup(frame, ["customerId"], hours, position="seq")


@pytest.mark.parametrize("carried", [False, True])
def test_ingest_stream_and_repeat(spark, carried):
    topology = load_topology()
    definition = topology.stream("customer-loyalty")
    root, source, state = (scratch_path(spark, n) for n in ("ingest", "ingest-in", "ingest-state"))
    ddl = "customerId string, eventTime bigint, eventType string, pointsDelta int, pointsBalance int, eventId string"

    def arrive(number, rows):
        spark.createDataFrame(rows, ddl).write.parquet(f"{source}/wave={number}")
        stream = read_stream(spark, definition, source).withColumn("eventId", F.concat_ws("-", "customerId", "eventTime", "pointsDelta"))
        tables = f"{root}/carried" if carried else None
        ingest_stream(stream, definition, topology.dlq, root, state, available_now=True, carried=tables).awaitTermination()

    arrive(1, [("c1", 1000, "ENROLLED", 5, 5, "1"), ("c2", 1000, "ENROLLED", 500_000, 5, "2")])
    arrive(2, [("c1", 1000, "ENROLLED", 5, 5, "3"), ("c3", 2000, "ENROLLED", 1, 1, "4")])
    clean = spark.read.parquet(f"{root}/customer_dev/customer_loyalty")
    assert sorted((r.customerId, r.tier) for r in clean.collect()) == [("c1", "BRONZE"), ("c3", "BRONZE")]
    dead = spark.read.parquet(f"{root}/system_dev/dlq_events")
    assert sorted(r.failure_reason for r in dead.collect()) == ["DUPLICATE_EVENT", "RANGE_FAIL"]


def test_decode_skips_and_counts(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,), ('{"a": "x"}',)], "value string")
    schema = spark.createDataFrame([], "a int").schema
    seen = Observation("decode")
    assert [r.a for r in decode_json(df, schema, skipped=seen).collect()] == [1]
    assert seen.get == {"skipped": 3, "read": 4}
    kept = decode_json(df, schema, keep_bad=True).collect()
    assert sorted(str(r["_corrupt"]) for r in kept) == ["", "None", '{"a": "x"}', "{broken"]


def test_read_batch_fills_missing_fields(spark):
    path = scratch_path(spark, "batch")
    spark.createDataFrame([("c", 5)], "customerId string, eventTime bigint").write.parquet(path)
    row = read_batch(spark, load_topology().stream("customer-loyalty"), path).first()
    assert (row.customerId, row.eventTime, row.pointsDelta) == ("c", 5, None)
    live = stream_table(spark, path, spark.read.parquet(path).schema)
    assert run_available(live, "copy").count() == 1


def test_a_silent_stream_does_not_hold_back_the_others(spark):
    """A live and a silent stream, each with a watermark of its own: the window of the live
    one closes after the idle time."""
    path = scratch_path(spark, "idle")
    old = int(time.time() * 1000) - 120_000
    ddl = "customerId string, eventTime bigint"
    spark.createDataFrame([("a", old), ("b", old + 1)], ddl).write.parquet(f"{path}/live")
    spark.createDataFrame([], ddl).write.parquet(f"{path}/silent")
    source = SourceConfig(type="FILE", watermark_lag_seconds=1, idle_timeout_seconds=3)
    read = lambda key: spark.readStream.schema(ddl).parquet(f"{path}/{key}")
    united = union_live({key: (read(key), source) for key in ("live", "silent")})
    counts = united.groupBy(F.window(EVENT_TS, "10 seconds")).agg(F.count(F.lit(1)).alias("n"))
    query = counts.writeStream.format("memory").queryName("idle_counts").outputMode("append").option("checkpointLocation", f"{path}/state").trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not spark.table("idle_counts").count():
            time.sleep(1)
        assert sum(r.n for r in spark.table("idle_counts").collect()) == 2
    finally:
        query.stop()


def test_late_rows_are_counted_and_kept_as_dead_letters(spark):
    ddl, width = "customerId string, eventTime bigint, v double", 10_000
    parts = [[("a", 1_000, 1.0), ("a", 12_000, 2.0), ("b", 50_000, 4.0)], [("a", 2_000, 8.0), ("b", 49_000, 16.0), ("a", None, 99.0)], [("z", 200_000, 0.0), ("b", 45_000, 32.0)]]
    path, root = scratch_path(spark, "late-input"), scratch_path(spark, "late-out")
    for n, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.parquet(f"{path}/wave={n}")
        live = spark.readStream.schema(ddl).parquet(path).drop("wave")
        window_sums_stream(live, ["customerId"], "v", width, 5, root, f"{root}/state", "k", available_now=True).awaitTermination()
    windows = {(r.customerId, r.windowStartMs): (r.events, r.total) for r in spark.read.parquet(f"{root}/windows").collect()}
    # the watermark is 45 s behind the first wave: the second's row of 2 s is late, that of 49 s is not
    assert windows == {("a", 0): (1, 1.0), ("a", 10_000): (1, 2.0), ("b", 40_000): (2, 48.0), ("b", 50_000): (1, 4.0)}
    dead = spark.read.parquet(f"{root}/late").collect()
    assert [(r.failure_reason, r.original_customer_id, r.original_event_time_ms) for r in dead] == [("LATE_EVENT", "a", 2_000)]
    versions = sorted(p.name for p in Path(root.removeprefix("file:"), "clock").iterdir() if p.name.startswith("version"))
    assert versions == ["version=1", "version=2"]
