"""Encryption, targets, dead letters, and the ingestion job."""

import base64
import hashlib
import hmac
import logging
import struct

import pytest
from pyspark.sql import functions as F

from sluice.config import DeadLetterConfig, SinkConfig, load_topology, topology_from_dict
from sluice.functions.crypto import decrypt_field, encrypt_fields, pseudonymize
from sluice.plans.jobs import ingest, scan_analytics
from sluice.plans.quality import quality_verdicts
from sluice.schemas import read_schema
from sluice.session import scratch_path
from sluice.sinks.deadletter import dlq_path, erase_dead_letters, failed_records, replay, write_dlq
from sluice.sinks.fanout import fan_out, sink_writer, write_sinks
from sluice.sinks.compact import compact, read_lake
from sluice.sinks.buckets import read_upserts, upsert_version, versions
from sluice.sinks.lake import ensure_table, table_path, write_lake
from sluice.sinks.rows import bus_rows, jdbc_rows

KEY = bytes(range(32))


def test_encryption_layout_and_round_trip(spark):
    df = spark.createDataFrame([("Ada", 5), (None, None)], "name string, n int")
    sealed = encrypt_fields(df, ["name", "n", "absent"], KEY, b"wrapped-key")
    row = sealed.first()
    raw = base64.b64decode(row.name)
    assert struct.unpack(">i", raw[:4])[0] == 11 and raw[4:15] == b"wrapped-key" and len(raw) == 4 + 11 + 12 + 3 + 16
    plain = sealed.select(decrypt_field(F.col("name"), KEY), decrypt_field(F.col("n"), KEY)).collect()
    assert [tuple(r) for r in plain] == [("Ada", "5"), (None, None)]
    assert encrypt_fields(df, ["name"], None, enabled=False).first().name == "Ada"
    with pytest.raises(ValueError):
        encrypt_fields(df, ["name"], b"short")


@pytest.mark.parametrize("secret", [b"s", b"x" * 100])
def test_pseudonym_is_hmac(spark, secret):
    got = spark.createDataFrame([("c1",)], "id string").select(pseudonymize(F.col("id"), secret)).first()[0]
    assert got == hmac.new(secret, b"c1", hashlib.sha256).hexdigest()


def test_jdbc_and_bus_rows(spark):
    df = spark.createDataFrame([("c", None, 1.5)], "customerId string, eventTime bigint, amount double")
    assert tuple(jdbc_rows(df, "orders").first()) == ("orders", "c", 0, '{"customerId":"c","amount":1.5}')
    assert tuple(bus_rows(df, "customerId").first()) == ("c", '{"customerId":"c","amount":1.5}')


def test_table_creation_and_layout(spark):
    root = scratch_path(spark, "tables")
    sink = SinkConfig(type="ICEBERG", database="customer", table="loyalty", partition_columns=["eventDate", "tier", "absent"])
    for _ in range(2):
        name = ensure_table(spark, sink, read_schema("customer-loyalty"), root, "test", "t_")
    assert name == "`t_customer_test`.`loyalty`" and table_path(root, sink, "test", "t_").endswith("/t_customer_test/loyalty")
    partitions = [r.col_name for r in spark.sql(f"DESCRIBE {name}").collect()]
    assert partitions[-2:] == ["eventDate", "tier"]
    spark.sql("DROP TABLE t_customer_test.loyalty")
    spark.sql("DROP DATABASE t_customer_test")


def test_skewed_partition_gets_several_files(spark):
    path = scratch_path(spark, "skew")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(60_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lit("hot2")).alias("day"), F.uuid().alias("x"))
        write_lake(df.repartition(8), path, ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).where("day = 'hot2'").select(F.input_file_name()).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 60_000


def test_sinks_without_target_warn(spark, caplog):
    with caplog.at_level(logging.WARNING):
        fan_out(spark.range(1), [], "lonely")
    assert "lonely" in caplog.text
    definition = load_topology().streams[0]
    for kind in ("REDSHIFT", "ELASTICSEARCH", "DREMIO_FLIGHT"):
        with pytest.raises(NotImplementedError):
            sink_writer(definition, SinkConfig(type=kind), "/r", "dev")


def test_upsert_sink_versions_by_batch(spark):
    root = scratch_path(spark, "upserts")
    definition = topology_from_dict(
        {"streams": [{"key": "k", "sinks": [{"type": "ICEBERG", "database": "d", "table": "t", "writeMode": "UPSERT", "upsertKey": "id"}]}]}
    ).streams[0]
    ddl = "id string, eventTime bigint, v string"
    write_sinks(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("a", 2, "z")], ddl), definition, root, "dev", batch_id=0)
    for _ in range(2):  # a repeated batch changes nothing
        write_sinks(spark.createDataFrame([("b", 5, "new"), ("c", 5, "c")], ddl), definition, root, "dev", batch_id=1)
    rows = read_upserts(spark, f"{root}/d_dev/t").collect()
    assert {(r.id, r.v) for r in rows} == {("a", "z"), ("b", "new"), ("c", "c")} and len(rows) == 3


def test_batch_upserts_keep_what_is_there(spark):
    root = scratch_path(spark, "upserts")
    definition = topology_from_dict(
        {"streams": [{"key": "k", "sinks": [{"type": "ICEBERG", "database": "d", "table": "t", "writeMode": "UPSERT", "upsertKey": "id"}]}]}
    ).streams[0]
    ddl = "id string, eventTime bigint, v string, _stream_key string, _anomaly boolean"
    waves = [[("a", 1, "x"), ("b", 9, "y"), (None, 1, "n")], [("c", 5, "c"), (None, 2, "m")], [("b", 3, "older"), ("a", 1, "x2")], [("b", 3, "older")]]
    for wave in waves:
        write_sinks(spark.createDataFrame([(*r, "k", False) for r in wave], ddl), definition, root, "dev")
    table = read_upserts(spark, f"{root}/d_dev/t")
    assert {tuple(r) for r in table.collect()} == {("a", 1, "x2"), ("b", 9, "y"), ("c", 5, "c"), (None, 2, "m")}
    assert table.columns == ["id", "eventTime", "v"]
    assert {name for name, _ in versions(spark, f"{root}/d_dev/t").values()} == {"version=2", "version=3"}


def data_files(spark, table):
    return {r[0] for r in read_upserts(spark, table).select(F.input_file_name()).distinct().collect()}


def test_an_update_leaves_other_buckets_alone(spark):
    table = scratch_path(spark, "buckets")
    rows = spark.range(400).select(F.concat(F.lit("k"), F.col("id")).alias("id"), F.lit(1).cast("bigint").alias("eventTime"), F.lit("old").alias("v"))
    upsert_version(rows, ["id"], ["eventTime"], table, buckets=16)
    before = data_files(spark, table)
    new = spark.createDataFrame([("k7", 2, "new", 5)], "id string, eventTime bigint, v string, extra int")
    upsert_version(new, ["id"], ["eventTime"], table)
    after = data_files(spark, table)
    assert len(before - after) == 1 and len(after - before) == 1 and len(after & before) >= 14
    found = {r["id"]: (r["v"], r["extra"]) for r in read_upserts(spark, table).collect()}
    assert len(found) == 400 and found["k7"] == ("new", 5) and found["k8"] == ("old", None)
    upsert_version(new.limit(0), ["id"], ["eventTime"], table)  # nothing to do
    assert max(versions(spark, table)) == 1
    upsert_version(rows.limit(3), ["id"], ["eventTime"], table)  # columns of other buckets stay
    assert "extra" in read_upserts(spark, table).columns and read_upserts(spark, table).count() == 400
    parts = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/data")
    folders = [e.getPath().getName() for e in parts.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(parts)]
    assert len(folders) <= 3  # the first, and those of the last two upserts


def test_a_failed_upsert_leaves_the_table_and_is_cleaned(spark):
    table = scratch_path(spark, "buckets")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "id string, eventTime bigint")
    upsert_version(rows, ["id"], ["eventTime"], table, batch_id=0)
    rows.write.parquet(f"{table}/data/left-by-a-lost-driver/_bucket=3")
    rows.write.parquet(f"{table}/manifests/version=1.batch=1")
    spark._jvm.org.apache.hadoop.fs.Path(table).getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/manifests/version=1.batch=1/_SUCCESS"), False)
    assert read_upserts(spark, table).count() == 2
    upsert_version(spark.createDataFrame([("c", 1)], "id string, eventTime bigint"), ["id"], ["eventTime"], table, batch_id=1)
    assert {r["id"] for r in read_upserts(spark, table).collect()} == {"a", "b", "c"}


def test_micro_batches_are_not_appended_to_row_level_tables(spark):
    sink = SinkConfig(type="ICEBERG", database="d", table="t")
    with pytest.raises(ValueError, match="not repeatable"):
        sink_writer(load_topology().streams[0], sink, "/r", "dev", batch_id=3, fmt="iceberg")


def loyalty(spark, rows):
    full = [(c, 1, t, "POINTS_EARNED", d, 10, tier, None, None, {}) for c, t, d, tier in rows]
    return spark.createDataFrame(full, read_schema("customer-loyalty"))


def test_ingestion_job_and_replay(spark):
    root = scratch_path(spark, "job")
    topology = load_topology()
    definition = topology.stream("customer-loyalty")
    rows = [("c1", 1000, 5, None), ("c1", 1000, 5, "GOLD"), ("c2", 2000, 999_999, "GOLD"), (None, 3000, 1, "GOLD"), ("c3", 4000, 7, "GOLD")]
    ingest(loyalty(spark, rows), definition, topology.dlq, root, "dev")
    clean = spark.read.parquet(f"{root}/customer_dev/customer_loyalty")
    assert {(r.customerId, r.pointsDelta) for r in clean.collect()} == {("c1", 5), ("c3", 7)}
    assert "eventDate" in clean.columns and "_stream_key" not in clean.columns
    dead = spark.read.parquet(f"{root}/system_dev/dlq_events")
    assert sorted(r.failure_reason for r in dead.collect()) == ["DUPLICATE_EVENT", "MISSING_REQUIRED_FIELD", "RANGE_FAIL"]
    relaxed = topology_from_dict({"streams": [{"key": "customer-loyalty", "quality": {"requiredFields": ["customerId"]}}]}).streams[0]
    again = replay(spark, f"{root}/system_dev/dlq_events", relaxed, reasons=["RANGE_FAIL", "MISSING_REQUIRED_FIELD"])
    assert [r.pointsDelta for r in again.clean.collect()] == [999_999] and again.dlq.count() == 1


def test_sealed_dead_letters(spark):
    root, key = scratch_path(spark, "sealed"), b"k" * 32
    definition = topology_from_dict(
        {"streams": [{"key": "k", "quality": {"requiredFields": ["id"], "sensitiveFields": ["mail"]}}]}
    ).streams[0]
    ddl = "id string, customerId string, eventTime bigint, mail string"
    rows = spark.createDataFrame([(None, "c1", 1, "a@b.cc"), (None, "c2", 2, "d@e.ff"), ("x", "c1", 3, None)], ddl)
    ingest(rows, definition, DeadLetterConfig(), root, "dev", data_key=key)
    path = dlq_path(DeadLetterConfig(), root, "dev")
    dead = spark.read.parquet(path)
    assert dead.count() == 2 and not any("@" in r.original_json for r in dead.collect())
    records = failed_records(dead, "k", rows.schema, data_key=key)
    assert {(r.customerId, r.mail) for r in records.collect()} == {("c1", "a@b.cc"), ("c2", "d@e.ff")}
    erase_dead_letters(spark, spark.createDataFrame([("c1",)], "customerId string"), path, f"{path}-erased")
    assert [r.original_customer_id for r in spark.read.parquet(f"{path}-erased").collect()] == ["c2"]


def test_bad_patterns_stop_the_plan(spark):
    definition = topology_from_dict(
        {"streams": [{"key": "k", "quality": {"fieldValidations": [{"field": "id", "rule": "REGEX", "pattern": "(?P<x>a"}]}}]}
    ).streams[0]
    with pytest.raises(ValueError, match="does not compile"):
        quality_verdicts(spark.createDataFrame([("a",)], "id string"), definition)


def test_dead_letters_as_json_lines(spark):
    path = scratch_path(spark, "dlq-json")
    write_dlq(spark.createDataFrame([("s", "r")], "stream_key string, failure_reason string"), DeadLetterConfig(type="S3"), path)
    assert spark.read.json(path).first().failure_reason == "r"


def test_scan_analytics_job(spark):
    hydration = spark.createDataFrame([("c", "s", 10, 1, 40.0)], "customerId string, scanId string, eventTime bigint, seq bigint, overallHydrationScore float")
    overall = spark.createDataFrame([("c", "s", 20, 2, 60.0)], "customerId string, scanId string, eventTime bigint, seq bigint, overallSkinScore float")
    snaps, base = scan_analytics({"scan-hydration": hydration, "scan-overall": overall}, position="seq")
    assert snaps.first().scores == {"hydration": 40.0, "overall": 60.0}
    assert {(r.dimension, r["mean"]) for r in base.collect()} == {("hydration", 40.0), ("overall", 60.0)}


def file_sizes(spark, path):
    files = {r[0] for r in read_lake(spark, path).select(F.input_file_name()).distinct().collect()}
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return {f: system.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)).getLen() for f in files}


@pytest.mark.parametrize("columns", [[], ["day"]])
def test_small_batches_become_files_of_the_right_size(spark, columns):
    path, target = scratch_path(spark, "lake"), 60_000
    batch = lambda k: spark.range(k * 1000, k * 1000 + 1000).select(F.col("id"), F.when(F.col("id") % 10 < 7, "hot").otherwise(F.lit("cold")).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    for k in range(8):
        write_lake(batch(k), f"{path}/batch_id={k}", columns, mode="overwrite")
    batch(99).write.parquet(f"{path}/batch_id=99/left-by-a-failed-write")
    before = read_lake(spark, path)
    assert before.count() == 8000
    assert compact(spark, path, columns, target) == 8 and compact(spark, path, columns, target) == 0
    sizes = file_sizes(spark, path)
    assert all("_compacted" in f for f in sizes) and all(0.5 * target <= n <= 1.5 * target for n in sizes.values()), sizes
    assert before.count() == 8000  # a reader that began before has its files
    write_lake(batch(8), f"{path}/batch_id=8", columns, mode="overwrite")
    assert read_lake(spark, path).count() == 9000
    assert compact(spark, path, columns, target) == 1
    rows = read_lake(spark, path)
    assert rows.count() == 9000 and rows.select("id").distinct().count() == 9000 and set(rows.columns) == {"id", "day", "x"}
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=3"))
