"""Topology model, linting and the stream schemas."""

import json

import pytest
from pyspark.sql import types as T

from sluice.config import lint_topology, load_topology, topology_from_dict
from sluice.plans.quality import attach_quality, stateless_verdicts
from sluice.schemas import STREAM_KEYS, align_to_schema, read_schema, schema_defaults, stream_schema

pytestmark = pytest.mark.usefixtures("spark")  # Spark parses the schemas


def test_shipped_topology():
    topology = load_topology()
    assert len(topology.streams) == 19 and {s.key for s in topology.streams} == set(STREAM_KEYS)
    assert all(s.lake_sink is not None and s.source is not None for s in topology.streams)
    profile = topology.stream("customer-profile")
    assert "customerId" in profile.quality.required_fields and "email" in profile.sensitive_fields
    assert profile.lake_table == "customer.customer_profiles" and profile.lake_sink.partition_columns
    assert (topology.dlq.type, topology.dlq.database, topology.dlq.table) == ("ICEBERG", "system", "dlq_events")
    assert len(topology.scan_streams) == 8
    assert topology.stream("device-telemetry").watermark_lag_seconds == 10
    assert lint_topology(topology) == []


def test_camel_case_and_unknown_keys(tmp_path):
    document = {
        "pipeline": {"name": "p", "note": "ignored"},
        "streams": [
            {
                "key": "customer-loyalty",
                "streamType": "CUSTOMER",
                "source": {"type": "KAFKA", "topic": "t"},
                "schema": {"avroFile": "customer-loyalty.avsc"},
                "quality": {
                    "dedupKey": "eventId", "dedupTtlHours": 48, "fieldDefaults": {"tier": "STANDARD", "pointsDelta": "1.0"},
                    "fieldValidations": [{"field": "points", "rule": "RANGE", "min": 0}, {"field": "tier", "rule": "REGEX", "pattern": "("}],
                    "anomalyDetection": [{"field": "pointsDelta", "windowMinutes": 5}],
                },
                "sinks": [{"type": "DATABRICKS_DELTA", "mode": "JDBC", "jdbcUrl": "jdbc:x", "targetTable": "t"}],
            }
        ],
    }
    path = tmp_path / "t.json"
    path.write_text(json.dumps(document))
    topology = load_topology(path)
    stream = topology.streams[0]
    assert stream.watermark_lag_seconds == 10 and stream.lake_sink is None and stream.lake_table is None
    assert stream.quality.anomaly_detection[0].window_minutes == 5 and stream.quality.anomaly_detection[0].rows is None
    problems = {(f.field, f.problem.split(" ")[0]) for f in lint_topology(topology)}
    assert ("eventId", "dedup") in problems and ("points", "RANGE") in problems
    assert ("tier", "default") in problems and ("pointsDelta", "default") in problems and ("tier", "invalid") in problems


@pytest.mark.parametrize("bad", [{"streams": []}, {"streams": [{"key": "x", "streamType": "NO"}]}])
def test_bad_topologies(bad):
    with pytest.raises(ValueError):
        topology_from_dict(bad)


def test_schemas():
    profile = stream_schema("customer-profile")
    assert len(profile.fields) == 16 and not profile["countryCode"].nullable and profile["email"].nullable
    assert [len(stream_schema(k).fields) for k in STREAM_KEYS] == [16, 12, 12, 10, 12, 14, 13, 10, 12, 12, 14, 12, 14, 16, 9, 9, 14, 10, 16]
    items = stream_schema("commerce-orders")["lineItems"].dataType
    assert isinstance(items.elementType, T.StructType) and items.elementType.names == ["productId", "sku", "quantity", "unitPrice", "currency"]
    assert schema_defaults("customer-loyalty") == {"schemaVersion": 1, "metadata": {}, "eventType": "POINTS_EARNED", "tier": "BRONZE"}


def test_align_adds_casts_and_keeps_extras(spark):
    df = spark.createDataFrame([("c", "17", "extra")], "customerId string, eventTime string, more string")
    aligned = align_to_schema(df, stream_schema("customer-loyalty"), schema_defaults("customer-loyalty"))
    row = aligned.first()
    assert (row.eventTime, row.tier, row.metadata, row.more, row.pointsDelta) == (17, "BRONZE", {}, "extra", None)


def test_every_stream_builds_a_plan(spark):
    for definition in load_topology().streams:
        empty = spark.createDataFrame([], read_schema(definition.key))
        verdicts = stateless_verdicts(empty, definition)
        assert verdicts.columns[-4:] == ["_live", "_failures", "_anomaly", "_before"], definition.key


def test_no_quality_block_passes_everything(spark):
    definition = topology_from_dict({"streams": [{"key": "free"}]}).streams[0]
    clean, dlq = attach_quality(spark.createDataFrame([(1,), (None,)], "a int"), definition)
    assert clean.columns == ["a"] and clean.count() == 2 and dlq.count() == 0
