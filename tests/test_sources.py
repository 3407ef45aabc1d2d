"""Connectors by plan, and payloads routed by the id of their schema."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from sluice.config import SourceConfig, topology_from_dict
from sluice.sources import readers
from sluice.sources.readers import DECODE_ERROR, decode_by_id, json_decoders, undecoded_letters


def framed(number, body):
    return bytes([0]) + number.to_bytes(4, "big") + (body if isinstance(body, bytes) else json.dumps(body).encode())


def test_each_payload_meets_its_writers_schema_once(spark):
    reader = T.StructType.fromDDL("id bigint, name string, tier string")
    writers = {
        7: T.StructType.fromDDL("id bigint, name string"),
        3_000_000_000: T.StructType.fromDDL("id string, name string, tier string, dropped int"),
    }
    payloads = [
        framed(7, {"id": 1, "name": "a"}), framed(3_000_000_000, {"id": "2", "name": "b", "tier": "GOLD", "dropped": 5}),
        framed(8, {"id": 3}), bytes([1]) + framed(7, {"id": 4})[1:], b"", b"\x00\x00\x00", None, framed(7, b"{broken"), framed(7, b""),
        framed(7, {"id": 9, "customerId": "x"}), framed(3_000_000_000, {"id": "no number", "name": "c"}),
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "offset int, value binary")
    decoded = decode_by_id(df, json_decoders(writers, reader, {"tier": "BRONZE"}))
    assert decoded.columns == ["offset", "id", "name", "tier", "_payload", DECODE_ERROR]
    rows = {r.offset: r for r in decoded.collect()}
    good = {i: (r.id, r.name, r.tier) for i, r in rows.items() if r[DECODE_ERROR] is None}
    assert good == {0: (1, "a", "BRONZE"), 1: (2, "b", "GOLD"), 9: (9, None, "BRONZE"), 10: (None, "c", None)}
    assert {i: r[DECODE_ERROR] for i, r in rows.items() if i not in good} == {
        2: "UNKNOWN_SCHEMA_ID", 3: "BAD_HEADER", 4: "BAD_HEADER", 5: "BAD_HEADER", 6: "BAD_HEADER", 7: "BAD_PAYLOAD", 8: "BAD_PAYLOAD"}
    assert bytes(rows[2]._payload) == payloads[2] and rows[0]._payload is None
    letters = {json.loads(r.original_json)["offset"]: r for r in undecoded_letters(decoded, "k").collect()}
    assert set(letters) == {2, 3, 4, 5, 6, 7, 8} and letters[2].failure_reason == "UNKNOWN_SCHEMA_ID" and letters[2].stream_key == "k"
    assert json.loads(letters[2].original_json)["_payload"]
    with pytest.raises(ValueError, match="decoder"):
        decode_by_id(df, {})


class Recorder:
    """Stands in for ``spark.read``: keeps format and options, gives a frame of payloads."""

    def __init__(self, frame):
        self.frame, self.seen = frame, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self, *_):
        return self.frame


def stream_of(source):
    return topology_from_dict({"streams": [{"key": "customer-loyalty", "source": source}]}).streams[0]


@pytest.mark.parametrize("kind, payload, expected", [
    ("KAFKA", "value", {"format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest"}),
    ("KINESIS", "data", {"format": "kinesis", "startingPosition": "TRIM_HORIZON", "streamName": "n"}),
])
def test_bus_sources_by_plan(spark, kind, payload, expected):
    source = {"type": kind, "startingPosition": "TRIM_HORIZON"}
    source |= {"bootstrapServers": "b:1", "topic": "t"} if kind == "KAFKA" else {"options": {"streamName": "n"}}
    body = json.dumps({"customerId": "c", "eventTime": 5, "pointsDelta": 3}).encode()
    reader = Recorder(spark.createDataFrame([(body,), (b"{broken",)], f"{payload} binary"))
    session = type("Session", (), {"read": reader})()
    rows = readers.read_batch(session, stream_of(source)).collect()
    assert reader.seen == expected
    assert [(r.customerId, r.eventTime, r.pointsDelta) for r in rows] == [("c", 5, 3)]


def test_latest_is_the_default_and_unknown_sources_are_refused(spark):
    reader = Recorder(spark.createDataFrame([], "value binary"))
    session = type("Session", (), {"read": reader})()
    readers.read_batch(session, stream_of({"type": "KAFKA", "bootstrapServers": "b:1"}))
    assert reader.seen["startingOffsets"] == "latest" and reader.seen["subscribe"] == "customer-loyalty"
    with pytest.raises(NotImplementedError):
        readers.read_batch(session, stream_of({"type": "NATS"}))
    with pytest.raises(ValueError, match="avroSchema"):
        readers.decode(reader.frame, stream_of({"type": "KAFKA", "format": "avro"}))


def test_avro_decoders_are_made_per_id(spark, monkeypatch):
    """The Avro module is no part of Spark's default class path; its calls are checked instead."""
    calls = []

    def from_avro(column, schema, options):
        calls.append((schema, options))
        return F.from_json(column.cast("string"), "a int")

    monkeypatch.setattr("pyspark.sql.avro.functions.from_avro", from_avro)
    options = {"avroSchema": "READER", "avroSchemas": json.dumps({"1": {"type": "record"}, "2": "TEXT"})}
    definition = stream_of({"type": "KAFKA", "format": "avro", "options": options})
    df = spark.createDataFrame([(framed(1, {"a": 1}),), (framed(2, {"a": 2}),), (framed(3, {"a": 3}),)], "value binary")
    assert sorted(r.a for r in readers.decode(df, definition).collect()) == [1, 2]
    assert calls == [('{"type": "record"}', {"mode": "PERMISSIVE", "avroSchema": "READER"}), ("TEXT", {"mode": "PERMISSIVE", "avroSchema": "READER"})]
    assert SourceConfig(type="KAFKA").lag_seconds == 10
