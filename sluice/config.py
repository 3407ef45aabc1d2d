"""The topology model: streams, their rules and their targets, as plain data.

``load_topology`` accepts YAML or JSON text files with camelCase keys; unknown
keys are ignored, so files written for other readers load too.
"""

from __future__ import annotations

import dataclasses
import json
import re
import types
import typing
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

DEFAULT_TOPOLOGY = Path(__file__).parent / "resources" / "topology.yml"

# The words a topology file may use.
STREAM_TYPES = ("CUSTOMER", "SCAN", "PRODUCT", "COMMERCE", "DEVICE", "UNKNOWN")
NULL_STRATEGIES = ("DROP_RECORD", "FILL_DEFAULT", "FORWARD")
COERCION_TYPES = ("ISO8601_STRING", "EPOCH_MILLIS", "UPPERCASE_ENUM", "LOWERCASE_STRING", "TRIM_STRING", "NUMERIC_STRING")
VALIDATION_RULES = ("REGEX", "RANGE", "NOT_EMPTY", "ENUM_VALUE")
FAIL_ACTIONS = ("DLQ", "FILL_DEFAULT", "DROP_RECORD", "FORWARD")
ANOMALY_METHODS = ("STDDEV", "IQR", "THRESHOLD", "IQR_EXACT")
ANOMALY_ACTIONS = ("FLAG_AND_FORWARD", "DLQ", "DROP_RECORD")
SINK_TYPES = ("ICEBERG", "DREMIO_FLIGHT", "DATABRICKS_DELTA", "REDSHIFT", "ELASTICSEARCH")
DEAD_LETTER_TYPES = ("ICEBERG", "KAFKA", "S3")


def _one_of(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")


@dataclass(frozen=True)
class SourceConfig:
    type: str = "KINESIS"
    watermark_lag_seconds: int | None = None
    idle_timeout_seconds: int = 300
    stream_name_param_path: str | None = None
    bootstrap_servers: str | None = None
    topic: str | None = None
    format: str | None = None
    path: str | None = None
    starting_position: str = "LATEST"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def lag_seconds(self) -> int:
        if self.watermark_lag_seconds is not None:
            return self.watermark_lag_seconds
        return 10 if self.type == "KAFKA" else 30


@dataclass(frozen=True)
class SchemaConfig:
    avro_file: str | None = None
    name: str | None = None


@dataclass(frozen=True)
class TypeCoercion:
    field: str
    from_type: str | None = None
    to_type: str | None = None

    def __post_init__(self) -> None:
        for word in (self.from_type, self.to_type):
            if word is not None:
                _one_of(word, COERCION_TYPES, "coercion type")


@dataclass(frozen=True)
class FieldValidation:
    field: str
    rule: str
    pattern: str | None = None
    min: float | None = None
    max: float | None = None
    allowed_values: list[str] | None = None
    on_fail: str = "DLQ"
    default_value: str | None = None

    def __post_init__(self) -> None:
        _one_of(self.rule, VALIDATION_RULES, "validation rule")
        _one_of(self.on_fail, FAIL_ACTIONS, "onFail")


@dataclass(frozen=True)
class AnomalyRule:
    field: str
    method: str = "STDDEV"
    window_minutes: int = 60
    threshold: float = 3.0
    on_anomaly: str = "FLAG_AND_FORWARD"
    window_rows: int | None = None

    def __post_init__(self) -> None:
        _one_of(self.method, ANOMALY_METHODS, "anomaly method")
        _one_of(self.on_anomaly, ANOMALY_ACTIONS, "onAnomaly")

    @property
    def rows(self) -> int | None:
        """Size of the sample window. Exact quartiles need one; the file's
        minutes stand for one sample a second."""
        if self.window_rows is not None:
            return self.window_rows
        return 60 * self.window_minutes if self.method == "IQR_EXACT" else None


@dataclass(frozen=True)
class QualityConfig:
    dedup_key: str | list[str] | None = None
    dedup_ttl_hours: float = 24
    required_fields: list[str] = field(default_factory=list)
    null_strategy: str = "FORWARD"
    field_defaults: dict[str, str] = field(default_factory=dict)
    type_coercions: list[TypeCoercion] = field(default_factory=list)
    field_validations: list[FieldValidation] = field(default_factory=list)
    anomaly_detection: list[AnomalyRule] = field(default_factory=list)
    anomaly_key: str | None = None
    sensitive_fields: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        _one_of(self.null_strategy, NULL_STRATEGIES, "nullStrategy")

    @property
    def dedup_fields(self) -> list[str]:
        if not self.dedup_key:
            return []
        return [self.dedup_key] if isinstance(self.dedup_key, str) else list(self.dedup_key)


@dataclass(frozen=True)
class SinkConfig:
    type: str
    database: str = ""
    table: str = ""
    partition_columns: list[str] = field(default_factory=list)
    write_mode: str = "APPEND"
    upsert_key: str | list[str] | None = None
    mode: str = "DELTA"
    delta_path: str | None = None
    jdbc_url: str | None = None
    target_table: str | None = None
    format: str | None = None

    def __post_init__(self) -> None:
        _one_of(self.type, SINK_TYPES, "sink type")
        _one_of(self.write_mode, ("APPEND", "UPSERT"), "writeMode")
        _one_of(self.mode, ("DELTA", "JDBC"), "sink mode")

    @property
    def upsert_fields(self) -> list[str]:
        if not self.upsert_key:
            return []
        return [self.upsert_key] if isinstance(self.upsert_key, str) else list(self.upsert_key)


@dataclass(frozen=True)
class DeadLetterConfig:
    type: str = "ICEBERG"
    database: str = "system"
    table: str = "dlq_events"
    path: str | None = None
    topic: str | None = None
    bootstrap_servers: str | None = None

    def __post_init__(self) -> None:
        _one_of(self.type, DEAD_LETTER_TYPES, "dlq type")


@dataclass(frozen=True)
class StreamDefinition:
    key: str
    stream_type: str = "UNKNOWN"
    source: SourceConfig | None = None
    schema: SchemaConfig = field(default_factory=SchemaConfig)
    quality: QualityConfig | None = None
    sinks: list[SinkConfig] = field(default_factory=list)

    def __post_init__(self) -> None:
        _one_of(self.stream_type, STREAM_TYPES, "streamType")

    @property
    def is_scan_stream(self) -> bool:
        return self.stream_type == "SCAN"

    @property
    def sensitive_fields(self) -> list[str]:
        return list(self.quality.sensitive_fields) if self.quality else []

    @property
    def watermark_lag_seconds(self) -> int:
        return self.source.lag_seconds if self.source else 30

    @property
    def lake_sink(self) -> SinkConfig | None:
        return next((sink for sink in self.sinks if sink.type == "ICEBERG"), None)

    @property
    def lake_table(self) -> str | None:
        sink = self.lake_sink
        return f"{sink.database}.{sink.table}" if sink else None


@dataclass(frozen=True)
class PipelineConfig:
    name: str = "pipeline"
    checkpoint_interval_ms: int = -1
    parallelism: int = -1


@dataclass(frozen=True)
class Topology:
    pipeline: PipelineConfig = field(default_factory=PipelineConfig)
    dlq: DeadLetterConfig = field(default_factory=DeadLetterConfig)
    streams: list[StreamDefinition] = field(default_factory=list)

    def stream(self, key: str) -> StreamDefinition:
        for definition in self.streams:
            if definition.key == key:
                return definition
        raise KeyError(key)

    @property
    def scan_streams(self) -> list[StreamDefinition]:
        return [definition for definition in self.streams if definition.is_scan_stream]


def _snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def _convert(annotation: Any, value: Any) -> Any:
    """Build nested dataclasses from nested mappings, guided by annotations."""
    if value is None:
        return None
    options = typing.get_args(annotation)
    origin = typing.get_origin(annotation)
    if origin in (typing.Union, types.UnionType):
        inner = [option for option in options if option is not type(None)]
        picked = next((o for o in inner if typing.get_origin(o) is list), inner[0]) if isinstance(value, list) else inner[0]
        return _convert(picked, value)
    if origin is list:
        return [_convert(options[0], item) for item in value]
    if origin is dict:
        return {str(k): str(v) for k, v in value.items()}
    if dataclasses.is_dataclass(annotation):
        return _build(annotation, value)
    if annotation in (str, int, float):
        return annotation(value)
    return value


def _build(cls: type, mapping: dict[str, Any]) -> Any:
    hints = typing.get_type_hints(cls)
    known = {_snake(key): value for key, value in mapping.items()}
    return cls(**{name: _convert(hints[name], known[name]) for name in hints if known.get(name) is not None})


def topology_from_dict(document: dict[str, Any]) -> Topology:
    topology = _build(Topology, document)
    if not topology.streams:
        raise ValueError("the topology declares no streams")
    return topology


def load_topology(path: str | Path | None = None) -> Topology:
    text = Path(path or DEFAULT_TOPOLOGY).read_text(encoding="utf-8")
    if str(path or DEFAULT_TOPOLOGY).endswith(".json"):
        return topology_from_dict(json.loads(text))
    import yaml

    return topology_from_dict(yaml.safe_load(text))


@dataclass(frozen=True)
class Finding:
    """One thing in a topology that would not do what it says."""

    stream: str
    field: str
    problem: str


def _castable(default: str, data_type: str) -> bool:
    try:
        if data_type in ("integer", "long", "short", "byte"):
            return re.fullmatch(r"\s*[+-]?\d+\s*", default) is not None
        if data_type in ("double", "float"):
            float(default)
        if data_type == "boolean":
            return default.strip().lower() in ("true", "false")
    except ValueError:
        return False
    return data_type in ("string", "double", "float", "boolean")


def _castable_into(data_type: Any, default: str) -> bool:
    return _castable(default, data_type.typeName())


def lint_topology(topology: Topology) -> list[Finding]:
    """Rules on fields the stream's schema lacks, defaults that do not fit the
    field, patterns that do not compile, and keys that put a stream in one task."""
    from .schemas import SCHEMA_ENUMS, stream_schema

    found: list[Finding] = []
    for definition in topology.streams:
        quality = definition.quality
        if quality is None:
            continue
        try:
            schema = stream_schema(definition.key)
        except KeyError:
            found.append(Finding(definition.key, "", "no schema is known for this stream"))
            continue
        enums = SCHEMA_ENUMS.get(definition.key, {})

        def report(name: str, problem: str, key: str = definition.key) -> None:
            found.append(Finding(key, name, problem))

        used = [(name, "required") for name in quality.required_fields]
        used += [(name, "dedup key") for name in quality.dedup_fields]
        used += [(name, "default") for name in quality.field_defaults]
        used += [(rule.field, "coercion") for rule in quality.type_coercions]
        used += [(rule.field, rule.rule) for rule in quality.field_validations]
        used += [(rule.field, "anomaly") for rule in quality.anomaly_detection]
        used += [(name, "sensitive") for name in quality.sensitive_fields]
        for name, use in used:
            if name not in schema.names:
                report(name, f"{use} field is not in the schema")

        fills = list(quality.field_defaults.items())
        fills += [(rule.field, rule.default_value) for rule in quality.field_validations if rule.default_value is not None]
        for name, default in fills:
            if name not in schema.names:
                continue
            if not _castable_into(schema[name].dataType, default):
                report(name, f"default {default!r} does not cast to {schema[name].dataType.simpleString()}")
            elif name in enums and default not in enums[name]:
                report(name, f"default {default!r} is no symbol of the enum")

        for rule in quality.field_validations:
            if rule.rule == "REGEX":
                try:
                    if not rule.pattern or not rule.pattern.strip():
                        report(rule.field, "REGEX rule has no pattern")
                    else:
                        re.compile(rule.pattern)
                except re.error as error:
                    report(rule.field, f"invalid pattern: {error}")
            if rule.rule == "ENUM_VALUE" and rule.field in enums:
                missing = [symbol for symbol in enums[rule.field] if symbol not in (rule.allowed_values or [])]
                if missing:
                    report(rule.field, f"allowedValues leaves out {', '.join(missing)}")
        if quality.anomaly_detection and not quality.anomaly_key and "customerId" not in schema.names:
            report("customerId", "anomaly rules fall back to one key for the whole stream; set anomalyKey")
        for sink in definition.sinks:
            for name in sink.partition_columns:
                if name != "eventDate" and name not in schema.names:
                    report(name, "partition column is not in the schema and will be skipped")
    return found
