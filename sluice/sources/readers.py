"""Sources: dispatch by declared type, decoding, envelope, union, backfill."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..config import SourceConfig, StreamDefinition
from ..functions.numbers import field_or_null
from ..operators.verdict import INGEST_TIME, STREAM_KEY, dead_letters, fail_rows, with_verdict
from ..schemas import align_to_schema, aligned, read_schema, schema_defaults

EVENT_TS = "_event_ts"
_BEAT = "_heartbeat"
# Declared source type to Spark format, file formats excepted.
CONNECTORS = {"KAFKA": "kafka", "KINESIS": "kinesis"}
PAYLOADS = {"KAFKA": "value", "KINESIS": "data"}
FILE_FORMATS = ("parquet", "json", "orc", "csv", "avro")


def _format_and_options(definition: StreamDefinition) -> tuple[str, dict[str, str]]:
    source = definition.source
    if source is None:
        raise ValueError(f"stream {definition.key!r} declares no source")
    options = dict(source.options)
    if source.type == "FILE":
        fmt = source.format or "parquet"
        if fmt not in FILE_FORMATS:
            raise ValueError(f"file format {fmt!r} is not one of {', '.join(FILE_FORMATS)}")
        return fmt, options
    if source.type not in CONNECTORS:
        raise NotImplementedError(f"source type {source.type} has no Spark connector here")
    if source.type == "KAFKA":
        options.setdefault("kafka.bootstrap.servers", source.bootstrap_servers or "")
        options.setdefault("subscribe", source.topic or definition.key)
        options.setdefault("startingOffsets", "earliest" if source.starting_position == "TRIM_HORIZON" else "latest")
    else:
        options.setdefault("startingPosition", source.starting_position)
    return CONNECTORS[source.type], options


def decode(df: DataFrame, definition: StreamDefinition) -> DataFrame:
    """The payload of a bus source, as its declared format says: JSON (the default), or
    Avro with the writer's schema in the option ``avroSchema``. Avro with an
    ``avroSchemas`` option, writers' schemas by registry id as JSON, is routed by the id in
    front of each payload and resolved to ``avroSchema``."""
    source, payload = definition.source, PAYLOADS[definition.source.type]
    declared = (source.format or "json").lower()
    if declared == "json":
        return decode_json(df, read_schema(definition.key), payload=payload)
    if declared == "avro":
        if "avroSchema" not in source.options:
            raise ValueError(f"the Avro source of {definition.key!r} needs the option avroSchema")
        if "avroSchemas" in source.options:
            decoders = avro_decoders(json.loads(source.options["avroSchemas"]), source.options["avroSchema"])
            routed = decode_by_id(df, decoders, payload)
            return routed.where(F.col(DECODE_ERROR).isNull()).drop(DECODE_ERROR)
        return decode_avro(df, source.options["avroSchema"], payload=payload)
    raise ValueError(f"payload format {source.format!r} is not json or avro")


def read_stream(
    spark: SparkSession,
    definition: StreamDefinition,
    path: str | None = None,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The stream as a streaming frame, aligned to its schema. File sources are
    bounded per micro-batch by ``max_files_per_trigger``."""
    fmt, options = _format_and_options(definition)
    reader = spark.readStream.format(fmt).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if definition.source.type == "FILE":
        df = reader.schema(schema or read_schema(definition.key)).load(path or definition.source.path)
    else:
        df = decode(reader.load(), definition)
    return df if schema is not None else align_to_schema(df, read_schema(definition.key), schema_defaults(definition.key))


def read_batch(spark: SparkSession, definition: StreamDefinition, path: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The same stream as a bounded table, for backfills and tests."""
    fmt, options = _format_and_options(definition)
    reader = spark.read.format(fmt).options(**options)
    if definition.source.type == "FILE":
        # Files may lag behind the schema: Parquet and JSON fill absent fields with null.
        df = reader.schema(schema or read_schema(definition.key)).load(path or definition.source.path)
    else:
        df = decode(reader.load(), definition)
    return df if schema is not None else align_to_schema(df, read_schema(definition.key), schema_defaults(definition.key))


_CORRUPT = "_corrupt"


def decode_json(
    df: DataFrame, schema: T.StructType, payload: str = "value", skipped: Observation | None = None, keep_bad: bool = False
) -> DataFrame:
    """Decode a text or binary payload. Empty and malformed payloads are skipped;
    ``skipped`` counts them, ``keep_bad`` keeps them in ``_corrupt``."""
    with_bad = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    body = F.col(payload).cast("string")
    record = F.from_json(body, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    decoded = df.withColumn("_record", record)
    bad = F.col("_record").isNull() | F.col(f"_record.{_CORRUPT}").isNotNull()
    decoded = decoded.withColumn("_bad", F.coalesce(bad, F.lit(True)))
    if skipped is not None:
        decoded = decoded.observe(skipped, F.count_if(F.col("_bad")).alias("skipped"), F.count(F.lit(1)).alias("read"))
    others = [F.col(f"`{name}`") for name in df.columns if name != payload]
    fields = [F.col(f"_record.{name}").alias(name) for name in schema.names]
    if keep_bad:
        return decoded.select(*others, *fields, F.when(F.col("_bad"), F.coalesce(body, F.lit(""))).alias(_CORRUPT))
    return decoded.where(~F.col("_bad")).select(*others, *fields)


def decode_avro(df: DataFrame, schema_json: str, payload: str = "value") -> DataFrame:
    """Decode Avro payloads; needs the external Avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    record = from_avro(F.col(payload), schema_json, {"mode": "PERMISSIVE"})
    others = [F.col(f"`{name}`") for name in df.columns if name != payload]
    return df.select(*others, record.alias("_record")).where(F.col("_record").isNotNull()).select(*others, "_record.*")


# What stands in front of a payload whose schema is in a registry.
MAGIC_BYTE, ID_BYTES = 0, 4
DECODE_ERROR, DECODER = "_decode_error", "SchemaIdDecoder"
BAD_HEADER, UNKNOWN_SCHEMA, BAD_PAYLOAD = "BAD_HEADER", "UNKNOWN_SCHEMA_ID", "BAD_PAYLOAD"
Decoder = Callable[[Column], Column]


def avro_decoders(writers: Mapping[str | int, str | dict], reader: str) -> dict[int, Decoder]:
    """A decoder per registry id, from the writer's schema of that id to the reader's: fields
    that the writer lacks get the reader's default, others are left out. Needs the external
    Avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    def decoder(writer: str | dict) -> Decoder:
        text = writer if isinstance(writer, str) else json.dumps(writer)
        return lambda body: from_avro(body, text, {"mode": "PERMISSIVE", "avroSchema": reader})

    return {int(number): decoder(writer) for number, writer in writers.items()}


def json_decoders(writers: Mapping[int, T.StructType], reader: T.StructType, defaults: Mapping[str, object] | None = None) -> dict[int, Decoder]:
    """The same for JSON bodies, with the casts and defaults of ``align_to_schema``."""

    def decoder(writer: T.StructType) -> Decoder:
        def read(body: Column) -> Column:
            record = F.from_json(body.cast("string"), T.StructType([*writer.fields, T.StructField(_CORRUPT, T.StringType())]),
                                 {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
            fields = F.struct(*aligned(reader, writer, lambda name: record[name], defaults))
            return F.when(record.isNotNull() & record[_CORRUPT].isNull(), fields)

        return read

    return {number: decoder(writer) for number, writer in writers.items()}


def decode_by_id(df: DataFrame, decoders: Mapping[int, Decoder], payload: str = "value") -> DataFrame:
    """Payloads that start with a zero byte and the id of their writer's schema (four bytes,
    high first), each decoded once, by its id's decoder; all decoders give one record type.

    Every row stays. ``_decode_error`` is null for decoded rows, else the reason: no header
    (empty, too short, another first byte), an id without decoder, a body that does not
    decode. Fields of such rows are null and the payload stays in ``_payload``, so they can
    go to the dead letters; ``undecoded_letters`` turns them into such."""
    if not decoders:
        raise ValueError("no schema id has a decoder")
    raw = F.col(f"`{payload}`").cast("binary")
    header = F.length(raw) >= 1 + ID_BYTES
    first = F.conv(F.hex(F.substring(raw, 1, 1)), 16, 10).cast("int")
    number = F.conv(F.hex(F.substring(raw, 2, ID_BYTES)), 16, 10).cast("bigint")
    framed = df.withColumn("_schema_id", F.when(header & (first == MAGIC_BYTE), number))
    body = F.expr(f"substring(cast(`{payload}` as binary), {2 + ID_BYTES})")
    record = None
    for known, read in sorted(decoders.items()):
        hit = F.col("_schema_id") == F.lit(known).cast("bigint")
        record = F.when(hit, read(body)) if record is None else record.when(hit, read(body))
    decoded = framed.withColumn("_record", record)
    error = (
        F.when(F.col("_schema_id").isNull(), BAD_HEADER)
        .when(~F.col("_schema_id").isin([int(known) for known in decoders]), UNKNOWN_SCHEMA)
        .when(F.col("_record").isNull(), BAD_PAYLOAD)
    )
    others = [F.col(f"`{name}`") for name in df.columns if name != payload]
    names = decoded.schema["_record"].dataType.names
    fields = [F.col(f"_record.`{name}`").alias(name) for name in names]
    return decoded.select(*others, *fields, F.when(error.isNotNull(), raw).alias("_payload"), error.alias(DECODE_ERROR))


def undecoded_letters(routed: DataFrame, stream_key: str) -> DataFrame:
    """Rows of ``decode_by_id`` that did not decode as dead letters; their record is the
    payload in base64 with what the bus says about it."""
    bad = routed.where(F.col(DECODE_ERROR).isNotNull())
    bad = bad.withColumn("_payload", F.base64("_payload"))
    failed = fail_rows(with_verdict(bad), DECODER, F.col(DECODE_ERROR), F.lit("Payload does not decode"))
    return dead_letters(failed.drop(DECODE_ERROR), stream_key)


def with_envelope(df: DataFrame, stream_key: str, ingest_time: Column | None = None) -> DataFrame:
    """Every row carries its stream's key and the wall clock of its arrival."""
    return df.withColumns({STREAM_KEY: F.lit(stream_key), INGEST_TIME: ingest_time if ingest_time is not None else F.current_timestamp()})


def strip_envelope(df: DataFrame) -> DataFrame:
    return df.drop(STREAM_KEY, INGEST_TIME, EVENT_TS)


def with_event_time(df: DataFrame, time: str = "eventTime", arrival: Column | None = None, lag_seconds: int | None = None) -> DataFrame:
    """Event time from the record, else the arrival time; with a watermark when
    ``lag_seconds`` is given."""
    millis = field_or_null(df, time).try_cast("bigint")
    fallback = arrival if arrival is not None else (F.col(INGEST_TIME) if INGEST_TIME in df.columns else F.current_timestamp())
    df = df.withColumn(EVENT_TS, F.coalesce(F.timestamp_millis(millis), fallback))
    return df if lag_seconds is None else df.withWatermark(EVENT_TS, f"{lag_seconds} seconds")


def with_idle_timeout(df: DataFrame, lag_seconds: int, idle_seconds: int) -> DataFrame:
    """The watermark of one stream of a union: ``lag_seconds`` behind its newest event, but no
    further behind the clock than ``idle_seconds`` besides, so a silent stream does not hold
    the others back. A heartbeat a second passes the watermark with the stream's events and is
    taken out behind it. A stream that is more than both behind the clock counts as idle: its
    windows have closed. For live streams; history has no use for it."""
    beats = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    beats = beats.select((F.col("timestamp") - F.make_dt_interval(secs=F.lit(idle_seconds))).alias(EVENT_TS), F.lit(True).alias(_BEAT))
    both = df.unionByName(beats, allowMissingColumns=True).withWatermark(EVENT_TS, f"{lag_seconds} seconds")
    # The condition names the event time, or the optimizer would move it below the watermark.
    return both.where(F.col(_BEAT).isNull() | F.col(EVENT_TS).isNull()).drop(_BEAT)


def union_live(streams: dict[str, tuple[DataFrame, SourceConfig]], time: str = "eventTime") -> DataFrame:
    """Union of live streams, each with its own lag and idle timeout; the slowest stream that
    is not idle sets the watermark."""
    return union_streams(*[
        with_idle_timeout(with_event_time(with_envelope(df, key), time), source.lag_seconds, source.idle_timeout_seconds)
        for key, (df, source) in streams.items()
    ])


def union_streams(*frames: DataFrame) -> DataFrame:
    """Bag union by name; fields a stream lacks are null. A watermark set behind
    the union goes by the newest event of all; with watermarks before it, one silent input
    holds all back unless ``union_live`` sets them."""
    if not frames:
        raise ValueError("no streams to unite")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def backfill_then_stream(history: DataFrame, live: DataFrame, cut: int, arrived: str) -> tuple[DataFrame, DataFrame]:
    """Split work at a cut: rows before it come from the table, rows from it on come
    from the stream. ``arrived`` grows with arrival (an offset, a sequence number, the
    ingest time) and is the same in both; the event time is not, and cutting by it
    would lose events that arrive late. Rows without it are left to the stream."""
    place = F.col(arrived)
    return history.where(place < cut), live.where(place.isNull() | (place >= cut))


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table (folder or single file) as a stream. The file source wants
    a folder or a pattern, so the last letter is written as a pattern."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    clean = path.rstrip("/")
    return reader.parquet(f"{clean[:-1]}[{clean[-1]}]")
