"""Sources: scan, decode, union, backfill, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import SourceConfig, StreamDefinition
from ..plans.adapters import ORDERS_SQL, TELEMETRY_SQL, orders_evt, table, telemetry, telemetry_of
from ..schemas import align_to_schema, schema_defaults, stream_schema
from ..sources.readers import (
    INGEST_TIME, STREAM_KEY, backfill_then_stream, decode_json, read_batch, stream_table, union_streams, with_envelope,
)
from ..streaming.jobs import run_available
from . import query
from .quality import numbered

CUT_AT = 500  # events are numbered as they arrive


@query(
    "src_events_scan",
    "SELECT event_id AS seq, user_id, event_type, round(value, 6) AS value FROM events",
)
def src_events_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = StreamDefinition(key="events", source=SourceConfig(type="FILE", format="parquet", path=f"{sf_dir}/events.parquet"))
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
        ]
    )
    df = read_batch(spark, definition, schema=schema)
    return df.select(F.col("event_id").alias("seq"), "user_id", "event_type", F.round("value", 6).alias("value"))


@query(
    "src_decode_json",
    """SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE event_type <> 'error'""",
)
def src_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of error events are cut short, as a broken producer would."""
    payload = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    raw = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), payload.alias("value"))
    return decode_json(raw, T.StructType([T.StructField("k", T.IntegerType())]))


@query(
    "src_union_streams",
    f"""WITH {TELEMETRY_SQL}, {ORDERS_SQL}, u AS (
      SELECT 'telemetry' AS stream_key, customerId, eventTime, value, NULL AS totalAmount FROM telemetry
      UNION ALL SELECT 'commerce-orders', customerId, eventTime, NULL, totalAmount FROM orders_evt)
    SELECT stream_key, CAST(customerId AS BIGINT) AS customer_no, count(*) AS events, min(eventTime) AS first_event_ms,
           round(sum(value), 4) AS total_value, round(sum(totalAmount), 4) AS total_amount, TRUE AS stamped FROM u GROUP BY 1, 2""",
)
def src_union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    united = union_streams(
        with_envelope(telemetry(spark, sf_dir), "telemetry"), with_envelope(orders_evt(spark, sf_dir), "commerce-orders")
    )
    return united.groupBy(F.col(STREAM_KEY).alias("stream_key"), F.col("customerId").cast("bigint").alias("customer_no")).agg(
        F.count(F.lit(1)).alias("events"), F.min("eventTime").alias("first_event_ms"),
        F.round(F.sum("value"), 4).alias("total_value"), F.round(F.sum("totalAmount"), 4).alias("total_amount"),
        F.bool_and(F.col(INGEST_TIME).isNotNull()).alias("stamped"),
    )


@query(
    "src_backfill_stream",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, CASE WHEN event_id < {CUT_AT} THEN 'history' ELSE 'stream' END AS origin FROM telemetry""",
)
def src_backfill_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = telemetry(spark, sf_dir)
    schema = table(spark, sf_dir, "events").schema
    live = telemetry_of(stream_table(spark, f"{sf_dir}/events.parquet", schema))
    seq = F.col("eventId").cast("bigint").alias("seq")
    before, after = backfill_then_stream(history.select(seq), live.select(seq), CUT_AT, "seq")
    streamed = run_available(after, "backfill")
    old = before.withColumn("origin", F.lit("history"))
    return old.unionByName(streamed.withColumn("origin", F.lit("stream")))


@query(
    "src_align_schema",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, 1 AS schema_version, eventTime AS event_time, batteryLevel AS battery,
        'UNKNOWN' AS camera_status, CAST(NULL AS INT) AS wifi, round(value, 6) AS extra_value FROM telemetry""",
)
def src_align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_to_schema(numbered(spark, sf_dir), stream_schema("device-telemetry"), schema_defaults("device-telemetry"))
    return aligned.select(
        "seq", F.col("schemaVersion").alias("schema_version"), F.col("eventTime").alias("event_time"), F.col("batteryLevel").alias("battery"),
        F.col("cameraStatus").alias("camera_status"), F.col("wifiSignalDbm").alias("wifi"), F.round("value", 6).alias("extra_value"),
    )


