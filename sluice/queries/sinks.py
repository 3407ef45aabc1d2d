"""Targets, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DeadLetterConfig, QualityConfig, StreamDefinition
from ..plans.adapters import ORDERS_SQL, TELEMETRY_SQL, orders_evt, table
from ..session import scratch_path
from ..sinks.deadletter import replay, write_dlq
from ..sinks.fanout import fan_out
from ..sinks.buckets import read_upserts, upsert_version
from ..sinks.lake import erase, write_lake
from ..sinks.rows import jdbc_rows
from . import query
from .quality import CHAIN, CHAIN_SQL, chain, numbered

UPDATES_FROM_MS = 883_612_800_000  # 1998-01-01


@query(
    "sink_fanout_counts",
    f"""WITH {TELEMETRY_SQL}
    SELECT 'lake' AS target, eventType AS event_type, count(*) AS events, round(sum(value), 4) AS total_value FROM telemetry GROUP BY eventType
    UNION ALL SELECT 'rows', eventType, count(*), round(sum(value), 4) FROM telemetry GROUP BY eventType""",
)
def sink_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, rows = scratch_path(spark, "fanout-lake"), scratch_path(spark, "fanout-rows")
    fan_out(
        numbered(spark, sf_dir),
        [
            lambda df: write_lake(df, lake, ["eventDate", "eventType"]),
            lambda df: jdbc_rows(df, "telemetry").write.parquet(rows),
        ],
    )
    payload = F.from_json("payload", "eventType string, value double")
    written = spark.read.parquet(rows).select(payload.alias("p")).select("p.eventType", "p.value").withColumn("target", F.lit("rows"))
    both = spark.read.parquet(lake).select("eventType", "value").withColumn("target", F.lit("lake")).unionByName(written)
    return both.groupBy("target", F.col("eventType").alias("event_type")).agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total_value")
    )


@query(
    "sink_lake_roundtrip",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, customerId AS customer_id, eventType AS event_type, round(value, 6) AS value,
        batteryLevel AS battery, eventTime // 86400000 AS day_no FROM telemetry""",
)
def sink_lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    write_lake(numbered(spark, sf_dir), path, ["eventDate", "eventType", "absent"])
    return spark.read.parquet(path).select(
        "seq", F.col("customerId").cast("string").alias("customer_id"), F.col("eventType").alias("event_type"),
        F.round("value", 6).alias("value"), F.col("batteryLevel").alias("battery"), F.unix_date("eventDate").cast("bigint").alias("day_no"),
    )


@query(
    "sink_partition_counts",
    f"""WITH {TELEMETRY_SQL} SELECT eventTime // 86400000 AS day_no, count(*) AS events FROM telemetry GROUP BY 1""",
)
def sink_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitions")
    write_lake(numbered(spark, sf_dir), path, ["eventDate"])
    return spark.read.parquet(path).groupBy(F.unix_date("eventDate").cast("bigint").alias("day_no")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "sink_upsert_latest",
    f"""WITH {ORDERS_SQL}, r AS (
      SELECT *, row_number() OVER (PARTITION BY customerId ORDER BY eventTime DESC, o_orderkey DESC) AS rn FROM orders_evt)
    SELECT CAST(customerId AS BIGINT) AS customer_no, o_orderkey AS order_no, eventTime AS event_time, round(totalAmount, 6) AS amount
    FROM r WHERE rn = 1""",
)
def sink_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later orders come first, so the second write holds older updates that must lose."""
    orders = orders_evt(spark, sf_dir).withColumn("order_no", F.col("orderId").cast("bigint"))
    path = scratch_path(spark, "upsert")
    keys, order = ["customerId"], ["eventTime", "order_no"]
    upsert_version(orders.where(F.col("eventTime") >= UPDATES_FROM_MS), keys, order, path)
    upsert_version(orders.where(F.col("eventTime") < UPDATES_FROM_MS), keys, order, path)
    return read_upserts(spark, path).select(
        F.col("customerId").cast("bigint").alias("customer_no"), "order_no", F.col("eventTime").alias("event_time"),
        F.round("totalAmount", 6).alias("amount"),
    )


@query(
    "sink_jdbc_projection",
    f"""WITH {ORDERS_SQL}, j AS (SELECT *, CASE WHEN channel <> 'KIOSK' THEN eventTime END AS moment FROM orders_evt)
    SELECT 'commerce-orders' AS stream_key, customerId AS customer_id, coalesce(moment, 0) AS event_time,
           concat('{{"orderId":"', orderId, '","customerId":"', customerId, '"', CASE WHEN moment IS NOT NULL THEN concat(',"eventTime":', CAST(moment AS VARCHAR)) ELSE '' END,
                  ',"channel":"', channel, '","totalAmount":', CAST(totalAmount AS VARCHAR), '}}') AS payload
    FROM j""",
)
def sink_jdbc_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_evt(spark, sf_dir).withColumn("eventTime", F.when(F.col("channel") != "KIOSK", F.col("eventTime")))
    return jdbc_rows(orders, "commerce-orders")


@query(
    "dlq_events_schema",
    f"""WITH RECURSIVE {CHAIN_SQL}
    SELECT 'telemetry' AS stream_key, d.op AS operator_name, d.reason AS failure_reason, 'telemetry' AS original_stream_key,
           t.customerId AS original_customer_id, count(*) AS events, min(t.eventTime) AS first_event_ms, TRUE AS stamped
    FROM dlq d JOIN telemetry t ON d.event_id = t.event_id GROUP BY d.op, d.reason, t.customerId""",
)
def dlq_events_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dlq")
    write_dlq(chain(spark, sf_dir).dlq, DeadLetterConfig(), path)
    return (
        spark.read.parquet(path)
        .groupBy("stream_key", "operator_name", "failure_reason", "original_stream_key", "original_customer_id")
        .agg(
            F.count(F.lit(1)).alias("events"), F.min("original_event_time_ms").alias("first_event_ms"),
            F.bool_and((F.col("failure_time_ms") >= F.col("ingest_time_ms")) & F.col("message").isNotNull()).alias("stamped"),
        )
    )


@query(
    "dlq_replay",
    f"""WITH RECURSIVE {CHAIN_SQL}
    SELECT t.event_id AS seq, t.customerId AS customer_id, t.eventTime AS event_time, coalesce(t.firmwareVersion, 'UNKNOWN') AS firmware
    FROM dlq d JOIN telemetry t ON d.event_id = t.event_id WHERE d.reason = 'MISSING_REQUIRED_FIELD'""",
)
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay rows that lacked their firmware under a rule that fills it."""
    path = scratch_path(spark, "dlq-replay")
    write_dlq(chain(spark, sf_dir).dlq, DeadLetterConfig(), path)
    fixed = StreamDefinition(
        key=CHAIN.key,
        quality=QualityConfig(required_fields=["eventId"], null_strategy="FILL_DEFAULT", field_defaults={"firmwareVersion": "UNKNOWN"}),
    )
    schema = numbered(spark, sf_dir).schema
    clean = replay(spark, path, fixed, schema, ["MISSING_REQUIRED_FIELD"]).clean
    return clean.select(
        "seq", F.col("customerId").alias("customer_id"), F.col("eventTime").alias("event_time"), F.col("firmwareVersion").alias("firmware")
    )


@query(
    "erase_customer",
    f"""WITH {ORDERS_SQL} SELECT o_orderkey AS order_no, CAST(customerId AS BIGINT) AS customer_no, round(totalAmount, 6) AS amount FROM orders_evt
        WHERE customerId NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""",
)
def erase_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "erase")
    write_lake(orders_evt(spark, sf_dir), f"{path}/before")
    ids = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("customerId"))
    erase(spark, ids, f"{path}/before", f"{path}/after")
    return spark.read.parquet(f"{path}/after").select(
        F.col("orderId").cast("bigint").alias("order_no"), F.col("customerId").cast("bigint").alias("customer_no"),
        F.round("totalAmount", 6).alias("amount"),
    )


