"""Row-shaped targets: JDBC tables and message buses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import field_or_null
from ..operators.verdict import STREAM_KEY, data_columns
from .lake import epoch_or_zero

# Fixed value: rows per JDBC batch.
JDBC_BATCH = 1000


def jdbc_rows(df: DataFrame, stream_key: str, time: str = "eventTime") -> DataFrame:
    """(stream_key, customer_id, event_time or 0, payload as JSON)."""
    key = F.coalesce(F.col(STREAM_KEY), F.lit(stream_key)) if STREAM_KEY in df.columns else F.lit(stream_key)
    return df.select(
        key.alias("stream_key"),
        field_or_null(df, "customerId").cast("string").alias("customer_id"),
        epoch_or_zero(field_or_null(df, time)).alias("event_time"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in data_columns(df)])).alias("payload"),
    )


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, writers: int = 8) -> None:
    """Append over JDBC; ``writers`` bounds the number of open connections."""
    options = {"batchsize": str(JDBC_BATCH), **(properties or {})}
    rows.repartition(writers).write.jdbc(url, table, mode="append", properties=options)


def bus_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """(key, value) messages with the row as JSON."""
    message_key = field_or_null(df, key).cast("string") if key else F.lit(None).cast("string")
    return df.select(message_key.alias("key"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def write_bus(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Publish to Kafka; needs the connector on the class path."""
    rows = bus_rows(df, key)
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
