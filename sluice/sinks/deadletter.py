"""The dead-letter table and replay from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import DeadLetterConfig, SinkConfig, StreamDefinition
from ..functions.crypto import decrypt_field, encrypt_fields
from ..schemas import read_schema
from .lake import CODEC, erase, table_path
from .rows import write_bus


SEALED, DLQ_CUSTOMER = ("original_json", "message"), "original_customer_id"


def dlq_path(config: DeadLetterConfig, root: str, env: str, prefix: str = "") -> str:
    sink = SinkConfig(type="ICEBERG", database=config.database, table=config.table)
    return config.path or table_path(root, sink, env, prefix)


def write_dlq(failed: DataFrame, config: DeadLetterConfig, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Dead letters are usually few, and then ``rebalance`` leaves one file; when
    a stream fails as a whole, they are written by many tasks."""
    if config.type == "KAFKA":
        write_bus(failed, config.bootstrap_servers or "", config.topic or config.table, key="stream_key")
    elif config.type == "S3":
        failed.hint("rebalance").write.mode(mode).json(path)
    else:
        failed.hint("rebalance").write.format(fmt).mode(mode).option("compression", CODEC).save(path)


def seal(dead: DataFrame, sensitive: list[str], key: bytes | None, wrapped_key: bytes = b"", enabled: bool = True) -> DataFrame:
    """Dead letters of a stream with sensitive fields hold their record and message
    encrypted, as the lake holds those fields."""
    return encrypt_fields(dead, SEALED, key, wrapped_key, enabled) if sensitive else dead


def unseal(dead: DataFrame, key: bytes) -> DataFrame:
    return dead.withColumns({name: decrypt_field(F.col(name), key) for name in SEALED})


def erase_dead_letters(spark: SparkSession, ids: DataFrame, path: str, new_path: str, column: str = "customerId") -> None:
    """Rewrite the dead-letter table without the given customers."""
    erase(spark, ids.select(F.col(column).cast("string").alias(DLQ_CUSTOMER)), path, new_path, DLQ_CUSTOMER)


def failed_records(dead: DataFrame, stream_key: str, schema: T.StructType, reasons: list[str] | None = None, data_key: bytes | None = None) -> DataFrame:
    """The original records of a stream's dead letters; sealed ones need the data key. A
    flagged row that was forwarded is in the main stream already, so name the reasons
    to replay."""
    if data_key is not None:
        dead = unseal(dead, data_key)
    chosen = dead.where(F.col("stream_key") == stream_key)
    if reasons is not None:
        chosen = chosen.where(F.col("failure_reason").isin(*reasons))
    return chosen.select(F.from_json("original_json", schema).alias("_r")).select("_r.*")


def replay(
    spark: SparkSession,
    path: str,
    definition: StreamDefinition,
    schema: T.StructType | None = None,
    reasons: list[str] | None = None,
    position: str | None = None,
    data_key: bytes | None = None,
):
    """Run the (corrected) chain again over a stream's dead letters."""
    from ..plans.quality import attach_quality

    records = failed_records(spark.read.parquet(path), definition.key, schema or read_schema(definition.key), reasons, data_key)
    return attach_quality(records, definition, position=position)
