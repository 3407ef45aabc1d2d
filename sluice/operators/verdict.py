"""Verdict columns: one frame carries clean and failed rows together, so a
stream is read once and split at the end by two filters.

``_live``      still in the main stream
``_failures``  array of (operator, reason, message), null while there are none
``_anomaly``   flagged by an anomaly rule
``_before``    values, on arrival, of the fields that the chain may rewrite
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LIVE = "_live"
FAILURES = "_failures"
ANOMALY = "_anomaly"
BEFORE = "_before"
STREAM_KEY = "_stream_key"
INGEST_TIME = "_ingest_time"
POSITION = "_position"
HIDDEN = (LIVE, FAILURES, ANOMALY, BEFORE, POSITION)
ENVELOPE = (STREAM_KEY, INGEST_TIME)

_FAILURE_TYPE = "array<struct<operator:string,reason:string,message:string>>"


def data_columns(df: DataFrame) -> list[str]:
    """Record fields, in schema order, without envelope and verdict columns."""
    return [name for name in df.columns if name not in HIDDEN and name not in ENVELOPE]


def with_verdict(df: DataFrame, rewritten: list[str] | None = None) -> DataFrame:
    """Add the verdict columns if they are not there yet. ``rewritten`` names
    the fields whose arriving value the dead letter has to keep."""
    if LIVE in df.columns:
        return df
    kept = [name for name in rewritten or [] if name in df.columns]
    before = F.struct(*[F.col(name) for name in kept]) if kept else F.lit(None).cast("string")
    return df.withColumns(
        {
            LIVE: F.lit(True),
            FAILURES: F.lit(None).cast(_FAILURE_TYPE),
            ANOMALY: F.lit(False),
            BEFORE: before,
        }
    )


def failure(operator: str, reason: str | Column, message: Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    entry = F.struct(F.lit(operator).alias("operator"), reason.alias("reason"), message.alias("message"))
    return F.array(entry).cast(_FAILURE_TYPE)


def append_failure(condition: Column, entry: Column) -> Column:
    """The failures column with ``entry`` added where ``condition`` holds."""
    grown = F.when(F.col(FAILURES).isNull(), entry).otherwise(F.concat(F.col(FAILURES), entry))
    return F.when(condition, grown).otherwise(F.col(FAILURES))


def fail_rows(df: DataFrame, operator: str, reason: str | Column, message: Column) -> DataFrame:
    """Dead-letter and suppress the live rows for which ``message`` is not null."""
    failed = F.col(LIVE) & message.isNotNull()
    return df.withColumns(
        {
            FAILURES: F.when(failed, failure(operator, reason, message)).otherwise(F.col(FAILURES)),
            LIVE: F.col(LIVE) & message.isNull(),
        }
    )


def clean_rows(df: DataFrame) -> DataFrame:
    """Rows of the main stream: record, envelope and the anomaly flag."""
    return df.where(F.col(LIVE)).drop(LIVE, FAILURES, BEFORE)


def original_json(df: DataFrame) -> Column:
    """The record as it entered the chain, as JSON."""
    saved = df.schema[BEFORE].dataType
    rewritten = set(saved.names) if hasattr(saved, "names") else set()
    fields = [F.col(f"{BEFORE}.{n}" if n in rewritten else f"`{n}`").alias(n) for n in data_columns(df)]
    return F.to_json(F.struct(*fields))


def dead_letters(df: DataFrame, stream_key: str, event_time: str = "eventTime") -> DataFrame:
    """One row per failure, with the columns of the dead-letter table."""
    from ..functions.numbers import field_or_null

    key = F.coalesce(F.col(STREAM_KEY), F.lit(stream_key)) if STREAM_KEY in df.columns else F.lit(stream_key)
    arrived = F.unix_millis(F.col(INGEST_TIME)) if INGEST_TIME in df.columns else F.unix_millis(F.current_timestamp())
    time_name = f"{BEFORE}.{event_time}" if event_time in _saved_names(df) else None
    original_time = F.col(time_name) if time_name else field_or_null(df, event_time)
    failed = df.where(F.col(FAILURES).isNotNull())
    return failed.select(
        F.explode(FAILURES).alias("_f"),
        key.alias("stream_key"),
        field_or_null(df, "customerId").cast("string").alias("original_customer_id"),
        original_time.try_cast("bigint").alias("original_event_time_ms"),
        arrived.alias("ingest_time_ms"),
        original_json(df).alias("original_json"),
    ).select(
        "stream_key",
        F.col("_f.operator").alias("operator_name"),
        F.col("_f.reason").alias("failure_reason"),
        F.col("_f.message").alias("message"),
        F.unix_millis(F.current_timestamp()).alias("failure_time_ms"),
        F.col("stream_key").alias("original_stream_key"),
        "original_customer_id",
        "original_event_time_ms",
        "ingest_time_ms",
        "original_json",
    )


def _saved_names(df: DataFrame) -> list[str]:
    return list(getattr(df.schema[BEFORE].dataType, "names", []))
