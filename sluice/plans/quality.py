"""The quality chain of one stream, in fixed order: required fields, coercion,
null handling, validation, deduplication, anomaly detection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..config import StreamDefinition
from ..operators.anomaly import detect_anomalies
from ..operators.dedup import dedup, with_position
from ..operators.ordered import HOT_ROWS
from ..operators.stateless import coerce_types, handle_nulls, required_fields, rewritten_fields, validate_fields
from ..operators.ttl import FOLD_ROWS
from ..operators.verdict import ANOMALY, POSITION, clean_rows, dead_letters, with_verdict


class QualityResult(NamedTuple):
    clean: DataFrame
    dlq: DataFrame


def stateless_verdicts(df: DataFrame, definition: StreamDefinition) -> DataFrame:
    """Steps 1 to 4. Steps without rules add nothing to the plan."""
    quality = definition.quality
    if quality is None:
        return with_verdict(df)
    df = with_verdict(df, rewritten_fields(quality))
    df = required_fields(df, quality.required_fields)
    df = coerce_types(df, quality.type_coercions)
    df = handle_nulls(df, quality.null_strategy, quality.field_defaults)
    return validate_fields(df, quality.field_validations)


def quality_verdicts(
    df: DataFrame,
    definition: StreamDefinition,
    time: str = "eventTime",
    position: str | None = None,
    hot_rows: int = HOT_ROWS,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """All six steps on a batch frame, as one frame with verdict columns."""
    quality = definition.quality
    if quality is None:
        return stateless_verdicts(df, definition)
    stateful = bool(quality.dedup_fields or quality.anomaly_detection)
    numbered = stateful and position is None
    if numbered:
        df, position = with_position(df, None)
    df = stateless_verdicts(df, definition)
    arrived = df  # keys and times as coercion leaves them
    if quality.dedup_fields:
        df = dedup(df, quality.dedup_fields, quality.dedup_ttl_hours, time, position, fold_rows=fold_rows)
    df = detect_anomalies(
        df, quality.anomaly_detection, definition.key, quality.anomaly_key, time, position, hot_rows, arrived
    )
    return df.drop(POSITION) if numbered else df


def split_verdicts(verdicts: DataFrame, definition: StreamDefinition, time: str = "eventTime") -> QualityResult:
    return QualityResult(clean_rows(verdicts), dead_letters(verdicts, definition.key, time))


def attach_quality(
    df: DataFrame,
    definition: StreamDefinition,
    time: str = "eventTime",
    position: str | None = None,
    hot_rows: int = HOT_ROWS,
    fold_rows: int = FOLD_ROWS,
) -> QualityResult:
    """Clean rows and dead letters. Without a quality block every row is clean.
    Streaming frames take steps 1 to 4 here and steps 5 and 6 as stateful
    processors in ``sluice.streaming``."""
    if df.isStreaming:
        raise ValueError("use sluice.streaming.operators.stream_verdicts for streaming frames")
    verdicts = quality_verdicts(df, definition, time, position, hot_rows, fold_rows)
    clean, dlq = split_verdicts(verdicts, definition, time)
    if definition.quality is None:
        return QualityResult(clean.drop(ANOMALY), dlq.where(F.lit(False)))
    return QualityResult(clean, dlq)
