"""Event-time conversions. Times travel as epoch milliseconds (BIGINT)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import trim_controls

# Fixed pattern: ISO-8601 date-time that carries an offset, so names an instant.
ZONED_ISO = (
    r"(?i)\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
    r"(?:Z|[+-]\d{2}:\d{2}(?::\d{2})?)(?:\[[^\]]+\])?\z"
)


def iso_to_epoch_ms(text: Column) -> Column:
    """Epoch milliseconds of a zoned ISO-8601 text, else null."""
    bare = F.upper(F.regexp_replace(trim_controls(text), r"\[[^\]]*\]\z", ""))
    zoned = F.when(trim_controls(text).rlike(ZONED_ISO), bare)
    return F.unix_millis(F.try_to_timestamp(zoned))


def iso_to_epoch_text(text: Column) -> Column:
    """As above in text form; anything without a zone is left as it was."""
    return F.coalesce(iso_to_epoch_ms(text).cast("string"), text)


def epoch_ms_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def epoch_ms_to_day(millis: Column) -> Column:
    return F.to_date(F.timestamp_millis(millis))
