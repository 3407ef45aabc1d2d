"""Deduplication by key within a time limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import field_or_null
from ..session import cut_lineage
from .ttl import FOLD_ROWS, ROWS_PER_PHASE_GROUP, accepted_rows
from .verdict import FAILURES, LIVE, POSITION, append_failure, failure, with_verdict

DEDUP = "DeduplicationOperator"
KEY_SEPARATOR = "\u0001"
_KEY, _TIME, _FIRST = "_dedup_key", "_dedup_time", "_accepted"


def key_text(df: DataFrame, keys: list[str]) -> Column:
    """The key as text; a missing or null part counts as empty text."""
    parts = [F.coalesce(field_or_null(df, name).cast("string"), F.lit("")) for name in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEPARATOR, *parts)


def with_position(df: DataFrame, position: str | None) -> tuple[DataFrame, str]:
    """A column that tells rows apart. Without one, rows are numbered and cut
    loose from their lineage, so every reader sees the same numbers."""
    if position is not None:
        return df, position
    return cut_lineage(df.withColumn(POSITION, F.monotonically_increasing_id())), POSITION


def limit_ms(ttl_hours: float) -> int:
    """The limit in milliseconds; one that is shorter than a millisecond is refused."""
    limit = int(ttl_hours * 3_600_000)
    if limit < 1:
        raise ValueError(f"dedupTtlHours must be at least a millisecond, not {ttl_hours}")
    return limit


def dedup(
    df: DataFrame,
    keys: list[str],
    ttl_hours: float = 24,
    time: str = "eventTime",
    position: str | None = None,
    fold_rows: int = FOLD_ROWS,
    group_rows: int = ROWS_PER_PHASE_GROUP,
) -> DataFrame:
    """Dead-letter and suppress repeats of a key within the limit. The first row
    in (time, position) order wins and repeats do not extend the limit. Only
    live rows take part. ``position`` must be unique per row."""
    own = [] if position else [POSITION]
    df, position = with_position(with_verdict(df), position)
    event_time = F.coalesce(field_or_null(df, time).try_cast("bigint"), F.lit(0).cast("bigint"))
    rows = df.withColumns({_KEY: key_text(df, keys), _TIME: event_time})
    ttl_ms = limit_ms(ttl_hours)
    first = accepted_rows(rows.where(F.col(LIVE)), _KEY, _TIME, position, ttl_ms, fold_rows, group_rows)
    # Joining on the unique position as well spreads the copies of one key.
    joined = rows.join(first.withColumn(_FIRST, F.lit(True)), [_KEY, position], "left")
    repeated = F.col(LIVE) & F.col(_FIRST).isNull()
    message = F.concat(F.lit(f"Duplicate {','.join(keys)}='"), F.col(_KEY), F.lit("'"))
    return joined.withColumns(
        {
            FAILURES: append_failure(repeated, failure(DEDUP, "DUPLICATE_EVENT", message)),
            LIVE: F.col(LIVE) & F.col(_FIRST).isNotNull(),
        }
    ).drop(_KEY, _TIME, _FIRST, *own)
