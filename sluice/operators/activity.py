"""Activity per key: sessions by inactivity gap, and days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import HOT_ROWS, previous_value, running_count, split_hot_keys

SESSION_GAP_MS = 60 * 60_000
_KEY, _SESSION = "_activity_key", "_session"


def session_activity(
    df: DataFrame, key: str = "customerId", time: str = "eventTime", position: str = "eventId",
    gap_ms: int = SESSION_GAP_MS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sessions that end after ``gap_ms`` without an event (an event exactly the
    gap later opens a new one). Unlike a session window, a key with very many
    events is worked on by many tasks."""
    keyed = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(_KEY), time, position)
    split = previous_value(split_hot_keys(keyed, _KEY, [time, position], hot_rows), time, "_previous")
    opens = F.col("_previous").isNull() | (F.col(time) - F.col("_previous") >= gap_ms)
    split = running_count(split, opens, _SESSION, inclusive=True)
    sessions = split.rows.groupBy(_KEY, _SESSION).agg(
        F.min(time).alias("sessionStartMs"), F.max(time).alias("lastEventMs"), F.count(F.lit(1)).alias("events")
    )
    return sessions.select(
        F.col(_KEY).alias(key), "sessionStartMs", (F.col("lastEventMs") + gap_ms).alias("sessionEndMs"), "events"
    )


def daily_activity(df: DataFrame, keys: list[str], time: str = "eventTime") -> DataFrame:
    """Events per key and UTC day; counts combine before the shuffle."""
    return df.groupBy(*keys, F.to_date(F.timestamp_millis(F.col(time))).alias("day")).agg(F.count(F.lit(1)).alias("events"))
