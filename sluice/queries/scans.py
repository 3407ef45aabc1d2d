"""Snapshots, baselines, activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.activity import daily_activity, session_activity
from ..operators.scans import baselines, enrich_with_sessions, snapshots
from ..plans.adapters import SCAN_SQL, TELEMETRY_SQL, scan_events, table
from . import query
from .quality import numbered

DIMENSIONS = (("hydration", "scan-hydration"), ("texture", "scan-texture"), ("wrinkle", "scan-wrinkles"),
              ("radiance", "scan-radiance"), ("overall", "scan-overall"))
LONG_TIMEOUT_MS = 43_200_000

# Runs of a scan's events: a run ends with its completion.
RUNS_SQL = f"""{SCAN_SQL}, runs AS (
      SELECT *, coalesce(sum(CASE WHEN streamKey = 'scan-overall' THEN 1 ELSE 0 END) OVER (PARTITION BY scanId ORDER BY eventTime, seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM scan_dim)"""


def merged_sql(groups: str, source: str) -> str:
    scores = ", ".join(
        f"last(score ORDER BY eventTime, seq) FILTER (WHERE streamKey = '{stream}') AS {name}" for name, stream in DIMENSIONS
    )
    return f"""snaps AS (
      SELECT scanId, first(customerId ORDER BY eventTime, seq) AS customerId, max(eventTime) AS eventTimeMs, min(eventTime) AS firstEventMs,
             count(*) AS events, bool_or(streamKey = 'scan-overall') AS complete, {scores}
      FROM {source} GROUP BY {groups})"""


SNAPS_SQL = f"{RUNS_SQL}, {merged_sql('scanId, run', 'runs')}"

# The same with a time limit: a run also ends so long after its first event.
TIMED_SQL = f"""{SCAN_SQL}, o AS (
      SELECT *, row_number() OVER (PARTITION BY scanId ORDER BY eventTime, seq) AS rn FROM scan_dim),
    timed AS (
      SELECT scanId, seq, rn, eventTime AS start, 1 AS run, streamKey = 'scan-overall' AS done FROM o WHERE rn = 1
      UNION ALL
      SELECT o.scanId, o.seq, o.rn,
             CASE WHEN t.done OR o.eventTime - t.start >= {LONG_TIMEOUT_MS} THEN o.eventTime ELSE t.start END,
             CASE WHEN t.done OR o.eventTime - t.start >= {LONG_TIMEOUT_MS} THEN t.run + 1 ELSE t.run END,
             o.streamKey = 'scan-overall'
      FROM timed t JOIN o ON o.scanId = t.scanId AND o.rn = t.rn + 1),
    timed_runs AS (SELECT o.*, t.run FROM o JOIN timed t ON o.scanId = t.scanId AND o.seq = t.seq),
    {merged_sql('scanId, run', 'timed_runs')}"""

FLAT_SQL = """scanId AS scan_id, CAST(customerId AS BIGINT) AS customer_no, eventTimeMs AS event_time_ms, firstEventMs AS first_event_ms,
      events, complete, round(hydration, 6) AS hydration, round(texture, 6) AS texture, round(wrinkle, 6) AS wrinkle,
      round(radiance, 6) AS radiance, round(overall, 6) AS overall"""


def flat(snaps: DataFrame) -> DataFrame:
    return snaps.select(
        F.col("scanId").alias("scan_id"),
        F.col("customerId").cast("bigint").alias("customer_no"),
        F.col("eventTimeMs").alias("event_time_ms"),
        F.col("firstEventMs").alias("first_event_ms"),
        F.col("events").cast("bigint").alias("events"),
        "complete",
        *[F.round(F.element_at("scores", name), 6).alias(name) for name, _ in DIMENSIONS],
    )


def batch_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots(scan_events(spark, sf_dir), position="seq")


@query("scan_snapshots", f"WITH {SNAPS_SQL} SELECT {FLAT_SQL} FROM snaps")
def scan_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(batch_snapshots(spark, sf_dir))


@query("scan_snapshots_timeout", f"WITH RECURSIVE {TIMED_SQL} SELECT {FLAT_SQL} FROM snaps")
def scan_snapshots_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(snapshots(scan_events(spark, sf_dir), position="seq", timeout_ms=LONG_TIMEOUT_MS))


UNPIVOT_SQL = " UNION ALL ".join(
    f"SELECT customerId, eventTimeMs, complete, '{name}' AS dimension, {name} AS score FROM snaps WHERE {name} IS NOT NULL" for name, _ in DIMENSIONS
)


@query(
    "scan_baseline_30m",
    f"""WITH {SNAPS_SQL}, long AS ({UNPIVOT_SQL})
    SELECT CAST(customerId AS BIGINT) AS customer_no, eventTimeMs // 1800000 * 1800000 AS window_start_ms, dimension,
           round(avg(score), 6) AS mean, count(*) AS snapshots
    FROM long GROUP BY 1, 2, 3""",
)
def scan_baseline_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baselines(batch_snapshots(spark, sf_dir)).select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("windowStartMs").alias("window_start_ms"),
        "dimension", F.round("mean", 6).alias("mean"), "snapshots",
    )


@query(
    "scan_session_enrich",
    f"""WITH {SNAPS_SQL}, sessions AS (
      SELECT concat(CAST(user_id AS VARCHAR), '-', CAST((epoch_us(ts) // 1000) // 604800000 AS VARCHAR)) AS scanId,
             last(event_type ORDER BY ts, event_id) AS scanType, last(CAST(json_extract_string(props, '$.k') AS INT) ORDER BY ts, event_id) AS motion
      FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1)
    SELECT s.scanId AS scan_id, s.eventTimeMs AS event_time_ms, s.events, x.scanType AS scan_type, x.motion
    FROM snaps s LEFT JOIN sessions x ON s.scanId = x.scanId""",
)
def scan_session_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase"))
    week = F.expr("unix_millis(cast(ts as timestamp)) div 604800000").cast("string")
    sessions = events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), week).alias("scanId"),
        F.struct("ts", "event_id").alias("at"),
        F.col("event_type").alias("scan_type"),
        F.get_json_object("props", "$.k").cast("int").alias("motion"),
    )
    enriched = enrich_with_sessions(batch_snapshots(spark, sf_dir), sessions, ["scan_type", "motion"], time="at")
    return enriched.select(
        F.col("scanId").alias("scan_id"), F.col("eventTimeMs").alias("event_time_ms"), F.col("events").cast("bigint").alias("events"),
        "scan_type", "motion",
    )


@query(
    "session_activity",
    f"""WITH {TELEMETRY_SQL}, g AS (
      SELECT *, CASE WHEN eventTime - lag(eventTime) OVER w < 3600000 THEN 0 ELSE 1 END AS opens FROM telemetry
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id)),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY customerId ORDER BY eventTime, event_id) AS session FROM g)
    SELECT CAST(customerId AS BIGINT) AS customer_no, min(eventTime) AS session_start_ms, max(eventTime) + 3600000 AS session_end_ms,
           count(*) AS events FROM n GROUP BY customerId, session""",
)
def q_session_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_activity(numbered(spark, sf_dir), position="seq").select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("sessionStartMs").alias("session_start_ms"),
        F.col("sessionEndMs").alias("session_end_ms"), "events",
    )


@query(
    "daily_activity",
    f"""WITH {TELEMETRY_SQL} SELECT CAST(customerId AS BIGINT) AS customer_no, eventType AS event_type,
        eventTime // 86400000 AS day_no, count(*) AS events FROM telemetry GROUP BY 1, 2, 3""",
)
def q_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_activity(numbered(spark, sf_dir), ["customerId", "eventType"]).select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("eventType").alias("event_type"),
        F.unix_date("day").cast("bigint").alias("day_no"), "events",
    )
