"""Continuous versions, run over what is there (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import AnomalyRule, QualityConfig, StreamDefinition
from ..operators.verdict import ANOMALY, FAILURES, LIVE
from ..plans.adapters import SCAN_SQL, TELEMETRY_SQL, scan_events_of, table, telemetry_of
from ..session import scratch_path
from ..sources.readers import stream_table, with_event_time
from ..streaming.carry import baselines_carried, quality_carried, recommend_carried, run_carried, snapshots_carried
from ..streaming.late import window_sums_stream
from . import query
from .quality import chain_cte
from .recommendations import CATALOG_LATEST_SQL, TOP_SQL, _MATCHED, flat_top, products
from .scans import FLAT_SQL, LONG_TIMEOUT_MS, TIMED_SQL, flat

LAG_SECONDS = 30
MAX_FILES = 1000  # micro-batches stay bounded when a table has very many files


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return stream_table(spark, f"{sf_dir}/events.parquet", schema, MAX_FILES)


def live_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry_of(live_events(spark, sf_dir)).withColumn("seq", F.col("eventId").cast("bigint"))
    return with_event_time(events.select("seq", "customerId", "eventTime", "value"), lag_seconds=LAG_SECONDS)


def live_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(scan_events_of(live_events(spark, sf_dir)), lag_seconds=LAG_SECONDS)


@query(
    "q_dedup_ttl_stream",
    f"""WITH RECURSIVE {TELEMETRY_SQL}, {chain_cte('telemetry', 'customerId', 86_400_000)}
    SELECT event_id AS seq, accepted AS live, CASE WHEN NOT accepted THEN 'DUPLICATE_EVENT' END AS reason FROM chain""",
)
def q_dedup_ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = StreamDefinition("telemetry", quality=QualityConfig(dedup_key="customerId", dedup_ttl_hours=24))
    marked = run_carried(live_telemetry(spark, sf_dir), quality_carried, "dedup", definition=definition, position="seq")
    reason = F.get(F.col(FAILURES), 0)["reason"].alias("reason")
    return marked.select("seq", F.col(LIVE).alias("live"), reason)


@query(
    "q_anomaly_stddev_stream",
    f"""WITH {TELEMETRY_SQL}, s AS (
      SELECT event_id, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM telemetry
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id AS seq, coalesce(n >= 5 AND sd > 0 AND abs(value - m) > 3.0 * sd, FALSE) AS anomaly FROM s""",
)
def q_anomaly_stddev_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = StreamDefinition("telemetry", quality=QualityConfig(anomaly_detection=[AnomalyRule("value", threshold=3.0)]))
    marked = run_carried(live_telemetry(spark, sf_dir), quality_carried, "anomaly", definition=definition, position="seq")
    return marked.select("seq", F.col(ANOMALY).alias("anomaly"))


# A snapshot that only a timer closes is out once the watermark has passed it.
CLOSED_SQL = f"""closed AS (
      SELECT * FROM snaps WHERE complete OR firstEventMs + {LONG_TIMEOUT_MS} <= (SELECT max(eventTime) FROM scan_dim) - {LAG_SECONDS * 1000}
             OR EXISTS (SELECT 1 FROM snaps later WHERE later.scanId = snaps.scanId AND later.firstEventMs > snaps.firstEventMs))"""


@query("scan_snapshots_stream", f"WITH RECURSIVE {TIMED_SQL}, {CLOSED_SQL} SELECT {FLAT_SQL} FROM closed")
def scan_snapshots_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(run_carried(live_scans(spark, sf_dir), snapshots_carried, "snapshots", lag_seconds=LAG_SECONDS, timeout_ms=LONG_TIMEOUT_MS))


_CLOSED_LONG_SQL = " UNION ALL ".join(
    f"SELECT customerId, CASE WHEN complete THEN eventTimeMs ELSE firstEventMs + {LONG_TIMEOUT_MS} END AS closedMs, '{name}' AS dimension, {name} AS score FROM snaps WHERE {name} IS NOT NULL"
    for name in ("hydration", "texture", "wrinkle", "radiance", "overall")
)


@query(
    "scan_baseline_stream",
    f"""WITH RECURSIVE {TIMED_SQL}, long AS ({_CLOSED_LONG_SQL})
    SELECT CAST(customerId AS BIGINT) AS customer_no, closedMs // 1800000 * 1800000 AS window_start_ms, dimension,
           round(avg(score), 6) AS mean, count(*) AS snapshots
    FROM long GROUP BY 1, 2, 3
    HAVING window_start_ms + 1800000 <= (SELECT max(eventTime) FROM scan_dim) - {LAG_SECONDS * 1000}""",
)
def scan_baseline_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_carried(live_scans(spark, sf_dir), baselines_carried, "baselines", lag_seconds=LAG_SECONDS, timeout_ms=LONG_TIMEOUT_MS)
    return found.select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("windowStartMs").alias("window_start_ms"),
        "dimension", F.round("mean", 6).alias("mean"), "snapshots",
    )


_LATE = f"""WITH {SCAN_SQL}, first_wave AS (SELECT max(eventTime) AS newest FROM scan_dim WHERE streamKey <> 'scan-overall'),
    arrived AS (
      SELECT customerId, eventTime, score, streamKey = 'scan-overall'
             AND eventTime // 1800000 * 1800000 + 1800000 <= (SELECT newest FROM first_wave) - {LAG_SECONDS * 1000} AS late FROM scan_dim)"""
LATE_SQL = f"""{_LATE}
    SELECT CAST(customerId AS BIGINT) AS customer_no, eventTime // 1800000 * 1800000 AS window_start_ms, count(*) AS events,
           round(sum(score), 4) AS total FROM arrived WHERE NOT late GROUP BY 1, 2
    HAVING window_start_ms + 1800000 <= (SELECT max(eventTime) FROM scan_dim) - {LAG_SECONDS * 1000}"""
LATE_LETTERS_SQL = f"{_LATE} SELECT 'LATE_EVENT' AS reason, eventTime // 86400000 AS day_no, count(*) AS events FROM arrived WHERE late GROUP BY 2"


def late_waves(spark: SparkSession, sf_dir: str) -> str:
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "late")

    def run_wave(number: int, arrived: Column) -> None:
        events.where(arrived).write.parquet(f"{path}/input/wave={number}")
        live = spark.readStream.schema(events.schema).parquet(f"{path}/input")
        rows = live.select(
            F.col("user_id").alias("customer_no"), F.unix_millis(F.col("ts").cast("timestamp")).alias("eventTime"), F.least("value", F.lit(100.0)).alias("score")
        )
        window_sums_stream(
            rows, ["customer_no"], "score", 1_800_000, LAG_SECONDS, f"{path}/output", f"{path}/checkpoint", "scan-overall", available_now=True
        ).awaitTermination()

    run_wave(1, F.col("event_type") != "purchase")
    run_wave(2, F.col("event_type") == "purchase")
    return path


@query("late_data_stream", LATE_SQL)
def late_data_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion events arrive only after all others were processed; those whose
    window has closed by then are dead letters, the rest count."""
    found = spark.read.parquet(f"{late_waves(spark, sf_dir)}/output/windows")
    return found.select("customer_no", F.col("windowStartMs").alias("window_start_ms"), "events", F.round("total", 4).alias("total"))


@query("late_dead_letters_stream", LATE_LETTERS_SQL)
def late_dead_letters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came too late, by day of the event."""
    dead = spark.read.parquet(f"{late_waves(spark, sf_dir)}/output/late")
    at = F.get_json_object("original_json", "$.eventTime").cast("bigint")
    return dead.groupBy(F.col("failure_reason").alias("reason"), F.floor(at / 86_400_000).cast("bigint").alias("day_no")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "rec_stream",
    f"""WITH RECURSIVE {TIMED_SQL}, {CLOSED_SQL}, s AS (SELECT *, row_number() OVER () AS sid FROM closed), {CATALOG_LATEST_SQL}, scored AS (
      SELECT s.*, p.productId, greatest(0.0::DOUBLE, {_MATCHED}) AS points FROM s CROSS JOIN products p),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY sid ORDER BY points DESC, productId) AS rank FROM scored QUALIFY rank <= 5) {TOP_SQL}""",
)
def rec_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_carried(
        live_scans(spark, sf_dir), recommend_carried, "recommendations", catalog=lambda: products(spark, sf_dir),
        lag_seconds=LAG_SECONDS, timeout_ms=LONG_TIMEOUT_MS,
    )
    return flat_top(found)
