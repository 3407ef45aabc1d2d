"""Continuous jobs: one query and one checkpoint per stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DeadLetterConfig, SourceConfig, StreamDefinition, Topology
from ..functions.crypto import encrypt_fields
from ..operators import recommend as rec
from ..plans.quality import split_verdicts
from ..schemas import read_schema
from ..session import scratch_path
from ..sinks.buckets import read_upserts, upsert_version, versions
from ..sinks.deadletter import dlq_path, seal, write_dlq
from ..sinks.fanout import write_sinks
from ..sources.catalog import catalog_latest
from ..sources.readers import read_stream, union_live, union_streams, with_envelope, with_event_time
from ..operators.scans import SCAN_STREAMS, SNAPSHOT_TIMEOUT_MS
from .operators import snapshots_stream, stream_verdicts

# Fixed value: the default distance between checkpoints, here the trigger.
TRIGGER = "60 seconds"


def start(writer, available_now: bool, trigger: str = TRIGGER) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def ingest_stream(
    df: DataFrame,
    definition: StreamDefinition,
    dlq: DeadLetterConfig,
    root: str,
    checkpoint: str,
    env: str = "dev",
    position: str | None = None,
    data_key: bytes | None = None,
    wrapped_key: bytes = b"",
    encrypt: bool = True,
    available_now: bool = False,
    fmt: str = "parquet",
    carried: str | None = None,
) -> StreamingQuery:
    """Chain, encryption, all sinks and dead letters. Every write of a micro-batch
    goes to that batch's folder and replaces it, so a repeat after a failure
    leaves the same tables. With ``carried``, a folder, dedup and anomaly rules run as batch
    operators with tables carried there, which splits keys of any size over many tasks."""
    events = with_event_time(with_envelope(df, definition.key), lag_seconds=definition.watermark_lag_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.drop("_event_ts").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            clean, dead = split_verdicts(kept, definition)
            sealed = encrypt_fields(clean, definition.sensitive_fields, data_key, wrapped_key, encrypt)
            write_sinks(sealed, definition, root, env, batch_id=batch_id, fmt=fmt)
            folder = f"{dlq_path(dlq, root, env)}/source={definition.key}/batch_id={batch_id}"
            dead = seal(dead, definition.sensitive_fields, data_key, wrapped_key, encrypt)
            write_dlq(dead, dlq, folder, mode="overwrite")
        finally:
            kept.unpersist()

    if carried is not None:
        from .carry import quality_carried

        return quality_carried(events, definition, write, carried, checkpoint, position=position, available_now=available_now)
    verdicts = stream_verdicts(events, definition, position=position)
    return start(verdicts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)


def recommender(
    catalog: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    preferences: Callable[[], DataFrame] | None = None,
    bought: Callable[[], DataFrame] | None = None,
    top_n: int = rec.TOP_N,
) -> Callable[[DataFrame, int], None]:
    """What writes the recommendations of a micro-batch of snapshots. The tables are read
    again for every micro-batch, so catalogue changes take effect with the next one."""

    def score(batch: DataFrame, batch_id: int) -> None:
        found = rec.recommend(
            batch, catalog(), preferences() if preferences else None, bought() if bought else None, top_n
        )
        write(found, batch_id)

    return score


def recommend_stream(
    snaps: DataFrame,
    catalog: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    preferences: Callable[[], DataFrame] | None = None,
    bought: Callable[[], DataFrame] | None = None,
    top_n: int = rec.TOP_N,
    available_now: bool = False,
) -> StreamingQuery:
    """Recommendations per micro-batch of snapshots, see ``recommender``."""
    score = recommender(catalog, write, preferences, bought, top_n)
    return start(snaps.writeStream.option("checkpointLocation", checkpoint).foreachBatch(score), available_now)


def baselines_stream(events: DataFrame, width: str = "30 minutes", timeout_ms: int = SNAPSHOT_TIMEOUT_MS, position: str | None = None) -> DataFrame:
    """Tumbling means over all snapshots as a streaming frame, completed ones and
    those that the timeout closed. The window goes by the time at which a snapshot
    closed, as ``operators.scans.closing_time`` gives it in batch."""
    snaps = snapshots_stream(events, position=position, timeout_ms=timeout_ms, stamped=True)
    exploded = snaps.select("customerId", "closedTs", F.explode("scores").alias("dimension", "score"))
    return (
        exploded.groupBy("customerId", F.window("closedTs", width).alias("_w"), "dimension")
        .agg(F.avg("score").alias("mean"), F.count("score").alias("snapshots"))
        .select(
            "customerId",
            F.unix_millis(F.col("_w.start")).alias("windowStartMs"),
            F.unix_millis(F.col("_w.end")).alias("windowEndMs"),
            "dimension",
            "mean",
            "snapshots",
        )
    )


CATALOG, RECOMMENDATIONS = "product-catalog", "product-recommendations"


def scan_events(streams: dict[str, DataFrame], lag_seconds: int = 30, sources: dict[str, SourceConfig] | None = None) -> DataFrame:
    """The scan streams by key as one watermarked stream; with ``sources`` each has its own
    lag and idle timeout."""
    if sources:
        return union_live({key: (df, sources[key]) for key, df in streams.items()})
    united = union_streams(*[with_envelope(df, key) for key, df in streams.items()])
    return with_event_time(united, lag_seconds=lag_seconds)


def topology_streams(spark: SparkSession, topology: Topology, keys: tuple[str, ...], **options) -> dict[str, DataFrame]:
    """Those of the streams that the topology declares, as streaming frames."""
    return {d.key: read_stream(spark, d, **options) for d in topology.streams if d.key in keys}


def catalog_table_stream(changes: DataFrame, table: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """The catalogue's change feed as an upsert table: the newest change per product.
    Removals stay as rows, so that an older change that comes late revives nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_version(batch, ["productId"], ["eventTime"], table, batch_id)

    return start(changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge), available_now)


def catalog_now(spark: SparkSession, table: str) -> DataFrame:
    """The products that are in the catalogue by now; none before its first change."""
    if not versions(spark, table):
        return spark.createDataFrame([], read_schema(CATALOG))
    return catalog_latest(read_upserts(spark, table))


def recommendation_job_stream(
    scans: dict[str, DataFrame],
    catalog_changes: DataFrame,
    definition: StreamDefinition,
    root: str,
    checkpoint: str,
    env: str = "dev",
    timeout_ms: int = SNAPSHOT_TIMEOUT_MS,
    lag_seconds: int = 30,
    position: str | None = None,
    preferences: Callable[[], DataFrame] | None = None,
    bought: Callable[[], DataFrame] | None = None,
    top_n: int = rec.TOP_N,
    available_now: bool = False,
    sources: dict[str, SourceConfig] | None = None,
) -> list[StreamingQuery]:
    """Scan streams and the catalogue's change feed to the sinks of the recommendation stream
    ``definition``, as two queries with a checkpoint each: one keeps the catalogue table below
    ``root``, the other joins closed snapshots with the catalogue as it is at each micro-batch.
    A snapshot that closes before the first product is known gives no row. With
    ``available_now`` the catalogue is brought up to date first."""
    table = f"{root}/catalog_state_{env}"
    keeping = catalog_table_stream(catalog_changes, table, f"{checkpoint}/catalog", available_now)
    if available_now:
        keeping.awaitTermination()
    spark = catalog_changes.sparkSession
    events = scan_events(scans, lag_seconds, sources)

    def write(found: DataFrame, batch_id: int) -> None:
        write_sinks(rec.to_output(found), definition, root, env, batch_id=batch_id)

    snaps = snapshots_stream(events, position=position, timeout_ms=timeout_ms)
    scoring = recommend_stream(
        snaps, lambda: catalog_now(spark, table), write, f"{checkpoint}/recommendations", preferences, bought, top_n, available_now
    )
    return [keeping, scoring]


def recommend_from_topology(
    spark: SparkSession, topology: Topology, root: str, checkpoint: str, max_files_per_trigger: int | None = None, **options
) -> list[StreamingQuery]:
    """The recommendation job on the streams that a topology declares, each with its own lag
    and idle timeout unless the job only takes what is there now."""
    read = {"max_files_per_trigger": max_files_per_trigger}
    scans = topology_streams(spark, topology, SCAN_STREAMS, **read)
    changes = topology_streams(spark, topology, (CATALOG,), **read)
    if not scans or not changes:
        raise ValueError(f"the topology declares no {'scan stream' if not scans else CATALOG}")
    sources = None if options.get("available_now") else {key: topology.stream(key).source for key in scans}
    return recommendation_job_stream(
        scans, changes[CATALOG], topology.stream(RECOMMENDATIONS), root, checkpoint, sources=sources, **options
    )


def scan_analytics_stream(
    streams: dict[str, DataFrame],
    root: str,
    checkpoint: str,
    timeout_ms: int = SNAPSHOT_TIMEOUT_MS,
    lag_seconds: int = 30,
    position: str | None = None,
    available_now: bool = False,
    sources: dict[str, SourceConfig] | None = None,
) -> list[StreamingQuery]:
    """Snapshots and 30-minute means of the scan streams by key, each as a Parquet table
    under ``root``. Two queries with a checkpoint each, so either can be restarted alone.
    With ``sources`` each stream has its own lag and idle timeout."""
    events = scan_events(streams, lag_seconds, sources)
    found = {
        "snapshots": snapshots_stream(events, position=position, timeout_ms=timeout_ms),
        "baselines": baselines_stream(events, timeout_ms=timeout_ms, position=position),
    }
    return [
        start(
            df.writeStream.format("parquet").option("path", f"{root}/{name}").option("checkpointLocation", f"{checkpoint}/{name}"),
            available_now,
        )
        for name, df in found.items()
    ]


def run_available(df: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there now into a Parquet table and read it back."""
    spark: SparkSession = df.sparkSession
    target = path or scratch_path(spark, label)
    state = checkpoint or scratch_path(spark, f"{label}-checkpoint")
    writer = df.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", state)
    start(writer, available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(target)

