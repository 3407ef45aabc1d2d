"""The three batch jobs: ingestion, scan analytics, recommendation. The same
steps run continuously in ``sluice.streaming.jobs``."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..config import DeadLetterConfig, StreamDefinition
from ..functions.crypto import encrypt_fields
from ..operators import recommend as rec
from ..operators.scans import baselines, closing_time, snapshots
from ..sinks.deadletter import dlq_path, seal, write_dlq
from ..sinks.fanout import write_sinks
from ..sources.catalog import catalog_latest
from ..sources.readers import union_streams, with_envelope
from .quality import quality_verdicts, split_verdicts


def ingest(
    df: DataFrame,
    definition: StreamDefinition,
    dlq: DeadLetterConfig,
    root: str,
    env: str = "dev",
    position: str | None = None,
    data_key: bytes | None = None,
    wrapped_key: bytes = b"",
    encrypt: bool = True,
) -> None:
    """Quality chain, encryption, all sinks and the dead-letter table. The
    verdicts are kept on disk, so both outputs come from one run of the chain."""
    verdicts = quality_verdicts(with_envelope(df, definition.key), definition, position=position)
    verdicts = verdicts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        clean, dead = split_verdicts(verdicts, definition)
        sealed = encrypt_fields(clean, definition.sensitive_fields, data_key, wrapped_key, encrypt)
        write_sinks(sealed, definition, root, env)
        dead = seal(dead, definition.sensitive_fields, data_key, wrapped_key, encrypt)
        write_dlq(dead, dlq, dlq_path(dlq, root, env))
    finally:
        verdicts.unpersist()


def scan_analytics(streams: dict[str, DataFrame], position: str | None = None, timeout_ms: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Snapshots and 30-minute baselines from the scan streams by key. With a timeout a
    snapshot counts in the window in which it closed, as in the continuous job."""
    united = union_streams(*[with_envelope(df, key) for key, df in streams.items()])
    snaps = snapshots(united, position=position, timeout_ms=timeout_ms)
    if timeout_ms is None:
        return snaps, baselines(snaps)
    return snaps, baselines(snaps.withColumn("_closed", closing_time(timeout_ms)), time="_closed")


def recommendations(
    snaps: DataFrame,
    catalog_changes: DataFrame,
    preferences: DataFrame | None = None,
    orders: DataFrame | None = None,
    as_of_ms: int | None = None,
    top_n: int = rec.TOP_N,
    gate: bool = False,
) -> DataFrame:
    """Snapshots to product recommendations in their stream's layout. With
    ``as_of_ms`` old scans and old purchases are left out; ``gate`` keeps only
    scans that changed enough."""
    if as_of_ms is not None:
        snaps = rec.recent_scans(snaps, as_of_ms)
    if gate:
        snaps = rec.change_gate(snaps).select(*snaps.columns)
    bought = rec.purchases(orders, as_of_ms) if orders is not None and as_of_ms is not None else None
    skin = rec.latest_skin_type(preferences) if preferences is not None else None
    return rec.to_output(rec.recommend(snaps, catalog_latest(catalog_changes), skin, bought, top_n))
