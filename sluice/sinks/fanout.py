"""One frame, several targets, read once."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..config import SinkConfig, StreamDefinition
from .buckets import upsert_version
from .lake import ROW_FORMATS, added_partitions, ensure_table, qualified_name, table_path, upsert, write_lake
from .rows import jdbc_rows, write_jdbc

log = logging.getLogger(__name__)
Writer = Callable[[DataFrame], None]


def sink_writer(definition: StreamDefinition, sink: SinkConfig, root: str, env: str, prefix: str = "",
                batch_id: int | None = None, fmt: str = "parquet", jdbc_properties: dict[str, str] | None = None,
                create: bool = True) -> Writer:
    """The write for one target. With a ``batch_id`` file targets write into a
    folder of that batch and replace it, so a repeated batch leaves no copies. Without one,
    ``create`` makes database and table in the catalogue at the first write."""
    path = table_path(root, sink, env, prefix)
    if sink.type == "ICEBERG" and sink.write_mode == "UPSERT" and sink.upsert_fields:
        if fmt in ROW_FORMATS:
            def merge(df: DataFrame) -> None:
                upsert(df, sink.upsert_fields, ["eventTime"], ensure_table(df.sparkSession, sink, df.schema, root, env, prefix, fmt))

            return merge
        return lambda df: upsert_version(df, sink.upsert_fields, ["eventTime"], path, batch_id)
    if sink.type == "ICEBERG" or (sink.type == "DATABRICKS_DELTA" and sink.mode == "DELTA"):
        if batch_id is not None and fmt in ROW_FORMATS:
            raise ValueError(f"appends of micro-batches to {fmt} tables are not repeatable here; use parquet or an upsert sink")
        target = sink.delta_path or path

        def append(df: DataFrame) -> None:
            """The first write creates the table; micro-batches are folders of a Parquet table of
            their own, which ``read_lake`` reads."""
            if batch_id is not None:
                write_lake(df, f"{target}/batch_id={batch_id}", sink.partition_columns, fmt=fmt, mode="overwrite")
                return
            if create and not sink.delta_path:
                ensure_table(df.sparkSession, sink, df.schema, root, env, prefix, fmt)
            write_lake(df, target, sink.partition_columns, fmt=fmt)
            if create and not sink.delta_path and fmt not in ROW_FORMATS:
                added_partitions(df.sparkSession, qualified_name(sink, env, prefix), sink.partition_columns)

        return append
    if sink.type == "DATABRICKS_DELTA":
        if not sink.jdbc_url or not sink.target_table:
            raise ValueError(f"the JDBC sink of {definition.key!r} needs jdbcUrl and targetTable")
        return lambda df: write_jdbc(jdbc_rows(df, definition.key), sink.jdbc_url, sink.target_table, jdbc_properties)
    raise NotImplementedError(f"sink type {sink.type} has no writer")


def fan_out(df: DataFrame, writers: list[Writer], label: str = "") -> None:
    """Hand the frame to every writer. It is kept on disk between them, so the
    plan before it runs once; lost blocks are recomputed."""
    if not writers:
        log.warning("stream %s has no sinks, rows are discarded", label)
        return
    if len(writers) == 1:
        writers[0](df)
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writers:
            write(kept)
    finally:
        kept.unpersist()


def write_sinks(df: DataFrame, definition: StreamDefinition, root: str, env: str, prefix: str = "",
                batch_id: int | None = None, fmt: str = "parquet", create: bool = True) -> None:
    writers = [sink_writer(definition, sink, root, env, prefix, batch_id, fmt, create=create) for sink in definition.sinks]
    fan_out(df, writers, definition.key)
