"""Lake tables: layout, partitioned append, upsert, erasure.

Parquet works everywhere; ``iceberg`` and ``delta`` work where their jars are on
the class path, and then upsert and erasure use the format's own row changes.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import SinkConfig
from ..operators.verdict import ANOMALY, ENVELOPE
from ..session import cut_lineage
from .buckets import newest_per_key

log = logging.getLogger(__name__)

# Codec and file size of the lake tables.
CODEC = "zstd"
TARGET_FILE_BYTES = 134_217_728
EVENT_DATE = "eventDate"
ROW_FORMATS = ("iceberg", "delta")


def database_name(sink: SinkConfig, env: str, prefix: str = "") -> str:
    return f"{prefix}{sink.database}_{env}"


def table_path(root: str, sink: SinkConfig, env: str, prefix: str = "") -> str:
    return f"{root.rstrip('/')}/{database_name(sink, env, prefix)}/{sink.table}"


def with_partitions(df: DataFrame, columns: list[str], time: str = "eventTime") -> tuple[DataFrame, list[str]]:
    """Add ``eventDate`` (UTC day of the event time) where asked for. Columns the
    data lacks are skipped with a warning."""
    present = []
    for name in columns:
        if name == EVENT_DATE and name not in df.columns and time in df.columns:
            df = df.withColumn(EVENT_DATE, F.to_date(F.timestamp_millis(F.col(time).try_cast("bigint"))))
        if name in df.columns:
            present.append(name)
        else:
            log.warning("partition column %s is not in the data, skipping", name)
    return df, present


def distributed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Hash distribution by partition value. ``rebalance`` lets adaptive
    execution split a value that holds much of the data over several writers and
    merge small ones, so neither one huge task nor many tiny files result."""
    return df.hint("rebalance", *columns)


def write_lake(
    df: DataFrame,
    path: str,
    partition_columns: list[str] | None = None,
    time: str = "eventTime",
    fmt: str = "parquet",
    mode: str = "append",
) -> None:
    df, present = with_partitions(df.drop(*ENVELOPE), partition_columns or [], time)
    writer = distributed(df, present).write.format(fmt).mode(mode).option("compression", CODEC)
    (writer.partitionBy(*present) if present else writer).save(path)


def qualified_name(sink: SinkConfig, env: str, prefix: str = "") -> str:
    return f"`{database_name(sink, env, prefix)}`.`{sink.table}`"


def added_partitions(spark: SparkSession, name: str, columns: list[str]) -> None:
    """Tell the catalogue of partitions that a write to the table's folder has added."""
    if any(c.name in columns and c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def ensure_table(
    spark: SparkSession, sink: SinkConfig, schema: T.StructType, root: str, env: str, prefix: str = "", fmt: str = "parquet"
) -> str:
    """Create database and table on first use; returns the qualified name."""
    database = database_name(sink, env, prefix)
    name = qualified_name(sink, env, prefix)
    fields = [f for f in schema.fields if f.name not in ENVELOPE]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    known = {f.name for f in fields}
    partitions = [c for c in sink.partition_columns if c in known or c == EVENT_DATE]
    if EVENT_DATE in partitions and EVENT_DATE not in known:
        columns.append(f"`{EVENT_DATE}` date")
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root.rstrip('/')}/{database}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {fmt}{by} "
        f"LOCATION '{table_path(root, sink, env, prefix)}'"
    )
    return name


def upsert(updates: DataFrame, keys: list[str], order: list[str], table: str) -> None:
    """Merge into a table of a row-level format."""
    source = newest_per_key(updates.drop(*ENVELOPE, ANOMALY), keys, order).alias("source")
    matches = " AND ".join(f"{table}.{k} = source.{k}" for k in keys)
    source.mergeInto(table, F.expr(matches)).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def without(df: DataFrame, ids: DataFrame, column: str = "customerId") -> DataFrame:
    """Rows of all but the given ids; rows without an id stay."""
    return df.join(ids.select(column).distinct(), column, "left_anti").select(*df.columns)


def erase(spark: SparkSession, ids: DataFrame, path: str, new_path: str | None = None, column: str = "customerId",
          partition_columns: list[str] | None = None, table: str | None = None, fmt: str = "parquet") -> None:
    """Erase customers: row-level delete where the format has one, else rewrite
    the table into ``new_path``."""
    if fmt in ROW_FORMATS:
        cut_lineage(ids.select(column).distinct()).createOrReplaceTempView("_erase_ids")
        spark.sql(f"DELETE FROM {table} WHERE {column} IN (SELECT {column} FROM _erase_ids)")
        return
    if not new_path or new_path == path:
        raise ValueError("a Parquet table is rewritten into another path")
    write_lake(without(spark.read.parquet(path), ids, column), new_path, partition_columns, mode="overwrite")


def epoch_or_zero(column: Column) -> Column:
    return F.coalesce(column.try_cast("bigint"), F.lit(0).cast("bigint"))
