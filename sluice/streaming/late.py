"""Windowed sums that lose no row silently.

Spark's own windows drop rows that come after their window has closed and say no more than
how many. Here a micro-batch is compared with the watermark of the batches before it: rows of
closed windows go to the dead letters with a reason of their own, all others are added to the
open windows, which are a carried table of one row per key and window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.verdict import clean_rows, dead_letters, fail_rows, with_verdict
from ..session import cut_lineage
from .carry import CLOCK_DDL, CarriedTable, newest_time
from .jobs import start

LATE, REASON = "LateDataOperator", "LATE_EVENT"


def window_start(time: Column, width_ms: int) -> Column:
    return time - F.pmod(time, F.lit(width_ms))


def split_late(df: DataFrame, watermark_ms: int | None, width_ms: int, stream_key: str, time: str = "eventTime") -> tuple[DataFrame, DataFrame]:
    """(rows in time, dead letters of the late ones): a row is late if its window ended at or
    before the watermark. Rows without a time have no window and are in time."""
    at = F.col(time).try_cast("bigint")
    late = window_start(at, width_ms) + width_ms <= F.lit(watermark_ms)
    message = F.when(late, F.concat(F.lit("Event time "), at.cast("string"), F.lit(f" is in a window that closed before {watermark_ms}")))
    verdicts = fail_rows(with_verdict(df), LATE, REASON, message)
    return clean_rows(verdicts).select(*df.columns), dead_letters(verdicts, stream_key, time)


def window_sums_stream(
    df: DataFrame, keys: list[str], value: str, width_ms: int, lag_seconds: int, root: str, checkpoint: str, stream_key: str,
    time: str = "eventTime", available_now: bool = False, write_late: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Count and sum of ``value`` per key and tumbling window, each window once when the
    watermark has passed it, under ``root``/windows; late rows under ``root``/late or to
    ``write_late``. Folders are per micro-batch, so a repeated one replaces what it wrote."""
    spark: SparkSession = df.sparkSession
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ddl = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", windowStartMs bigint, events bigint, total double"
    waiting, clock = CarriedTable(f"{root}/open", ddl), CarriedTable(f"{root}/clock", CLOCK_DDL)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(batch)
        known = clock.before(spark, batch_id)
        before = known.first()
        watermark = before["newest"] - lag_seconds * 1000 if before else None
        on_time, late = split_late(rows, watermark, width_ms, stream_key, time)
        if write_late:
            write_late(late, batch_id)
        else:
            late.write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
        at = window_start(F.col(time).try_cast("bigint"), width_ms).alias("windowStartMs")
        sums = on_time.where(F.col(time).isNotNull()).select(*keys, at, F.col(value).cast("double").alias("_v"))
        sums = sums.groupBy(*keys, "windowStartMs").agg(F.count(F.lit(1)).alias("events"), F.sum("_v").alias("total"))
        both = waiting.before(spark, batch_id).unionByName(sums)
        merged = cut_lineage(both.groupBy(*keys, "windowStartMs").agg(F.sum("events").alias("events"), F.sum("total").alias("total")))
        newest = newest_time(rows, known, time)
        closed = F.col("windowStartMs") + width_ms <= F.lit(newest - lag_seconds * 1000)
        merged.where(closed).write.mode("overwrite").parquet(f"{root}/windows/batch_id={batch_id}")
        waiting.after(merged.where(~closed), batch_id)
        clock.after(spark.createDataFrame([(newest,)], CLOCK_DDL), batch_id)

    return start(df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step), available_now)
