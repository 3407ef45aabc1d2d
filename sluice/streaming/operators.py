"""Streaming twins of the stateful operators: same columns in and out as the
batch versions, with state kept by processors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import AnomalyRule, StreamDefinition
from ..functions.numbers import as_double, field_or_null
from ..operators.anomaly import ANOMALY, DETECTOR, anomaly_key
from ..operators.dedup import DEDUP, key_text, limit_ms
from ..operators.scans import COMPLETION, SCAN_STREAMS, SCORES, SNAPSHOT_TIMEOUT_MS, scan_key
from ..operators.verdict import FAILURES, LIVE, STREAM_KEY, append_failure, failure, with_verdict
from ..session import use_rocksdb_state
from .processors import AnomalyProcessor, DedupProcessor, SnapshotProcessor


ORDER = "_order"


def _plus(df: DataFrame, name: str, dtype: T.DataType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType([*fields, T.StructField(name, dtype)])


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def with_order(df: DataFrame, position: str | None) -> tuple[DataFrame, str, list[str]]:
    """A column that orders rows of equal time, and what to drop afterwards. Streams
    without a position of their own take a hash of the row: only equal rows tie."""
    if position is not None:
        return df, position, []
    return df.withColumn(ORDER, row_hash(df)), ORDER, [ORDER]


def state_key(key: Column, position: str) -> Column:
    """Only live rows meet their key's state; the others are spread by position."""
    return F.when(F.col(LIVE), key).otherwise(F.concat(F.lit("\0"), F.coalesce(F.col(position).cast("string"), F.lit(""))))


def dedup_stream(df: DataFrame, keys: list[str], ttl_hours: float = 24, time: str = "eventTime", position: str | None = None) -> DataFrame:
    """As ``operators.dedup.dedup``; the input needs a watermark."""
    use_rocksdb_state(df.sparkSession)
    df, position, own = with_order(with_verdict(df), position)
    df = df.withColumn("_dedup_key", state_key(key_text(df, keys), position))
    processor = DedupProcessor(time, position, LIVE, limit_ms(ttl_hours))
    rows = df.groupBy("_dedup_key").transformWithState(
        statefulProcessor=processor,
        outputStructType=_plus(df, "_accepted", T.BooleanType()),
        outputMode="Append",
        timeMode="EventTime",
    )
    repeated = F.col(LIVE) & ~F.col("_accepted")
    message = F.concat(F.lit(f"Duplicate {','.join(keys)}='"), F.col("_dedup_key"), F.lit("'"))
    return rows.withColumns(
        {
            FAILURES: append_failure(repeated, failure(DEDUP, "DUPLICATE_EVENT", message)),
            LIVE: F.col(LIVE) & F.col("_accepted"),
        }
    ).drop("_dedup_key", "_accepted", *own)


def detect_anomalies_stream(
    df: DataFrame, rules: list[AnomalyRule], stream_key: str = "", key: str | None = None,
    time: str = "eventTime", position: str | None = None, expire_ms: int | None = None,
) -> DataFrame:
    """As ``operators.anomaly.detect_anomalies``. With ``expire_ms`` a key's state goes so long
    after its newest row, in event time; the input then needs a watermark."""
    df = with_verdict(df)
    if not rules:
        return df
    use_rocksdb_state(df.sparkSession)
    df, position, own = with_order(df, position)
    values = F.array(*[as_double(df, rule.field) for rule in rules])
    df = df.withColumns({"_anomaly_key": state_key(anomaly_key(df, key, stream_key), position), "_values": values})
    plain = [
        {"method": r.method, "threshold": float(r.threshold), "rows": r.rows, "suppress": r.on_anomaly != "FLAG_AND_FORWARD"}
        for r in rules
    ]
    rows = df.groupBy("_anomaly_key").transformWithState(
        statefulProcessor=AnomalyProcessor(time, position, LIVE, "_values", plain, expire_ms),
        outputStructType=_plus(df, "_flags", T.ArrayType(T.BooleanType())),
        outputMode="Append",
        timeMode="EventTime" if expire_ms else "None",
    )
    for i, rule in enumerate(rules):
        flagged = F.get(F.col("_flags"), i)
        shown = F.get(F.col("_values"), i).cast("string")
        message = F.concat(
            F.lit(f"Field '{rule.field}'="), shown,
            F.lit(f" detected as anomaly by {rule.method} (threshold={float(rule.threshold)})"),
        )
        changes = {}
        if rule.on_anomaly != "DROP_RECORD":
            changes[FAILURES] = append_failure(flagged, failure(DETECTOR, "ANOMALY", message))
        if rule.on_anomaly == "FLAG_AND_FORWARD":
            changes[ANOMALY] = F.col(ANOMALY) | flagged
        else:
            changes[LIVE] = F.col(LIVE) & ~flagged
        rows = rows.withColumns(changes)
    return rows.drop("_anomaly_key", "_values", "_flags", *own)


SNAPSHOT_DDL = (
    "customerId string, scanId string, eventTimeMs bigint, firstEventMs bigint, events bigint, scores map<string,double>, "
    "extras map<string,string>, topConcerns array<string>, complete boolean, emittedAtMs bigint"
)


def snapshots_stream(
    df: DataFrame, time: str = "eventTime", position: str | None = None, timeout_ms: int = SNAPSHOT_TIMEOUT_MS,
    event_time: bool = True, stamped: bool = False,
) -> DataFrame:
    """As ``operators.scans.snapshots`` with a timeout; the input needs a
    watermark when the limit counts in event time. ``stamped`` adds the
    event-time column ``closedTs``: when the snapshot was completed or timed out."""
    use_rocksdb_state(df.sparkSession)
    df, position, _ = with_order(df, position)
    events = df.where(F.col(STREAM_KEY).isin(*SCAN_STREAMS))
    stream = F.col(STREAM_KEY)
    used = [(name, source, field) for name, source, field in SCORES if field in df.columns]
    # The watermark column has to reach the processor's operator.
    watermarked = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    slim = events.select(
        scan_key(df).alias("_scan"),
        field_or_null(df, "customerId").cast("string").alias("customerId"),
        stream,
        F.col(time),
        F.col(position),
        *[F.col(c) for c in watermarked],
        *[F.when(stream == s, as_double(df, f)).alias(f"_s_{n}") for n, s, f in used],
        F.when(stream == "scan-facial", field_or_null(df, "skinToneLabel").cast("string")).alias("_tone"),
        (F.when(stream == COMPLETION, F.col("topConcerns")) if "topConcerns" in df.columns else F.lit(None).cast("array<string>"))
        .alias("_concerns"),
    )
    processor = SnapshotProcessor(time, position, STREAM_KEY, COMPLETION, [(n, f"_s_{n}") for n, _, _ in used], timeout_ms, event_time, stamped)
    event_time_column = {"eventTimeColumnName": "closedTs"} if stamped else {}
    return slim.groupBy("_scan").transformWithState(
        statefulProcessor=processor,
        outputStructType=SNAPSHOT_DDL + (", closedTs timestamp" if stamped else ""),
        outputMode="Append",
        timeMode="EventTime" if event_time else "ProcessingTime",
        **event_time_column,
    )


def stream_verdicts(df: DataFrame, definition: StreamDefinition, time: str = "eventTime", position: str | None = None) -> DataFrame:
    """The whole chain on a watermarked streaming frame."""
    from ..plans.quality import stateless_verdicts

    df = stateless_verdicts(df, definition)
    quality = definition.quality
    if quality is None:
        return df
    if quality.dedup_fields:
        df = dedup_stream(df, quality.dedup_fields, quality.dedup_ttl_hours, time, position)
    return detect_anomalies_stream(df, quality.anomaly_detection, definition.key, quality.anomaly_key, time, position)
