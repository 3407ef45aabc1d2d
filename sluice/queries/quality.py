"""Quality rules, encryption and the chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import AnomalyRule, FieldValidation, QualityConfig, StreamDefinition, TypeCoercion
from ..functions.crypto import decrypt_field, encrypt_fields, pseudonymize
from ..operators.anomaly import detect_anomalies
from ..operators.dedup import dedup
from ..operators.stateless import coerce_types, handle_nulls, required_fields, validate_fields
from ..operators.verdict import ANOMALY, FAILURES, LIVE
from ..plans.adapters import ORDERS_SQL, PROFILE_SQL, TELEMETRY_SQL, orders_evt, profile, telemetry
from ..plans.quality import attach_quality, quality_verdicts
from . import query

EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with its numeric event number as row position."""
    return telemetry(spark, sf_dir).withColumn("seq", F.col("eventId").cast("bigint"))


def verdict_rows(df: DataFrame, *columns: str | Column) -> DataFrame:
    first = F.get(F.col(FAILURES), 0)
    return df.select(
        *columns, F.col(LIVE).alias("live"), first["reason"].alias("reason"), first["message"].alias("message")
    )


def customer_no() -> Column:
    return F.col("customerId").cast("bigint").alias("customer_no")


@query(
    "q_required_fields",
    f"""WITH {TELEMETRY_SQL}, f AS (
      SELECT *, CASE WHEN eventId IS NULL THEN 'eventId' WHEN firmwareVersion IS NULL OR trim(firmwareVersion) = '' THEN 'firmwareVersion'
                     WHEN batteryLevel IS NULL THEN 'batteryLevel' END AS bad FROM telemetry)
    SELECT event_id AS seq, bad IS NULL AS live, CASE WHEN bad IS NOT NULL THEN 'MISSING_REQUIRED_FIELD' END AS reason,
           CASE WHEN bad IS NOT NULL THEN concat('Field ''', bad, ''' is null or blank') END AS message FROM f""",
)
def q_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_rows(required_fields(numbered(spark, sf_dir), ["eventId", "firmwareVersion", "batteryLevel"]), "seq")


@query(
    "q_coerce_iso8601",
    f"""WITH {PROFILE_SQL}
    SELECT c_custkey AS customer_no,
           CASE WHEN regexp_full_match(eventTimeText, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}Z')
                THEN CAST(epoch_us(strptime(eventTimeText, '%Y-%m-%dT%H:%M:%SZ')) // 1000 AS VARCHAR)
                ELSE eventTimeText END AS event_time_text
    FROM profile""",
)
def q_coerce_iso8601(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [TypeCoercion("eventTimeText", "ISO8601_STRING", "EPOCH_MILLIS")]
    return coerce_types(profile(spark, sf_dir), rules).select(customer_no(), F.col("eventTimeText").alias("event_time_text"))


@query(
    "q_coerce_enum",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, trim(upper(firmwareVersion)) AS firmware FROM telemetry""",
)
def q_coerce_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [TypeCoercion("firmwareVersion", "LOWERCASE_STRING", "UPPERCASE_ENUM")]
    return coerce_types(numbered(spark, sf_dir), rules).select("seq", F.col("firmwareVersion").alias("firmware"))


@query("q_coerce_trim", f"WITH {PROFILE_SQL} SELECT c_custkey AS customer_no, trim(balanceText) AS balance_text FROM profile")
def q_coerce_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [TypeCoercion("balanceText", "TRIM_STRING", "TRIM_STRING")]
    return coerce_types(profile(spark, sf_dir), rules).select(customer_no(), F.col("balanceText").alias("balance_text"))


@query(
    "q_coerce_numeric",
    f"""WITH {PROFILE_SQL} SELECT c_custkey AS customer_no, regexp_replace(balanceText, '[^0-9.-]', '', 'g') AS balance_text,
        CAST(regexp_replace(balanceText, '[^0-9.-]', '', 'g') AS DOUBLE) AS balance FROM profile""",
)
def q_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [TypeCoercion("balanceText", "NUMERIC_STRING", None)]
    balance = F.col("balanceText")
    return coerce_types(profile(spark, sf_dir), rules).select(
        customer_no(), balance.alias("balance_text"), balance.try_cast("double").alias("balance")
    )


@query(
    "q_null_fill",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, coalesce(batteryLevel, -1) AS battery,
        coalesce(firmwareVersion, 'UNKNOWN') AS firmware FROM telemetry""",
)
def q_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = handle_nulls(numbered(spark, sf_dir), "FILL_DEFAULT", {"batteryLevel": "-1", "firmwareVersion": "UNKNOWN", "absent": "x"})
    return filled.select("seq", F.col("batteryLevel").alias("battery"), F.col("firmwareVersion").alias("firmware"))


@query(
    "q_null_drop",
    f"""WITH {TELEMETRY_SQL} SELECT event_id AS seq, coalesce(batteryLevel, -1) AS battery, firmwareVersion IS NOT NULL AS live,
        CASE WHEN firmwareVersion IS NULL THEN 'NULL_FIELD_DROP' END AS reason,
        CASE WHEN firmwareVersion IS NULL THEN 'Field ''firmwareVersion'' is null and strategy is DROP_RECORD' END AS message
    FROM telemetry""",
)
def q_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = handle_nulls(numbered(spark, sf_dir), "DROP_RECORD", {"batteryLevel": "-1"})
    return verdict_rows(kept, "seq", F.col("batteryLevel").alias("battery"))


@query(
    "q_validate_regex",
    f"""WITH {PROFILE_SQL}, f AS (
      SELECT *, coalesce(regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+'), FALSE) AS ok FROM profile)
    SELECT c_custkey AS customer_no, ok AS live, CASE WHEN NOT ok THEN 'REGEX_FAIL' END AS reason,
           CASE WHEN NOT ok THEN concat('Field ''email'' failed REGEX (value=', coalesce(email, 'null'), ')') END AS message
    FROM f""",
)
def q_validate_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_rows(validate_fields(profile(spark, sf_dir), [FieldValidation("email", "REGEX", pattern=EMAIL)]), customer_no())


@query(
    "q_validate_range",
    f"""WITH {TELEMETRY_SQL}, f AS (
      SELECT *, coalesce(batteryLevel BETWEEN 10 AND 90, FALSE) AS b, value <= 250.5 AS v FROM telemetry)
    SELECT event_id AS seq, b AND v AS live, CASE WHEN NOT b OR NOT v THEN 'RANGE_FAIL' END AS reason,
           CASE WHEN NOT b THEN concat('Field ''batteryLevel'' failed RANGE (value=', coalesce(CAST(batteryLevel AS VARCHAR), 'null'), ')')
                WHEN NOT v THEN concat('Field ''value'' failed RANGE (value=', CAST(value AS VARCHAR), ')') END AS message
    FROM f""",
)
def q_validate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [FieldValidation("batteryLevel", "RANGE", min=10, max=90), FieldValidation("value", "RANGE", max=250.5)]
    return verdict_rows(validate_fields(numbered(spark, sf_dir), rules), "seq")


@query(
    "q_validate_not_empty",
    f"""WITH {TELEMETRY_SQL}, f AS (
      SELECT *, firmwareVersion IS NOT NULL AND trim(firmwareVersion) <> '' AS ok FROM telemetry)
    SELECT event_id AS seq, ok AS live, CASE WHEN NOT ok THEN 'NOT_EMPTY_FAIL' END AS reason,
           CASE WHEN NOT ok THEN concat('Field ''firmwareVersion'' failed NOT_EMPTY (value=', coalesce(firmwareVersion, 'null'), ')') END AS message
    FROM f""",
)
def q_validate_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_rows(validate_fields(numbered(spark, sf_dir), [FieldValidation("firmwareVersion", "NOT_EMPTY")]), "seq")


@query(
    "q_validate_enum",
    f"""WITH {ORDERS_SQL} SELECT o_orderkey AS order_no,
        CASE WHEN channel IN ('ONLINE', 'RETAIL', 'DISTRIBUTOR', 'UNKNOWN') THEN channel ELSE 'UNKNOWN' END AS channel FROM orders_evt""",
)
def q_validate_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = FieldValidation(
        "channel", "ENUM_VALUE", allowed_values=["ONLINE", "RETAIL", "DISTRIBUTOR", "UNKNOWN"], on_fail="FILL_DEFAULT", default_value="UNKNOWN"
    )
    checked = validate_fields(orders_evt(spark, sf_dir), [rule]).where(F.col(LIVE))
    return checked.select(F.col("orderId").cast("bigint").alias("order_no"), "channel")


@query(
    "q_validate_actions",
    f"""WITH {TELEMETRY_SQL}, a AS (
      SELECT *, CASE WHEN batteryLevel BETWEEN 5 AND 95 THEN batteryLevel ELSE -1 END AS battery FROM telemetry),
    b AS (
      SELECT *, battery >= 0 AS kept,
             battery >= 0 AND eventType NOT IN ('CLICK', 'VIEW', 'SIGNUP', 'PURCHASE') AS dead FROM a)
    SELECT event_id AS seq, battery, kept AND NOT dead AS live, CASE WHEN dead THEN 'ENUM_VALUE_FAIL' END AS reason,
           CASE WHEN dead THEN concat('Field ''eventType'' failed ENUM_VALUE (value=', eventType, ')') END AS message
    FROM b""",
)
def q_validate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        FieldValidation("batteryLevel", "RANGE", min=5, max=95, on_fail="FILL_DEFAULT", default_value="-1"),
        FieldValidation("batteryLevel", "RANGE", min=0, on_fail="DROP_RECORD"),
        FieldValidation("firmwareVersion", "NOT_EMPTY", on_fail="FORWARD"),
        FieldValidation("eventType", "ENUM_VALUE", allowed_values=["CLICK", "VIEW", "SIGNUP", "PURCHASE"]),
    ]
    return verdict_rows(validate_fields(numbered(spark, sf_dir), rules), "seq", F.col("batteryLevel").alias("battery"))


def chain_cte(source: str, keys: str, ttl_ms: int, name: str = "chain") -> str:
    """The time-limited acceptance as a recursive CTE over numbered rows."""
    return f"""{name}_o AS (
      SELECT *, concat_ws(':', {keys}) AS k, row_number() OVER (PARTITION BY {keys} ORDER BY eventTime, event_id) AS rn FROM {source}),
    {name} AS (
      SELECT event_id, k, rn, eventTime AS last, TRUE AS accepted FROM {name}_o WHERE rn = 1
      UNION ALL
      SELECT o.event_id, o.k, o.rn, CASE WHEN o.eventTime - c.last >= {ttl_ms} THEN o.eventTime ELSE c.last END,
             o.eventTime - c.last >= {ttl_ms}
      FROM {name} c JOIN {name}_o o ON o.k = c.k AND o.rn = c.rn + 1)"""


@query(
    "q_dedup_ttl",
    f"""WITH RECURSIVE {TELEMETRY_SQL}, {chain_cte('telemetry', 'customerId', 86_400_000)}
    SELECT event_id AS seq, accepted AS live, CASE WHEN NOT accepted THEN 'DUPLICATE_EVENT' END AS reason,
           CASE WHEN NOT accepted THEN concat('Duplicate customerId=''', k, '''') END AS message FROM chain""",
)
def q_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_rows(dedup(numbered(spark, sf_dir), ["customerId"], 24, position="seq"), "seq")


def anomaly_rows(spark: SparkSession, sf_dir: str, *rules: AnomalyRule) -> DataFrame:
    checked = detect_anomalies(numbered(spark, sf_dir), list(rules), "telemetry", position="seq")
    return checked.select("seq", F.col(ANOMALY).alias("anomaly"), F.col(LIVE).alias("live"))


def deviation_sql(k: float, frame: str = "UNBOUNDED PRECEDING") -> str:
    return f"""WITH {TELEMETRY_SQL}, s AS (
      SELECT event_id, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM telemetry
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN {frame} AND 1 PRECEDING))
    SELECT event_id AS seq, coalesce(n >= 5 AND sd > 0 AND abs(value - m) > {k} * sd, FALSE) AS anomaly, TRUE AS live FROM s"""


@query("q_anomaly_stddev", deviation_sql(3.0))
def q_anomaly_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rows(spark, sf_dir, AnomalyRule("value", "STDDEV", threshold=3.0))


@query(
    "q_anomaly_threshold",
    f"""WITH {TELEMETRY_SQL}, s AS (
      SELECT event_id, batteryLevel, count(batteryLevel) OVER (PARTITION BY customerId ORDER BY eventTime, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM telemetry)
    SELECT event_id AS seq, coalesce(n >= 5 AND batteryLevel < 10, FALSE) AS anomaly, TRUE AS live FROM s""",
)
def q_anomaly_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rows(spark, sf_dir, AnomalyRule("batteryLevel", "THRESHOLD", threshold=10))


@query("q_anomaly_iqr", deviation_sql(2.0))
def q_anomaly_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rows(spark, sf_dir, AnomalyRule("value", "IQR", threshold=2.0))


@query(
    "q_anomaly_iqr_exact",
    f"""WITH {TELEMETRY_SQL}, s AS (
      SELECT event_id, value, count(value) OVER w AS n, quantile_cont(value, 0.25) OVER w AS lo, quantile_cont(value, 0.75) OVER w AS hi
      FROM telemetry WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
    SELECT event_id AS seq, coalesce(n >= 5 AND (value < lo - 1.5 * (hi - lo) OR value > hi + 1.5 * (hi - lo)), FALSE) AS anomaly,
           TRUE AS live FROM s""",
)
def q_anomaly_iqr_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rows(spark, sf_dir, AnomalyRule("value", "IQR_EXACT", window_minutes=1, threshold=1.5))


@query("q_anomaly_rolling", deviation_sql(2.5, "20 PRECEDING"))
def q_anomaly_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rows(spark, sf_dir, AnomalyRule("value", "STDDEV", threshold=2.5, window_rows=20))


@query(
    "q_anomaly_actions",
    f"""WITH {TELEMETRY_SQL}, a AS (
      SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM telemetry
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    b AS (
      SELECT *, coalesce(n >= 5 AND sd > 0 AND abs(value - m) > 2.5 * sd, FALSE) AS out1 FROM a),
    c AS (
      SELECT *, CASE WHEN NOT out1 THEN value END AS v2, CASE WHEN NOT out1 THEN batteryLevel END AS b2 FROM b),
    d AS (
      SELECT *, count(v2) OVER w AS n2, avg(v2) OVER w AS m2, stddev_samp(v2) OVER w AS sd2, count(b2) OVER w AS n3 FROM c
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    e AS (
      SELECT *, coalesce(n2 >= 5 AND sd2 > 0 AND abs(v2 - m2) > 2.0 * sd2, FALSE) AS out2,
             coalesce(n3 >= 5 AND b2 < 5, FALSE) AS out3 FROM d)
    SELECT event_id AS seq, out2 AS anomaly, NOT out1 AND NOT out3 AS live,
           CAST(CASE WHEN out1 THEN 1 ELSE 0 END + CASE WHEN out2 THEN 1 ELSE 0 END AS BIGINT) AS dead_letters
    FROM e""",
)
def q_anomaly_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        AnomalyRule("value", "STDDEV", threshold=2.5, on_anomaly="DLQ"),
        AnomalyRule("value", "STDDEV", threshold=2.0),
        AnomalyRule("batteryLevel", "THRESHOLD", threshold=5, on_anomaly="DROP_RECORD"),
    ]
    checked = detect_anomalies(numbered(spark, sf_dir), rules, "telemetry", position="seq")
    letters = F.coalesce(F.when(F.col(FAILURES).isNotNull(), F.size(FAILURES)), F.lit(0)).cast("bigint")
    return checked.select("seq", F.col(ANOMALY).alias("anomaly"), F.col(LIVE).alias("live"), letters.alias("dead_letters"))


CHAIN = StreamDefinition(
    key="telemetry",
    stream_type="DEVICE",
    quality=QualityConfig(
        dedup_key=["customerId", "eventType"],
        dedup_ttl_hours=6,
        required_fields=["eventId", "customerId", "eventTime", "firmwareVersion"],
        null_strategy="FILL_DEFAULT",
        field_defaults={"batteryLevel": "100"},
        type_coercions=[TypeCoercion("firmwareVersion", "LOWERCASE_STRING", "UPPERCASE_ENUM")],
        field_validations=[
            FieldValidation("batteryLevel", "RANGE", min=3, on_fail="DLQ"),
            FieldValidation("firmwareVersion", "REGEX", pattern="FW-[0-3]", on_fail="FILL_DEFAULT", default_value="FW-OLD"),
        ],
        anomaly_detection=[AnomalyRule("value", "STDDEV", threshold=2.0)],
    ),
)

CHAIN_SQL = f"""{TELEMETRY_SQL}, st AS (
      SELECT *, firmwareVersion IS NULL OR trim(firmwareVersion) = '' AS missing, coalesce(batteryLevel, 100) AS battery,
             CASE WHEN regexp_full_match(trim(upper(firmwareVersion)), 'FW-[0-3]') THEN trim(upper(firmwareVersion)) ELSE 'FW-OLD' END AS firmware
      FROM telemetry),
    alive AS (SELECT * FROM st WHERE NOT missing AND battery >= 3),
    {chain_cte('alive', 'customerId, eventType', 21_600_000)},
    accepted AS (SELECT a.* FROM alive a JOIN chain c ON a.event_id = c.event_id WHERE c.accepted),
    stats AS (
      SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM accepted
      WINDOW w AS (PARTITION BY customerId ORDER BY eventTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    clean AS (
      SELECT *, coalesce(n >= 5 AND sd > 0 AND abs(value - m) > 2.0 * sd, FALSE) AS anomaly FROM stats),
    dlq AS (
      SELECT event_id, 'RequiredFieldValidator' AS op, 'MISSING_REQUIRED_FIELD' AS reason,
             'Field ''firmwareVersion'' is null or blank' AS message FROM st WHERE missing
      UNION ALL SELECT event_id, 'FieldValidationOperator', 'RANGE_FAIL',
             concat('Field ''batteryLevel'' failed RANGE (value=', CAST(battery AS VARCHAR), ')') FROM st WHERE NOT missing AND battery < 3
      UNION ALL SELECT c.event_id, 'DeduplicationOperator', 'DUPLICATE_EVENT',
             concat('Duplicate customerId,eventType=''', replace(c.k, ':', chr(1)), '''') FROM chain c WHERE NOT c.accepted
      UNION ALL SELECT event_id, 'AnomalyDetector', 'ANOMALY',
             concat('Field ''value''=', CAST(value AS VARCHAR), ' detected as anomaly by STDDEV (threshold=2.0)') FROM clean WHERE anomaly)"""


def chain(spark: SparkSession, sf_dir: str):
    return attach_quality(numbered(spark, sf_dir), CHAIN, position="seq")


@query(
    "q_chain_clean",
    f"WITH RECURSIVE {CHAIN_SQL} SELECT event_id AS seq, battery, firmware, round(value, 6) AS value, anomaly FROM clean",
)
def q_chain_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain(spark, sf_dir).clean.select(
        "seq", F.col("batteryLevel").alias("battery"), F.col("firmwareVersion").alias("firmware"),
        F.round("value", 6).alias("value"), F.col(ANOMALY).alias("anomaly"),
    )


@query(
    "q_chain_dlq",
    f"""WITH RECURSIVE {CHAIN_SQL} SELECT d.event_id AS seq, d.op AS operator_name, d.reason AS failure_reason, d.message,
        t.customerId AS original_customer_id, t.eventTime AS original_event_time_ms, t.firmwareVersion AS original_firmware,
        t.batteryLevel AS original_battery FROM dlq d JOIN telemetry t ON d.event_id = t.event_id""",
)
def q_chain_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = F.from_json("original_json", "seq bigint, firmwareVersion string, batteryLevel int")
    return chain(spark, sf_dir).dlq.withColumn("_o", original).select(
        F.col("_o.seq").alias("seq"), "operator_name", "failure_reason", "message", "original_customer_id",
        "original_event_time_ms", F.col("_o.firmwareVersion").alias("original_firmware"), F.col("_o.batteryLevel").alias("original_battery"),
    )


@query(
    "q_chain_summary",
    f"""WITH RECURSIVE {CHAIN_SQL}
    SELECT 'CLEAN' AS outcome, count(*) AS events, round(sum(value), 4) AS total_value FROM clean
    UNION ALL
    SELECT reason, count(*), round(sum(t.value), 4) FROM dlq d JOIN telemetry t ON d.event_id = t.event_id GROUP BY reason""",
)
def q_chain_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes in one pass: each row counts under all outcomes it has."""
    verdicts = quality_verdicts(numbered(spark, sf_dir), CHAIN, position="seq")
    reasons = F.transform(F.coalesce(F.col(FAILURES), F.array().cast("array<struct<operator:string,reason:string,message:string>>")), lambda f: f["reason"])
    outcomes = F.concat(F.when(F.col(LIVE), F.array(F.lit("CLEAN"))).otherwise(F.array().cast("array<string>")), reasons)
    return (
        verdicts.select(F.explode(outcomes).alias("outcome"), "value")
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total_value"))
    )


# Test keys only; a deployment passes its own.
DATA_KEY = bytes(range(32))
WRAPPED_KEY = b"wrapped-data-key-001"
SECRET = b"pseudonym-secret"


@query(
    "pii_roundtrip",
    f"""WITH {PROFILE_SQL} SELECT c_custkey AS customer_no, firstName AS first_name, email,
        CAST({4 + len(WRAPPED_KEY) + 12 + 16} + strlen(firstName) AS BIGINT) AS sealed_bytes, firstName IS NOT NULL AS hidden FROM profile""",
)
def pii_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = profile(spark, sf_dir)
    sealed = encrypt_fields(plain.withColumn("_plain", F.col("firstName")), ["firstName", "email", "absent"], DATA_KEY, WRAPPED_KEY)
    return sealed.select(
        customer_no(),
        decrypt_field(F.col("firstName"), DATA_KEY).alias("first_name"),
        decrypt_field(F.col("email"), DATA_KEY).alias("email"),
        F.length(F.unbase64("firstName")).cast("bigint").alias("sealed_bytes"),
        (F.col("firstName") != F.col("_plain")).alias("hidden"),
    )


def _pad_hex(byte: int) -> str:
    return bytes(b ^ byte for b in SECRET.ljust(64, b"\0")).hex()


@query(
    "pii_pseudonym",
    f"""WITH {PROFILE_SQL} SELECT c_custkey AS customer_no,
        sha256(unhex('{_pad_hex(0x5C)}') || unhex(sha256(unhex('{_pad_hex(0x36)}') || encode(customerId)))) AS pseudonym FROM profile""",
)
def pii_pseudonym(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir).select(customer_no(), pseudonymize(F.col("customerId"), SECRET).alias("pseudonym"))
