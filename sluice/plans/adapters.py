"""The test tables seen as streams: each view in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.verdict import STREAM_KEY

WEEK_MS = 604_800_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times in the tables carry no zone and mean UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ms(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def telemetry_of(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    firmware = F.concat(F.lit("fw-"), (F.col("user_id") % 5).cast("string"))
    return events.select(
        e.cast("string").alias("eventId"),
        F.col("user_id").cast("string").alias("customerId"),
        _ms("ts").alias("eventTime"),
        F.upper("event_type").alias("eventType"),
        "value",
        F.when(e % 13 != 0, F.get_json_object("props", "$.k").cast("int")).alias("batteryLevel"),
        F.when(e % 17 == 0, F.lit(None)).when(e % 19 == 0, "  ").otherwise(firmware).alias("firmwareVersion"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(table(spark, sf_dir, "events"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    c, letters = F.col("c_custkey"), F.substring("n_name", 1, 2)
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        c.cast("string").alias("customerId"),
        F.col("c_name").alias("firstName"),
        F.when(c % 11 == 0, "not-an-email").when(c % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("c"), c.cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(c % 5 == 0, F.lower(letters)).otherwise(F.upper(letters)).alias("countryCode"),
        F.when(c % 3 == 0, "2024-01-01T00:00:00Z").when(c % 3 == 1, "2024-01-01T00:00:00").otherwise("1704067200000").alias("eventTimeText"),
        F.concat(F.lit("  $"), F.col("c_acctbal").cast("string"), F.lit(" ")).alias("balanceText"),
        F.col("c_mktsegment").alias("skinType"),
    )


# Event type to scan stream and to the field that stream reports.
SCAN_OF_EVENT = (
    ("click", "scan-hydration", "overallHydrationScore"),
    ("view", "scan-texture", "overallTextureScore"),
    ("error", "scan-wrinkles", "overallWrinkleScore"),
    ("signup", "scan-radiance", "radianceScore"),
    ("purchase", "scan-overall", "overallSkinScore"),
)


def scan_events_of(events: DataFrame) -> DataFrame:
    """Scan events: a scan is one user's week."""
    stream = F.lit(None).cast("string")
    for kind, key, _ in SCAN_OF_EVENT:
        stream = F.when(F.col("event_type") == kind, key).otherwise(stream)
    score, user = F.least("value", F.lit(100.0)), F.col("user_id").cast("string")
    week = F.expr(f"unix_millis(cast(ts as timestamp)) div {WEEK_MS}").cast("string")
    return events.select(
        stream.alias(STREAM_KEY),
        user.alias("customerId"),
        F.concat(user, F.lit("-"), week).alias("scanId"),
        _ms("ts").alias("eventTime"),
        F.col("event_id").alias("seq"),
        *[F.when(F.col("event_type") == kind, score).alias(field) for kind, _, field in SCAN_OF_EVENT],
    )


def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_events_of(table(spark, sf_dir, "events"))


def orders_evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.col("o_custkey").cast("string").alias("customerId"),
        _ms("o_orderdate").alias("eventTime"),
        F.when(rank == "1", "ONLINE").when(rank == "2", "RETAIL").when(rank == "3", "DISTRIBUTOR").otherwise("KIOSK").alias("channel"),
        F.col("o_totalprice").alias("totalAmount"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return orders.join(items, orders.o_orderkey == items.l_orderkey).select(
        F.col("o_custkey").cast("string").alias("customerId"),
        F.col("l_partkey").cast("string").alias("productId"),
        _ms("o_orderdate").alias("eventTime"),
        F.col("l_quantity").alias("quantity"),
    )


CONCERNS_OF_TYPE = (
    ("ECONOMY", ("HYDRATION", "FINE_LINES")),
    ("MEDIUM", ("TEXTURE",)),
    ("PROMO", ("WRINKLES", "RADIANCE")),
    ("SMALL", ("RADIANCE", "RADIANCE")),
    ("LARGE", ("DARK_SPOTS", "TEXTURE")),
)
SEGMENTS = ("MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    concerns = F.array(F.lit("OTHER"))
    for kind, names in CONCERNS_OF_TYPE:
        concerns = F.when(F.col("p_type") == kind, F.array(*[F.lit(n) for n in names])).otherwise(concerns)
    segment = F.lit("FURNITURE")
    for rest, name in enumerate(SEGMENTS):
        segment = F.when(F.col("p_size") % 5 == rest, name).otherwise(segment)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("productId"),
        (F.col("p_partkey") * 1000).cast("bigint").alias("eventTime"),
        F.when(F.col("p_size") == 50, "DISCONTINUED").otherwise("UPSERT").alias("eventType"),
        (F.col("p_size") % 7 != 0).alias("isActive"),
        concerns.alias("targetSkinConcerns"),
        F.array(segment).alias("targetSkinTypes"),
        F.col("p_retailprice").alias("priceUSD"),
    )


# The same views for DuckDB, as common table expressions.
TELEMETRY_SQL = """telemetry AS (
  SELECT CAST(event_id AS VARCHAR) AS eventId, CAST(user_id AS VARCHAR) AS customerId,
         (epoch_us(ts) // 1000) AS eventTime, upper(event_type) AS eventType, value,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS batteryLevel,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '  '
              ELSE concat('fw-', CAST(user_id % 5 AS VARCHAR)) END AS firmwareVersion,
         event_id, user_id
  FROM events)"""
PROFILE_SQL = """profile AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerId, c_name AS firstName,
         CASE WHEN c_custkey % 11 = 0 THEN 'not-an-email' WHEN c_custkey % 7 = 0 THEN NULL
              ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
         CASE WHEN c_custkey % 5 = 0 THEN lower(substr(n_name, 1, 2)) ELSE upper(substr(n_name, 1, 2)) END AS countryCode,
         CASE WHEN c_custkey % 3 = 0 THEN '2024-01-01T00:00:00Z' WHEN c_custkey % 3 = 1 THEN '2024-01-01T00:00:00'
              ELSE '1704067200000' END AS eventTimeText,
         concat('  $', CAST(c_acctbal AS VARCHAR), ' ') AS balanceText, c_mktsegment AS skinType, c_custkey, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
SCAN_SQL = """scan_dim AS (
  SELECT CASE event_type WHEN 'click' THEN 'scan-hydration' WHEN 'view' THEN 'scan-texture' WHEN 'error' THEN 'scan-wrinkles'
              WHEN 'signup' THEN 'scan-radiance' ELSE 'scan-overall' END AS streamKey,
         CAST(user_id AS VARCHAR) AS customerId,
         concat(CAST(user_id AS VARCHAR), '-', CAST((epoch_us(ts) // 1000) // 604800000 AS VARCHAR)) AS scanId,
         (epoch_us(ts) // 1000) AS eventTime, event_id AS seq, least(value, 100.0) AS score
  FROM events)"""
ORDERS_SQL = """orders_evt AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS orderId, CAST(o_custkey AS VARCHAR) AS customerId,
         (epoch_us(o_orderdate) // 1000) AS eventTime,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ONLINE' WHEN '2' THEN 'RETAIL' WHEN '3' THEN 'DISTRIBUTOR'
              ELSE 'KIOSK' END AS channel,
         o_totalprice AS totalAmount, o_orderkey
  FROM orders)"""
ITEMS_SQL = """order_items AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customerId, CAST(l_partkey AS VARCHAR) AS productId,
         (epoch_us(o_orderdate) // 1000) AS eventTime, l_quantity AS quantity
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
CATALOG_SQL = """catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS productId, CAST(p_partkey * 1000 AS BIGINT) AS eventTime,
         CASE WHEN p_size = 50 THEN 'DISCONTINUED' ELSE 'UPSERT' END AS eventType, p_size % 7 <> 0 AS isActive,
         CASE p_type WHEN 'ECONOMY' THEN ['HYDRATION', 'FINE_LINES'] WHEN 'MEDIUM' THEN ['TEXTURE']
              WHEN 'PROMO' THEN ['WRINKLES', 'RADIANCE'] WHEN 'SMALL' THEN ['RADIANCE', 'RADIANCE']
              WHEN 'LARGE' THEN ['DARK_SPOTS', 'TEXTURE'] ELSE ['OTHER'] END AS targetSkinConcerns,
         [CASE p_size % 5 WHEN 0 THEN 'MACHINERY' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'AUTOMOBILE'
               WHEN 3 THEN 'HOUSEHOLD' ELSE 'FURNITURE' END] AS targetSkinTypes,
         p_retailprice AS priceUSD, p_partkey
  FROM part)"""
