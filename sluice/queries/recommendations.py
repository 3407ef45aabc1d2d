"""Catalogue state, scoring, top N, and what surrounds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import recommend as rec
from ..plans.adapters import CATALOG_SQL, ITEMS_SQL, PROFILE_SQL, catalog, order_items, profile
from ..sources.catalog import catalog_latest
from . import query
from .scans import SNAPS_SQL, batch_snapshots

AS_OF_MS = 946_684_800_000  # 2000-01-01, within the order dates
SCAN_AS_OF_MS = 1_706_572_800_000  # 2024-01-30, the last day of the events

# Scoring in SQL, over all pairs: what the engine must equal.
_WEIGHT = """CASE lower(c) WHEN 'hydration' THEN (100.0::DOUBLE - hydration) / 100.0::DOUBLE WHEN 'texture' THEN (100.0::DOUBLE - texture) / 100.0::DOUBLE
      WHEN 'wrinkles' THEN (100.0::DOUBLE - wrinkle) / 100.0::DOUBLE WHEN 'fine_lines' THEN (100.0::DOUBLE - wrinkle) / 100.0::DOUBLE
      WHEN 'radiance' THEN (100.0::DOUBLE - radiance) / 100.0::DOUBLE END"""
_MATCHED = f"list_reduce(list_transform(targetSkinConcerns, lambda c: coalesce({_WEIGHT}, 0.0::DOUBLE)), lambda x, y: x + y)"
CATALOG_LATEST_SQL = f"{CATALOG_SQL}, products AS (SELECT * FROM catalog WHERE eventType NOT IN ('DELETED', 'DISCONTINUED') AND isActive)"
NUMBERED_SNAPS_SQL = f"{SNAPS_SQL}, s AS (SELECT *, row_number() OVER () AS sid FROM snaps)"


def ranked_sql(effect: str = "0.0::DOUBLE", factor: str = "1.0::DOUBLE", joins: str = "") -> str:
    return f"""{NUMBERED_SNAPS_SQL}, {CATALOG_LATEST_SQL}, scored AS (
      SELECT s.*, p.productId, greatest(0.0::DOUBLE, ({_MATCHED} + {effect}) * {factor}) AS points FROM s CROSS JOIN products p {joins}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY sid ORDER BY points DESC, productId) AS rank FROM scored QUALIFY rank <= 5)"""


TOP_SQL = """SELECT CAST(customerId AS BIGINT) AS customer_no, scanId AS scan_id, eventTimeMs AS event_time_ms, firstEventMs AS first_event_ms,
      CAST(rank AS BIGINT) AS rank, productId AS product_id, round(points, 6) AS score FROM ranked"""

EFFECT = "CASE WHEN pr.skinType IS NULL THEN 0.0::DOUBLE WHEN list_contains(p.targetSkinTypes, pr.skinType) THEN 0.2::DOUBLE ELSE -0.1::DOUBLE END"
BOUGHT_SQL = f"""{ITEMS_SQL}, bought AS (
      SELECT DISTINCT customerId, productId FROM order_items
      WHERE eventTime > {AS_OF_MS} - 365 * 86400000::BIGINT AND eventTime <= {AS_OF_MS})"""


def flat_top(found: DataFrame) -> DataFrame:
    return rec.ranked_rows(found).select(
        F.col("customerId").cast("bigint").alias("customer_no"),
        F.col("scanId").alias("scan_id"),
        F.col("eventTimeMs").alias("event_time_ms"),
        F.col("firstEventMs").alias("first_event_ms"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("productId").alias("product_id"),
        F.round("score", 6).alias("score"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_latest(catalog(spark, sf_dir))


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir).select("customerId", "skinType")


def bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.purchases(order_items(spark, sf_dir), AS_OF_MS)


@query(
    "catalog_latest_state",
    f"""WITH {CATALOG_SQL}, changes AS (
      SELECT productId, eventTime, eventType, isActive, priceUSD, 0 AS step, p_partkey FROM catalog
      UNION ALL
      SELECT productId, eventTime + 500, CASE WHEN priceUSD > 1000 THEN 'DELETED' ELSE 'ACTIVATED' END, TRUE, priceUSD * 2, 1, p_partkey
      FROM catalog WHERE isActive),
    latest AS (SELECT *, row_number() OVER (PARTITION BY productId ORDER BY eventTime DESC, step DESC) AS rn FROM changes)
    SELECT p_partkey AS product_no, eventType AS event_type, isActive AS is_active, round(priceUSD, 6) AS price FROM latest
    WHERE rn = 1 AND eventType NOT IN ('DELETED', 'DISCONTINUED')""",
)
def catalog_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = catalog(spark, sf_dir).withColumn("step", F.lit(0))
    later = first.where("isActive").withColumns(
        {
            "eventTime": F.col("eventTime") + 500,
            "eventType": F.when(F.col("priceUSD") > 1000, "DELETED").otherwise("ACTIVATED"),
            "isActive": F.lit(True),
            "priceUSD": F.col("priceUSD") * 2,
            "step": F.lit(1),
        }
    )
    return catalog_latest(first.unionByName(later), tie="step").select(
        F.col("productId").cast("bigint").alias("product_no"), F.col("eventType").alias("event_type"),
        F.col("isActive").alias("is_active"), F.round("priceUSD", 6).alias("price"),
    )


@query(
    "rec_concern_weights",
    f"""WITH {SNAPS_SQL}, w AS (
      SELECT scanId, firstEventMs, 'hydration' AS concern, hydration AS score FROM snaps
      UNION ALL SELECT scanId, firstEventMs, 'texture', texture FROM snaps
      UNION ALL SELECT scanId, firstEventMs, 'wrinkles', wrinkle FROM snaps
      UNION ALL SELECT scanId, firstEventMs, 'fine_lines', wrinkle FROM snaps
      UNION ALL SELECT scanId, firstEventMs, 'radiance', radiance FROM snaps)
    SELECT scanId AS scan_id, firstEventMs AS first_event_ms, concern, round((100 - score) / 100, 6) AS weight FROM w WHERE score IS NOT NULL""",
)
def rec_concern_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_snapshots(spark, sf_dir).select(
        F.col("scanId").alias("scan_id"), F.col("firstEventMs").alias("first_event_ms"),
        F.explode(rec.concern_weights(F.col("scores"))).alias("concern", "weight"),
    ).withColumn("weight", F.round("weight", 6))


@query("rec_top_n", f"WITH {ranked_sql()} {TOP_SQL}")
def rec_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_top(rec.recommend(batch_snapshots(spark, sf_dir), products(spark, sf_dir)))


@query(
    "rec_skin_type",
    f"WITH {PROFILE_SQL}, {ranked_sql(EFFECT, joins='LEFT JOIN profile pr ON pr.customerId = s.customerId')} {TOP_SQL}",
)
def rec_skin_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_top(rec.recommend(batch_snapshots(spark, sf_dir), products(spark, sf_dir), preferences(spark, sf_dir)))


_PENALTY_JOINS = """LEFT JOIN profile pr ON pr.customerId = s.customerId
      LEFT JOIN bought b ON b.customerId = s.customerId AND b.productId = p.productId"""


@query(
    "rec_purchase_penalty",
    f"""WITH {PROFILE_SQL}, {BOUGHT_SQL}, {ranked_sql(EFFECT, "CASE WHEN b.productId IS NOT NULL THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END", _PENALTY_JOINS)} {TOP_SQL}""",
)
def rec_purchase_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_top(
        rec.recommend(batch_snapshots(spark, sf_dir), products(spark, sf_dir), preferences(spark, sf_dir), bought(spark, sf_dir))
    )


@query(
    "rec_scored_products",
    f"""WITH {PROFILE_SQL}, {BOUGHT_SQL}, {NUMBERED_SNAPS_SQL}, {CATALOG_LATEST_SQL}
    SELECT CAST(s.customerId AS BIGINT) AS customer_no, s.scanId AS scan_id, s.firstEventMs AS first_event_ms, p.productId AS product_id,
           round(greatest(0.0::DOUBLE, ({_MATCHED} + {EFFECT}) * 0.3::DOUBLE), 6) AS score
    FROM s JOIN bought b ON b.customerId = s.customerId JOIN products p ON p.productId = b.productId
    LEFT JOIN profile pr ON pr.customerId = s.customerId""",
)
def rec_scored_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every product a customer owns, for every snapshot."""
    weighted = batch_snapshots(spark, sf_dir).withColumn("weights", rec.concern_weights(F.col("scores")))
    owned = bought(spark, sf_dir).join(products(spark, sf_dir).where("isActive"), "productId")
    pairs = weighted.join(preferences(spark, sf_dir), "customerId", "left").join(owned, "customerId")
    score = rec.product_score(F.col("weights"), F.col("targetSkinConcerns"), F.col("targetSkinTypes"), F.col("skinType"), True)
    return pairs.select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("scanId").alias("scan_id"),
        F.col("firstEventMs").alias("first_event_ms"), F.col("productId").alias("product_id"), F.round(score, 6).alias("score"),
    )


@query(
    "rec_change_gate",
    f"""WITH {SNAPS_SQL}, g AS (
      SELECT *, lag(overall) OVER (PARTITION BY customerId ORDER BY eventTimeMs, scanId, firstEventMs) AS previous FROM snaps WHERE overall IS NOT NULL)
    SELECT scanId AS scan_id, eventTimeMs AS event_time_ms, round(overall, 6) AS overall, round(previous, 6) AS previous,
           round(overall - previous, 6) AS change FROM g WHERE previous IS NULL OR abs(overall - previous) >= 3.0""",
)
def rec_change_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = rec.change_gate(batch_snapshots(spark, sf_dir))
    return gated.select(
        F.col("scanId").alias("scan_id"), F.col("eventTimeMs").alias("event_time_ms"),
        F.round(F.element_at("scores", "overall"), 6).alias("overall"), F.round("previous", 6).alias("previous"),
        F.round("change", 6).alias("change"),
    )


@query(
    "rec_scan_ttl",
    f"""WITH {SNAPS_SQL} SELECT scanId AS scan_id, eventTimeMs AS event_time_ms, events FROM snaps
    WHERE eventTimeMs >= {SCAN_AS_OF_MS} - 14 * 86400000::BIGINT""",
)
def rec_scan_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.recent_scans(batch_snapshots(spark, sf_dir), SCAN_AS_OF_MS, ttl_days=14).select(
        F.col("scanId").alias("scan_id"), F.col("eventTimeMs").alias("event_time_ms"), F.col("events").cast("bigint").alias("events")
    )


@query(
    "rec_output_schema",
    f"""WITH {ranked_sql()}
    SELECT CAST(customerId AS BIGINT) AS customer_no, scanId AS scan_id, eventTimeMs AS event_time,
           sha256(concat_ws(':', customerId, scanId, CAST(eventTimeMs AS VARCHAR))) AS recommendation_id, 'SCAN_RESULTS' AS source,
           string_agg(concat(CAST(rank AS VARCHAR), '=', productId), ',' ORDER BY rank) AS products, round(max(points), 4) AS best
    FROM ranked GROUP BY sid, customerId, scanId, eventTimeMs""",
)
def rec_output_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = rec.to_output(rec.recommend(batch_snapshots(spark, sf_dir), products(spark, sf_dir)))
    named = F.transform("products", lambda p: F.concat(p["rank"].cast("string"), F.lit("="), p["productId"]))
    best = F.get(F.col("products"), 0)["score"]
    return output.select(
        F.col("customerId").cast("bigint").alias("customer_no"), F.col("scanId").alias("scan_id"), F.col("eventTime").alias("event_time"),
        F.col("recommendationId").alias("recommendation_id"), F.col("recommendationSource").alias("source"),
        F.array_join(named, ",").alias("products"), F.round(best.cast("string").cast("double"), 4).alias("best"),
    )


@query(
    "rec_copurchase",
    f"""WITH {ITEMS_SQL}, f AS (SELECT customerId, productId, min(eventTime) AS t FROM order_items GROUP BY 1, 2),
    l AS (SELECT lag(productId) OVER (PARTITION BY customerId ORDER BY t, productId) AS before, productId FROM f)
    SELECT before AS product_id, productId AS next_product_id, count(*) AS customers FROM l WHERE before IS NOT NULL GROUP BY 1, 2""",
)
def rec_copurchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.next_purchases(order_items(spark, sf_dir)).select(
        F.col("productId").alias("product_id"), F.col("nextProductId").alias("next_product_id"), "customers"
    )


def _together_sql(basket: str, least: int) -> str:
    return f"""WITH {ITEMS_SQL}, i AS (SELECT DISTINCT {basket} AS basket, productId FROM order_items)
    SELECT a.productId AS product_id, b.productId AS other_id, count(*) AS baskets FROM i a JOIN i b ON a.basket = b.basket AND a.productId < b.productId
    GROUP BY 1, 2 HAVING count(*) >= {least}"""


def _together(spark: SparkSession, sf_dir: str, basket: str, least: int) -> DataFrame:
    return rec.copurchases(order_items(spark, sf_dir), least, basket).select(
        F.col("productId").alias("product_id"), F.col("otherId").alias("other_id"), "baskets"
    )


@query("rec_bought_together", _together_sql("customerId", 4))
def rec_bought_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _together(spark, sf_dir, "customerId", 4)
