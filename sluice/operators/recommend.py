"""Product recommendations from scan snapshots.

Every active product has a score for every snapshot; ``topn`` finds the leading
ones by way of target profiles. The result equals scoring the whole catalogue,
with no product-by-snapshot pairs and no shuffle for the top N.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .ordered import HOT_ROWS, previous_value, split_hot_keys
from .topn import LISTED, PART_PROFILES, PRODUCTS, Factors, Profiles, improve, owned_lists, placed

# Which snapshot score sets the weight of which concern.
CONCERNS = (
    ("hydration", "hydration"),
    ("pigmentation", "pigmentation"),
    ("dark_spots", "pigmentation"),
    ("texture", "texture"),
    ("pores", "poreScore"),
    ("wrinkles", "wrinkle"),
    ("fine_lines", "wrinkle"),
    ("radiance", "radiance"),
    ("clarity", "clarity"),
)
MAX_SCORE = 100.0
# Effect of skin type match and mismatch, and of owning a product.
TYPE_BONUS, TYPE_PENALTY, OWNED_FACTOR = 0.2, -0.1, 0.3
TOP_N = 5
MIN_SCORE_CHANGE = 3.0
SCAN_TTL_DAYS = 90
PURCHASE_LOOKBACK_DAYS = 365
DAY_MS = 86_400_000
# Products of a basket that meet in one group; pairs that a task counts; baskets of a product
# from which its pairs with others like it combine before the shuffle.
BLOCK_ITEMS, TASK_PAIRS, HOT_BASKETS = 1000, 4_000_000, 1_000_000


def concern_weights(scores: Column, higher_is_worse: tuple[str, ...] = ()) -> Column:
    """Concern to weight: the lower the score, the heavier. Concerns without a
    score are left out. Scores named in ``higher_is_worse`` are not inverted."""

    def weight(score: str) -> Column:
        value = F.element_at(scores, score) if not isinstance(scores, dict) else scores[score]
        return (value if score in higher_is_worse else F.lit(MAX_SCORE) - value) / MAX_SCORE

    entries = F.array(*[F.struct(F.lit(c).alias("key"), weight(s).alias("value")) for c, s in CONCERNS])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _score(matched: Column, types: Column, skin_type: Column, owned: bool | Column) -> Column:
    no_effect = skin_type.isNull() | (F.coalesce(F.size(types), F.lit(0)) <= 0)
    effect = F.when(no_effect, F.lit(0.0)).when(F.array_contains(types, skin_type), TYPE_BONUS).otherwise(TYPE_PENALTY)
    factor = F.when(F.lit(owned) if isinstance(owned, bool) else owned, F.lit(OWNED_FACTOR)).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0.0), (matched + effect) * factor)


def product_score(weights: Column, concerns: Column, types: Column, skin_type: Column, owned: bool | Column) -> Column:
    """The score of one product: matched weights (a concern listed twice counts
    twice), skin type effect, owned factor, never below zero. An empty type list
    has no effect."""
    matched = F.aggregate(
        concerns, F.lit(0.0), lambda total, c: total + F.coalesce(F.element_at(weights, F.lower(c)), F.lit(0.0))
    )
    return _score(matched, types, skin_type, owned)


def _places(concerns: Column) -> Column:
    """The known ones of a product's concerns, as positions in ``CONCERNS``."""
    names = F.array(*[F.lit(name) for name, _ in CONCERNS])
    return F.filter(F.transform(concerns, lambda c: F.array_position(names, F.lower(c))), lambda i: i > 0)


def purchases(orders: DataFrame, as_of_ms: int, lookback_days: int = PURCHASE_LOOKBACK_DAYS, time: str = "eventTime") -> DataFrame:
    """(customerId, productId) bought within the lookback. Accepts order events
    with ``lineItems`` or rows that already name a product."""
    recent = orders.where((F.col(time) > as_of_ms - lookback_days * DAY_MS) & (F.col(time) <= as_of_ms))
    if "lineItems" in orders.columns:
        recent = recent.select("customerId", F.explode("lineItems").alias("_item")).select("customerId", "_item.productId")
    return recent.select("customerId", "productId").distinct()


def next_purchases(
    orders: DataFrame, time: str = "eventTime", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """How many customers bought ``nextProductId`` right after ``productId``,
    going by each product's first purchase. It grows with the purchases, where
    ``copurchases`` grows with the squares of baskets."""
    first = orders.groupBy("customerId", "productId").agg(F.min(time).alias("_first"))
    keyed = first.where(F.col("customerId").isNotNull() & F.col("productId").isNotNull())
    sizing = orders.select("customerId", F.col(time).alias("_first"), "productId").where(F.col("customerId").isNotNull())
    split = split_hot_keys(keyed, "customerId", ["_first", "productId"], hot_rows, sizing)
    split = previous_value(split, "productId", "_before")
    pairs = split.rows.where(F.col("_before").isNotNull())
    return pairs.groupBy(F.col("_before").alias("productId"), F.col("productId").alias("nextProductId")).agg(
        F.count(F.lit(1)).alias("customers")
    )


def copurchases(
    orders: DataFrame, min_baskets: int, basket: str = "customerId", block_items: int = BLOCK_ITEMS,
    task_pairs: int = TASK_PAIRS, hot_baskets: int = HOT_BASKETS,
) -> DataFrame:
    """(productId, otherId, baskets) for every two products that at least ``min_baskets`` baskets
    (customers, or orders) have in common, the smaller id first; exact counts.

    A pair is in no more baskets than either product, so products in fewer go first. A basket
    of more than ``block_items`` products is cut into blocks, and every two of its blocks meet
    in a group of their own, so its pairs come from as many groups as it has pairs of blocks.
    Products go by number, and pairs are dealt by pair to as many tasks as there are
    ``task_pairs`` of them, so what a task counts does not grow with the input. Pairs of two
    products that are both in more than ``hot_baskets`` baskets, which are few, combine before
    their shuffle instead."""
    rows = orders.select(F.col(basket).alias("_basket"), "productId").where("_basket IS NOT NULL AND productId IS NOT NULL").distinct()
    frequent = rows.groupBy("productId").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_baskets)
    numbered = cut_lineage(frequent.select("productId", F.monotonically_increasing_id().alias("_p"), (F.col("_n") > hot_baskets).alias("_hot")))
    rows = rows.join(numbered, "productId").select("_basket", "_p", "_hot")
    # A basket's size needs no window over it; the join splits large baskets.
    sizes = rows.groupBy("_basket").agg(F.ceil(F.count(F.lit(1)) / block_items).cast("int").alias("_blocks"), F.count(F.lit(1)).alias("_items"))
    dealt = rows.join(sizes.where("_items > 1"), "_basket").withColumn("_own", F.pmod(F.xxhash64("_p"), F.col("_blocks")).cast("int"))
    dealt = cut_lineage(dealt)
    total, hot = dealt.agg(F.sum(F.col("_items") - 1) / 2, F.max("_hot")).first()
    tasks = max(dealt.sparkSession.sparkContext.defaultParallelism, math.ceil((total or 0) / task_pairs))
    pairs = _basket_pairs(dealt, tasks)
    cold = pairs.where(~(F.col("_hot_a") & F.col("_hot_b"))) if hot else pairs
    counted = cold.select("_a", "_b").repartition(tasks, "_a", "_b").groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("baskets"))
    if hot:
        own = _basket_pairs(dealt.where("_hot"), tasks)
        counted = counted.unionByName(own.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("baskets")))
    found = counted.where(F.col("baskets") >= min_baskets)
    for end in ("_a", "_b"):
        found = found.join(numbered.select(F.col("_p").alias(end), F.col("productId").alias(f"{end}_id")), end)
    return found.select(F.least("_a_id", "_b_id").alias("productId"), F.greatest("_a_id", "_b_id").alias("otherId"), "baskets")


def _basket_pairs(dealt: DataFrame, tasks: int) -> DataFrame:
    """Every two products of a basket once, the smaller number first."""
    left = dealt.select("_basket", F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("_j"), F.col("_p").alias("_x"), F.col("_hot").alias("_hot_a"))
    right = dealt.select("_basket", F.explode(F.sequence(F.lit(0), "_own")).alias("_i"), F.col("_own").alias("_j"), F.col("_p").alias("_y"), F.col("_hot").alias("_hot_b"))
    keys = ["_basket", "_i", "_j"]
    pairs = left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys).where((F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y")))
    return pairs.select(F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b"), "_hot_a", "_hot_b")


def latest_skin_type(preferences: DataFrame, time: str = "eventTime") -> DataFrame:
    """The newest stated skin type per customer; of equal times the last by name."""
    return preferences.groupBy("customerId").agg(F.max_by("skinType", F.struct(F.col(time), F.col("skinType"))).alias("skinType"))


def recent_scans(snaps: DataFrame, as_of_ms: int, ttl_days: int = SCAN_TTL_DAYS, time: str = "eventTimeMs") -> DataFrame:
    """Snapshots young enough to recommend from."""
    return snaps.where(F.col(time) >= as_of_ms - ttl_days * DAY_MS)


def change_gate(
    snaps: DataFrame,
    score: str = "overall",
    threshold: float = MIN_SCORE_CHANGE,
    time: str = "eventTimeMs",
    tie: str = "scanId",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Snapshots that differ from the customer's previous one by at least the
    threshold, and first ones. Snapshots of equal time are ordered by ``tie`` and
    their first event."""
    order = [time, tie, *(["firstEventMs"] if "firstEventMs" in snaps.columns else [])]
    scored = snaps.withColumns(
        {"_gate_key": F.coalesce(F.col("customerId"), F.lit("")), "_score": F.element_at(F.col("scores"), score)}
    ).where(F.col("_score").isNotNull())
    split = previous_value(split_hot_keys(scored, "_gate_key", order, hot_rows), "_score", "previous")
    delta = F.col("_score") - F.col("previous")
    kept = split.rows.withColumn("change", delta).where(F.col("previous").isNull() | (F.abs(delta) >= threshold))
    return kept.select(*snaps.columns, "previous", "change")


def _active(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("isActive")).select(
        "productId",
        F.coalesce(F.col("targetSkinConcerns"), F.array().cast("array<string>")).alias("concerns"),
        F.coalesce(F.col("targetSkinTypes"), F.array().cast("array<string>")).alias("types"),
    )


def _profiled(catalog: DataFrame) -> DataFrame:
    """Active products with what decides their score; ``profile`` is its name."""
    named = _active(catalog).withColumn("places", _places(F.col("concerns")))
    return named.withColumn("profile", F.to_json(F.struct("places", "types")))


def ranked_rows(recommendations: DataFrame) -> DataFrame:
    """One row per recommended product instead of the ``products`` array."""
    # The arrays are never empty. ``explode_outer`` keeps the optimizer from
    # adding a test of that.
    flat = recommendations.withColumn("_p", F.explode_outer("products"))
    return flat.select(*[c for c in recommendations.columns if c != "products"], "_p.*")


def recommend(
    snaps: DataFrame,
    catalog: DataFrame,
    preferences: DataFrame | None = None,
    bought: DataFrame | None = None,
    top_n: int = TOP_N,
    score_fn: Callable[[DataFrame], DataFrame] | None = None,
    part_profiles: int = PART_PROFILES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each snapshot with its ``top_n`` products, best first and ties by product
    id, in ``products``: array of (productId, rank, score, targetConcerns).

    ``catalog`` is the latest catalogue, ``preferences`` (customerId, skinType),
    ``bought`` (customerId, productId). ``score_fn`` may replace the weights: it
    gets the snapshots and returns them with a ``weights`` map column. An empty
    catalogue gives no rows."""
    weighted = score_fn(snaps) if score_fn else snaps.withColumn("weights", concern_weights(F.col("scores")))
    columns = [F.col(f"`{c}`") for c in snaps.columns]
    by_place = F.array(*[F.coalesce(F.element_at(F.col("weights"), name), F.lit(0.0)) for name, _ in CONCERNS])
    rows = weighted.select(F.struct(*columns).alias("row"), F.col("customerId").alias("_customer"), by_place.alias("weights"))
    if preferences is not None:
        rows = rows.join(preferences.select(F.col("customerId").alias("_customer"), F.col("skinType").alias("skin")), "_customer", "left")
    else:
        rows = rows.withColumn("skin", F.lit(None).cast("string"))
    products = cut_lineage(placed(_profiled(catalog), hot_rows))
    if bought is not None:
        rows = rows.join(owned_lists(bought, products, top_n, hot_rows).withColumnRenamed("customerId", "_customer"), "_customer", "left")
    else:
        rows = rows.withColumn("own", F.lit(None).cast(f"array<struct<profile:string,changed:boolean,free:{LISTED},owned:{LISTED}>>"))
    rows = rows.select("row", "weights", "skin", "own", F.lit(None).cast(PRODUCTS).alias("products"))
    heads = products.where(F.col("place") <= top_n)
    parts = -(-heads.where("place = 1").count() // part_profiles)
    factors = Factors(TYPE_BONUS, TYPE_PENALTY, OWNED_FACTOR)
    for number in range(parts):
        own = heads.where(F.pmod(F.xxhash64("profile"), F.lit(parts)) == number).collect()
        rows = improve(rows, Profiles(own, len(CONCERNS), factors), top_n) if own else rows
    return rows.select("row.*", "products") if parts else rows.select("row.*", "products").where(F.lit(False))


def recommendation_id(customer: Column, scan: Column, time: Column) -> Column:
    """A stable id, so a replayed micro-batch writes the same rows again."""
    return F.sha2(F.concat_ws(":", customer, scan, time.cast("string")), 256)


def to_output(recommendations: DataFrame, time: str = "eventTimeMs", source: str = "SCAN_RESULTS", ttl_days: int | None = None) -> DataFrame:
    """Recommendations in the layout of the product-recommendations stream."""
    from ..schemas import stream_schema

    expires = F.col(time) + F.lit(ttl_days * DAY_MS) if ttl_days else F.lit(None).cast("bigint")
    products = F.transform(
        F.col("products"),
        lambda p: F.struct(
            p["productId"].alias("productId"),
            p["rank"].alias("rank"),
            p["score"].cast("float").alias("score"),
            F.array().cast("array<string>").alias("reasons"),
            F.get(p["targetConcerns"], 0).alias("targetConcern"),
        ),
    ).cast(stream_schema("product-recommendations")["products"].dataType)
    return recommendations.select(
        "customerId",
        "scanId",
        F.lit(1).alias("schemaVersion"),
        F.col(time).cast("bigint").alias("eventTime"),
        recommendation_id(F.col("customerId"), F.col("scanId"), F.col(time)).alias("recommendationId"),
        F.lit(source).alias("recommendationSource"),
        products.alias("products"),
        expires.alias("expiresAt"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )
