"""The product catalogue as a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Change types that take a product out of the catalogue.
REMOVALS = ("DELETED", "DISCONTINUED")


def catalog_latest(changes: DataFrame, key: str = "productId", time: str = "eventTime", tie: str | None = None) -> DataFrame:
    """Newest row per product, without products whose newest change removes
    them. ``max_by`` combines before the shuffle, however many changes a product
    has; ``tie`` breaks equal times."""
    order = F.struct(*[time, *([tie] if tie else [])])
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*[c for c in changes.columns if c != key]), order).alias("_row"))
    return latest.select(key, "_row.*").where(~F.col("eventType").isin(*REMOVALS)).select(*changes.columns)
