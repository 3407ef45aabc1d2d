"""Connected components of a table of links, by alternating star contractions.

In a large-star step every node ties its larger neighbours to its smallest one; in a
small-star step it ties itself and its smaller neighbours to the smallest of them. Both
keep components and shrink them to stars around their smallest node, in a number of rounds
that grows with the logarithm of their size. Links stay in tables throughout; lineage is
cut after each round by a table in the shared folder; the round before is removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, remove_path, scratch_path


def _star(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links of each neighbour to the smallest node of its group."""
    return links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; the root is its component's smallest node."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    spark, path, mark = links.sparkSession, None, None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = _star(both.where("v > u"), smallest).union(smallest.where("u != m").select("u", F.col("m").alias("v")))
        larger = larger.distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        now = _star(larger, least).union(least.select("u", F.col("m").alias("v"))).distinct()
        last, path = path, scratch_path(spark, "components")
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if last:
            remove_path(spark, last)
        before, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
    roots = cut_lineage(roots)
    remove_path(spark, path)
    return roots
