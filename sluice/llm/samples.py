"""Bounded samples of labelled rows, chosen by a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def turn(*key: Column) -> Column:
    """A number from 0 up to 1 that follows from the key, fine enough for any table."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 52)) / F.lit(float(1 << 52))


def per_class(rows: DataFrame, label: str, key: Column, each: int) -> tuple[DataFrame, dict]:
    """About ``each`` rows of every label (all where there are fewer), and the labels' counts."""
    counts = {r["label"]: r["n"] for r in rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows.limit(0), counts
    share = F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, min(1.0, each / n))))
    return rows.where(turn(key) < share[F.col(label)]), counts
