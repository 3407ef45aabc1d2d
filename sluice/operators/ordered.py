"""Ordered per-key work without a task per key.

Running statistics, running counts and "previous row" need a key's rows in
order, and a plain window puts all of them into one task. Here a key with more
than ``hot_rows`` rows is cut into consecutive chunks of its order, the window
runs per (key, chunk), and what came before a chunk is added from a table with
one row per chunk. Chunk bounds come from a deterministic sample and only
balance the load: any bounds give the same result.

Size bounds: a key is cut into ``rows / hot_rows`` pieces, so all bounds and all
carried rows together are at most ``2 * total_rows / hot_rows`` small rows
(a million million rows at the default make a million). That is what is
broadcast; keys below the limit appear in none of these tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

HOT_ROWS = 2_000_000
CHUNK = "_chunk"
_BOUNDS = "_bounds"
_SAMPLES_PER_CHUNK = 16
_SEARCH_STEPS = [1 << bit for bit in range(20, -1, -1)]


@dataclass(frozen=True)
class Split:
    """A frame with a chunk column; ``hot`` tells whether any key was cut."""

    rows: DataFrame
    key: str
    order: tuple[str, ...]
    hot: bool

    @property
    def groups(self) -> list[str]:
        return [self.key, CHUNK] if self.hot else [self.key]

    def window(self, *extra_groups: str | Column) -> WindowSpec:
        return Window.partitionBy(*self.groups, *extra_groups).orderBy(*self.order)

    def with_rows(self, rows: DataFrame) -> "Split":
        return Split(rows, self.key, self.order, self.hot)


def key_sizes(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Keys with more than so many rows. Counts combine before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)


def chunk_bounds(df: DataFrame, key: str, order: list[str], sizes: DataFrame, hot_rows: int) -> DataFrame:
    """Per hot key, the sorted array of order values at which a chunk begins."""
    wanted = sizes.select(
        key,
        F.ceil(F.col("_n") / hot_rows).cast("int").alias("_pieces"),
        F.greatest(F.lit(1), F.floor(F.col("_n") / (F.ceil(F.col("_n") / hot_rows) * _SAMPLES_PER_CHUNK))).alias("_every"),
    )
    sample = (
        df.select(key, *order)
        .join(F.broadcast(wanted), key)
        .where(F.pmod(F.xxhash64(*order), F.col("_every")) == 0)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_s"), F.first("_pieces").alias("_pieces"))
        .where((F.col("_pieces") > 1) & (F.size("_s") > 1))
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_pieces") - 1),
        lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / F.col("_pieces")).cast("int")),
    )
    return sample.select(key, F.array_sort(F.array_distinct(F.filter(cuts, lambda c: c.isNotNull()))).alias(_BOUNDS))


def _chunk_of(order: list[str]) -> Column:
    """Binary search of the row's place among its key's bounds; null for keys
    that were not cut."""
    bounds, row = F.col(_BOUNDS), F.struct(*order)
    found = F.aggregate(
        F.array(*[F.lit(step) for step in _SEARCH_STEPS]),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= row, at + step).otherwise(at),
    )
    return F.when(bounds.isNotNull(), found)


def split_hot_keys(df: DataFrame, key: str, order: list[str], hot_rows: int = HOT_ROWS, sizing: DataFrame | None = None) -> Split:
    """``key`` must not be null and ``order`` must be a total order within it.
    ``sizing`` may be any frame with the same key and order columns whose keys
    are at least as large, e.g. the rows before an expensive step."""
    probe = sizing if sizing is not None else df
    sizes = key_sizes(probe, key, hot_rows)
    if not sizes.take(1):
        return Split(df, key, tuple(order), hot=False)
    bounds = chunk_bounds(probe, key, order, sizes, hot_rows)
    rows = df.join(F.broadcast(bounds), key, "left").withColumn(CHUNK, _chunk_of(order)).drop(_BOUNDS)
    return Split(rows, key, tuple(order), hot=True)


def hot_only(split: Split) -> DataFrame:
    """Rows of the keys that were cut: only they carry anything over."""
    return split.rows.where(F.col(CHUNK).isNotNull())


def before_chunk(parts: DataFrame, key: str) -> WindowSpec:
    """Over a one-row-per-chunk table: all chunks before this one."""
    return Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def running_count(split: Split, condition: Column, name: str, inclusive: bool) -> Split:
    """How many earlier rows of the key (with this one, if ``inclusive``) meet
    the condition."""
    end = Window.currentRow if inclusive else -1
    frame = split.window().rowsBetween(Window.unboundedPreceding, end)
    hit = F.when(condition, 1).otherwise(0).cast("bigint")
    counted = split.rows.withColumn(name, F.coalesce(F.sum(hit).over(frame), F.lit(0).cast("bigint")))
    if not split.hot:
        return split.with_rows(counted)
    parts = hot_only(split).groupBy(split.key, CHUNK).agg(F.sum(hit).alias("_hits"))
    carried = parts.select(split.key, CHUNK, F.sum("_hits").over(before_chunk(parts, split.key)).alias("_before_hits"))
    joined = counted.join(F.broadcast(carried), [split.key, CHUNK], "left")
    total = F.col(name) + F.coalesce(F.col("_before_hits"), F.lit(0))
    return split.with_rows(joined.withColumn(name, total).drop("_before_hits"))


def previous_value(split: Split, value: str, name: str) -> Split:
    """The value in the key's preceding row, null for the first."""
    local = split.rows.withColumn(name, F.lag(value).over(split.window()))
    if not split.hot:
        return split.with_rows(local)
    row_order = F.struct(*split.order)
    parts = (
        hot_only(split)
        .groupBy(split.key, CHUNK)
        .agg(F.max_by(F.struct(value), row_order).alias("_last"), F.min(row_order).alias("_first_order"))
    )
    by_chunk = Window.partitionBy(split.key).orderBy(CHUNK)
    carried = parts.select(split.key, CHUNK, "_first_order", F.lag("_last").over(by_chunk).alias("_carried"))
    joined = local.join(F.broadcast(carried), [split.key, CHUNK], "left")
    starts = F.coalesce(F.struct(*split.order) == F.col("_first_order"), F.lit(False))
    patched = F.when(starts, F.col(f"_carried.{value}")).otherwise(F.col(name))
    return split.with_rows(joined.withColumn(name, patched).drop("_carried", "_first_order"))
