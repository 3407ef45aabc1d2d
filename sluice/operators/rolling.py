"""Statistics of the last samples before each row, at a cost that does not follow the window.

One kernel serves tables and streams. Moments come from blocks as long as the window: a window
is the end of one block and the begin of the next, so running moments from both ends of every
block give each window by one merge. They are taken around a block's own first or last value,
and windows of equal values are recognised by their least and greatest value, so nothing
cancels. Quartiles come from a sorted list in which one sample replaces another.

On tables, rows are dealt by key, sorted, and read in batches; what is carried from one batch
to the next is a key's last samples, so a key's size does not matter for memory.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import ship_with_tasks

ship_with_tasks(__name__)


def merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and squared deviations of two disjoint samples together."""
    (na, ma, qa), (nb, mb, qb) = a, b
    n = na + nb
    with np.errstate(invalid="ignore", divide="ignore"):
        gap = np.where((na > 0) & (nb > 0), mb - ma, 0.0)
        mean = np.where(na == 0, mb, np.where(nb == 0, ma, ma + gap * nb / n))
        return n, mean, qa + qb + np.where(gap == 0, 0.0, gap * gap * na * nb / n)


def running(x: np.ndarray) -> tuple:
    """Per row of each line count, mean and squared deviations of its values so far."""
    n = np.arange(1, x.shape[1] + 1)
    first = x[:, :1]
    with np.errstate(invalid="ignore", over="ignore"):
        d = x - first
        s1, s2 = np.cumsum(d, axis=1), np.cumsum(d * d, axis=1)
        squares = s2 - s1 * s1 / n
        return np.broadcast_to(n, x.shape), first + s1 / n, np.where(squares < 0, 0.0, squares)


def window_moments(before: np.ndarray, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per value the count, mean and squared deviations of the ``width`` samples before it."""
    x = np.concatenate([before[-width:], values]).astype(float)
    size = max(1, min(width, len(x)))
    lines = -(-len(x) // size)
    block = np.concatenate([x, np.full(lines * size - len(x), x[-1] if len(x) else 0.0)]).reshape(lines, size)
    ahead = [part.ravel() for part in running(block)]
    back = [part[:, ::-1].ravel() for part in running(block[:, ::-1])]
    low = [np.minimum.accumulate(block, axis=1).ravel(), np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()]
    high = [np.maximum.accumulate(block, axis=1).ravel(), np.maximum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()]
    at = np.arange(len(x) - len(values), len(x))
    first, last = np.maximum(0, at - width), at - 1
    some = last >= first
    last = np.maximum(last, 0)
    two = first // size != last // size  # the window lies in two blocks
    n, mean, squares = merged(tuple(np.where(two, part[first], 0) for part in back), tuple(part[last] for part in ahead))
    least = np.where(two, np.minimum(low[1][first], low[0][last]), low[0][last])
    most = np.where(two, np.maximum(high[1][first], high[0][last]), high[0][last])
    equal = least == most
    return np.where(some, n, 0).astype(np.int64), np.where(equal, least, mean), np.where(equal, 0.0, squares)


def quartiles(before: np.ndarray, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per value the count and the lower and upper quartile of the ``width`` samples before it,
    interpolated; not-a-number counts as the greatest value."""
    x = np.concatenate([before[-width:], values]).astype(float).tolist()
    start = len(x) - len(values)
    ordered = sorted(v for v in x[:start] if v == v)
    held = start
    out = np.full((3, len(values)), np.nan)

    def quantile(share: float) -> float:
        at = share * (held - 1)
        low = int(at)
        high = min(low + 1, held - 1)
        if high >= len(ordered) and (high > low and at > low or low >= len(ordered)):
            return float("nan")
        return ordered[low] if at == low else ordered[low] + (ordered[high] - ordered[low]) * (at - low)

    for k, value in enumerate(values.tolist()):
        out[0, k] = held
        if held:
            out[1, k], out[2, k] = quantile(0.25), quantile(0.75)
        if held == width:
            oldest = x[start + k - width]
            if oldest == oldest:
                del ordered[bisect_left(ordered, oldest)]
        else:
            held += 1
        if value == value:
            insort(ordered, value)
    return out[0].astype(np.int64), out[1], out[2]


STATS = ("_n", "_stat_a", "_stat_b")


def rolling_stats(rows: DataFrame, groups: list[str], order: list[str], value: str, width: int, exact: bool) -> DataFrame:
    """``rows`` with the statistics of the last ``width`` samples (non-null values) before each
    row of its group: ``_n``, and mean and squared deviations, or both quartiles if ``exact``.
    Rows without a value get null statistics and are no samples."""
    sorted_rows = rows.repartition(*[F.col(f"`{g}`") for g in groups]).sortWithinPartitions(*[F.col(f"`{c}`") for c in (*groups, *order)])
    schema = StructType(rows.schema.fields + [StructField(STATS[0], LongType()), StructField(STATS[1], DoubleType()), StructField(STATS[2], DoubleType())])
    kernel, names = (quartiles if exact else window_moments), list(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, recent = None, np.empty(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.zeros(batch.num_rows, bool)
            for name in names:
                column = batch.column(name)
                same = pc.equal(column[1:], column[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
                null = column.is_null().to_numpy(zero_copy_only=False)
                changed[1:] |= ~(same | null[1:] & null[:-1])
            starts = np.append(0, np.flatnonzero(changed))
            samples = batch.column(value)
            known = ~samples.is_null().to_numpy(zero_copy_only=False)
            numbers = samples.fill_null(0.0).to_numpy(zero_copy_only=False)
            stats = [np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows)]
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                own = tuple(batch.column(name)[start].as_py() for name in names)
                if own != key:
                    key, recent = own, np.empty(0)
                at = start + np.flatnonzero(known[start:end])
                if len(at):
                    for column, part in zip(stats, kernel(recent, numbers[at], width)):
                        column[at] = part
                    recent = np.concatenate([recent, numbers[at]])[-width:]
            missing = ~known
            empty = missing | (stats[0] == 0)
            extra = [pa.array(stats[0], pa.int64(), mask=missing), pa.array(stats[1], pa.float64(), mask=empty), pa.array(stats[2], pa.float64(), mask=empty)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *STATS])

    return sorted_rows.mapInArrow(run, schema)
