"""First-wins acceptance with a time limit, per key.

The first row of a key is accepted; a later row is accepted when it comes at
least ``ttl_ms`` after the last *accepted* one. Acceptance is therefore a chain
through the key's rows, not a window. Any stretch as long as the limit holds at
most one accepted row, so chains are short however many rows a key has.

Keys up to ``fold_rows`` rows: a fold over the sorted (time, position) array.

Larger keys: time is cut into blocks as long as the limit, counted from the key's first
row, and consecutive blocks into ranges of at most ``group_rows`` rows. All that a range
needs to know of the past is the *threshold*, the time from which it may accept. Each range
returns its jump map, a step function from the threshold at its begin to the threshold at its
end, with as many steps as its first block has rows at most, and mostly far fewer as chains
run together. Jump maps of neighbours compose, ``FAN_IN`` at a time, in a number of rounds
that is the logarithm of the number of ranges; on the way back down each range gets its own
threshold, and then all ranges list their accepted rows in parallel. No task sees more of a
key than a range or ``FAN_IN`` maps.

Keys with a block of more than ``group_rows`` rows of different times (so the limit is more
than ``group_rows`` milliseconds) are cut within blocks: time is written as block * ttl +
phase. Along a chain the phase never falls from one block to the next until
a block runs out of later rows, where the chain drops to the first row of a
following block. Rows are grouped by (key, range of phases). A chain always enters such a group
at the first row of one of its blocks, so each group can tell on its own, for
every block, how far a chain entering there gets. Walking from group to group
then needs that table only, which holds (span / group_rows) * (span / ttl) cells of a key at
most, span in milliseconds, and a last pass lists the accepted rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, ship_with_tasks
from .ordered import key_sizes

ship_with_tasks(__name__)

FOLD_ROWS = 5_000
FOLD_CHUNK = 64
ROWS_PER_PHASE_GROUP = 1_000_000
#: Jump maps that are composed in one step.
FAN_IN = 8
SALTS = 64


def _fold(entries: Column, ttl_ms: int) -> Column:
    """Accepted (time, position) entries of one sorted array. Accepted entries gather in a
    short array that moves to a list of arrays when it is full, so that the copies which
    ``concat`` makes stay short."""

    def step(state: Column, entry: Column) -> Column:
        due = state["last"].isNull() | (entry["t"] - state["last"] >= F.lit(ttl_ms))
        full = F.size(state["kept"]) >= FOLD_CHUNK
        return F.when(
            due,
            F.struct(
                entry["t"].alias("last"),
                F.when(full, F.array(entry)).otherwise(F.concat(state["kept"], F.array(entry))).alias("kept"),
                F.when(full, F.concat(state["done"], F.array(state["kept"]))).otherwise(state["done"]).alias("done"),
            ),
        ).otherwise(state)

    none = F.slice(entries, 1, 0)
    start = F.struct(F.lit(None).cast("bigint").alias("last"), none.alias("kept"), F.slice(F.array(none), 1, 0).alias("done"))
    return F.aggregate(entries, start, step, lambda state: F.flatten(F.concat(state["done"], F.array(state["kept"]))))


def _next_rows(times: np.ndarray, ttl_ms: int) -> np.ndarray:
    """For each row of a sorted array the next one a chain accepts; the length at the end."""
    return np.searchsorted(times, times + ttl_ms, side="left")


def _last_rows(following: np.ndarray) -> np.ndarray:
    """For each row the last one of its chain, by doubling."""
    own = np.arange(len(following))
    jump = np.where(following < len(following), following, own)
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump
        jump = further


def _steps(upto: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A step function without repeated values: thresholds up to ``upto`` leave as ``leaves``."""
    keep = np.append(leaves[1:] != leaves[:-1], True) if len(leaves) else np.empty(0, bool)
    return upto[keep], leaves[keep]


def _through(upto: np.ndarray, leaves: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The thresholds after a map; one above all steps finds no row and leaves as 0."""
    at = np.searchsorted(upto, thresholds, side="left")
    return np.append(leaves, 0)[at]


def _map_of_range(rows: pd.DataFrame, ttl_ms: int) -> pd.DataFrame:
    """The jump map of one range; ``_u`` is the time from its begin, ``_length`` its length."""
    times, length = np.sort(rows["_u"].to_numpy()), int(rows["_length"].iloc[0])
    leaves = np.maximum(0, times[_last_rows(_next_rows(times, ttl_ms))] + ttl_ms - length)
    # a threshold is below the limit, so one row behind the first block ends the steps
    first = int(np.searchsorted(times, ttl_ms, side="left")) + 1
    upto, leaves = _steps(times[:first], leaves[:first])
    return pd.DataFrame({"_k": rows["_k"].iloc[0], "_range": rows["_range"].iloc[0], "_upto": upto, "_leaves": leaves})


def _maps(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range, upto, leaves) of the maps in a frame, in order."""
    frame = frame.sort_values(["_range", "_upto"], kind="stable")
    columns = [frame[c].to_numpy() for c in ("_range", "_upto", "_leaves")]
    for number, start, end in _blocks(columns[0]):
        yield number, columns[1][start:end], columns[2][start:end]


def _compose(frame: pd.DataFrame) -> pd.DataFrame:
    """One map of up to ``FAN_IN`` neighbours. Where a range is missing, it has no row, and the
    threshold is 0 behind it: ranges are no shorter than the limit."""
    upto, leaves, before = np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64), None
    parent = int(frame["_range"].iloc[0]) // FAN_IN
    for number, own_upto, own_leaves in _maps(frame):
        if before is None and number == parent * FAN_IN:
            upto, leaves = own_upto, own_leaves
        elif before is not None and number == before + 1:
            leaves = _through(own_upto, own_leaves, leaves)
            if upto[-1] != np.iinfo(np.int64).max:  # thresholds above all steps go on as 0
                upto, leaves = np.append(upto, np.iinfo(np.int64).max), np.append(leaves, _through(own_upto, own_leaves, np.zeros(1, np.int64)))
        else:
            upto, leaves = np.array([np.iinfo(np.int64).max]), _through(own_upto, own_leaves, np.zeros(1, np.int64))
        before = number
    if before != parent * FAN_IN + FAN_IN - 1:
        upto, leaves = np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64)
    upto, leaves = _steps(upto, leaves)
    return pd.DataFrame({"_k": frame["_k"].iloc[0], "_range": parent, "_upto": upto, "_leaves": leaves})


def _thresholds(maps: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """The threshold of each of up to ``FAN_IN`` neighbours, given that of the first."""
    if maps.empty or entry.empty:
        return pd.DataFrame({"_k": pd.Series(dtype=object), "_range": pd.Series(dtype="int64"), "_entry": pd.Series(dtype="int64")})
    at, value, out = int(maps["_range"].iloc[0]) // FAN_IN * FAN_IN, int(entry["_entry"].iloc[0]), []
    for number, upto, leaves in _maps(maps):
        value = value if number == at else 0
        out.append((number, value))
        value, at = int(_through(upto, leaves, np.array([value]))[0]), number + 1
    found = pd.DataFrame(out, columns=["_range", "_entry"])
    found.insert(0, "_k", maps["_k"].iloc[0])
    return found


def _listed(rows: pd.DataFrame, ttl_ms: int) -> pd.DataFrame:
    """The accepted rows of one range, given its threshold."""
    order = np.argsort(rows["_u"].to_numpy(), kind="stable")
    times = rows["_u"].to_numpy()[order]
    following, kept = _next_rows(times, ttl_ms), []
    at = int(np.searchsorted(times, rows["_entry"].iloc[0], side="left"))
    while at < len(times):
        kept.append(at)
        at = int(following[at])
    return rows[["_k", "_p"]].iloc[order[kept]]


def _blocks(block: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(block, start, end) for each run of one block in a sorted array."""
    values, starts = np.unique(block, return_index=True)
    ends = np.append(starts[1:], len(block))
    return zip(values.tolist(), starts.tolist(), ends.tolist())


def _reach(rows: pd.DataFrame) -> pd.DataFrame:
    """For each block of one (key, phase group): its first phase and the block
    in which a chain entering there accepts its last row of this group."""
    rows = rows.sort_values(["_block", "_phase"], kind="stable")
    block, phase = rows["_block"].to_numpy(), rows["_phase"].to_numpy()
    out: list[tuple[int, int, int]] = []
    next_block, next_phase, next_exit = None, None, None
    for number, start, end in reversed(list(_blocks(block))):
        phases = phase[start:end]
        exits = np.full(len(phases), number, dtype=np.int64)
        if next_block == number + 1:
            at = np.searchsorted(next_phase, phases, side="left")
            linked = at < len(next_phase)
            exits[linked] = next_exit[at[linked]]
        out.append((number, int(phases[0]), int(exits[0])))
        next_block, next_phase, next_exit = number, phases, exits
    cells = pd.DataFrame(out, columns=["_block", "_first_phase", "_exit_block"])
    cells.insert(0, "_group", rows["_group"].iloc[0])
    cells.insert(0, "_k", rows["_k"].iloc[0])
    return cells


def _walk(cells: pd.DataFrame) -> pd.DataFrame:
    """The (group, block) cells at which the key's chain enters a new group."""
    cells = cells.sort_values(["_block", "_group"], kind="stable")
    block, group, leaves = (cells[c].to_numpy() for c in ("_block", "_group", "_exit_block"))
    span = {number: (start, end) for number, start, end in _blocks(block)}
    numbers = np.fromiter(span, dtype=np.int64)
    visited, at = [], 0
    while at is not None:
        visited.append((group[at], block[at]))
        following = int(leaves[at]) + 1
        start, end = span.get(following, (0, 0))
        inside = start + int(np.searchsorted(group[start:end], group[at], side="right"))
        if inside < end:
            at = inside
            continue
        later = int(np.searchsorted(numbers, following, side="right"))
        at = span[int(numbers[later])][0] if later < len(numbers) else None
    entries = pd.DataFrame(visited, columns=["_group", "_block"])
    entries.insert(0, "_k", cells["_k"].iloc[0])
    return entries


def _accepted(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """All accepted rows of one (key, phase group), given where chains enter."""
    empty = pd.DataFrame({"_k": pd.Series(dtype=object), "_t": pd.Series(dtype="int64")})
    if rows.empty or entries.empty:
        return empty
    rows = rows.sort_values(["_block", "_phase"], kind="stable")
    block, phase, times = (rows[c].to_numpy() for c in ("_block", "_phase", "_t"))
    span = {number: (start, end) for number, start, end in _blocks(block)}
    kept: list[int] = []
    for number in entries["_block"].tolist():
        start, end = span[number]
        at = start
        while at < end:
            kept.append(int(times[at]))
            number += 1
            start, end = span.get(number, (0, 0))
            at = start + int(np.searchsorted(phase[start:end], phase[at], side="left")) if end else end
    return pd.DataFrame({"_k": rows["_k"].iloc[0], "_t": kept})


def _chain_by_ranges(candidates: DataFrame, ttl_ms: int) -> DataFrame:
    """Accepted rows of keys whose blocks are small; ``_width`` blocks make a range."""
    length = F.col("_width") * F.lit(ttl_ms)
    placed = candidates.withColumn("_length", length).withColumn("_range", F.expr("(_t - _t0) div _length"))
    placed = placed.select("_k", "_range", (F.col("_t") - F.col("_t0") - F.col("_range") * F.col("_length")).alias("_u"), "_length", "_p")
    ddl = "_k string, _range bigint, _upto bigint, _leaves bigint"
    maps = placed.groupBy("_k", "_range").applyInPandas(lambda rows: _map_of_range(rows, ttl_ms), ddl)
    levels = [cut_lineage(maps)]
    most = levels[0].agg(F.max("_range")).first()[0] or 0
    while most > 0:
        parent = F.expr(f"_range div {FAN_IN}")
        levels.append(cut_lineage(levels[-1].groupBy("_k", parent.alias("_parent")).applyInPandas(_compose, ddl)))
        most //= FAN_IN
    entries = levels.pop().select("_k", "_range").distinct().withColumn("_entry", F.lit(0).cast("bigint"))
    for maps in reversed(levels):
        children = maps.groupBy("_k", F.expr(f"_range div {FAN_IN}").alias("_parent"))
        entries = children.cogroup(entries.groupBy("_k", "_range")).applyInPandas(_thresholds, "_k string, _range bigint, _entry bigint")
    rows = placed.join(entries, ["_k", "_range"])
    return rows.groupBy("_k", "_range").applyInPandas(lambda own: _listed(own, ttl_ms), f"_k string, _p {candidates.schema['_p'].dataType.simpleString()}")


def _chain_by_phases(candidates: DataFrame, ttl_ms: int, group_rows: int) -> DataFrame:
    placed = (
        candidates.withColumn("_groups", F.ceil(F.col("_n") / group_rows).cast("bigint"))
        .withColumn("_block", F.expr(f"(_t - _t0) div {ttl_ms}"))
        .withColumn("_phase", F.pmod(F.col("_t") - F.col("_t0"), F.lit(ttl_ms)))
        .withColumn("_group", F.expr(f"(_phase * _groups) div {ttl_ms}"))
        .select("_k", "_group", "_block", "_phase", "_t")
    )
    cells = placed.groupBy("_k", "_group").applyInPandas(
        _reach, "_group bigint, _k string, _block bigint, _first_phase bigint, _exit_block bigint"
    )
    entries = cells.groupBy("_k").applyInPandas(_walk, "_k string, _group bigint, _block bigint")
    chain = (
        placed.groupBy("_k", "_group")
        .cogroup(entries.groupBy("_k", "_group"))
        .applyInPandas(_accepted, "_k string, _t bigint")
    )
    return candidates.select("_k", "_t", "_p").join(chain, ["_k", "_t"]).select("_k", "_p")


def _chain_of_large_keys(candidates: DataFrame, ttl_ms: int, group_rows: int) -> DataFrame:
    """Rows of large keys have ``_most``, the rows of their largest block."""
    narrow = candidates.where(F.col("_most") <= group_rows).withColumn("_width", F.expr(f"greatest(1, {group_rows} div _most)"))
    found = _chain_by_ranges(narrow, ttl_ms)
    dense = candidates.where(F.col("_most") > group_rows)
    return found if dense.isEmpty() else found.unionByName(_chain_by_phases(dense, ttl_ms, group_rows))


def accepted_rows(
    df: DataFrame,
    key: str,
    time: str,
    position: str,
    ttl_ms: int,
    fold_rows: int = FOLD_ROWS,
    group_rows: int = ROWS_PER_PHASE_GROUP,
) -> DataFrame:
    """(key, position) of each accepted row. Rows come in (time, position)
    order; ``key`` is non-null text, ``time`` BIGINT, ``position`` unique."""
    slim = df.select(F.col(key).alias("_k"), F.col(time).alias("_t"), F.col(position).alias("_p"))
    if not key_sizes(slim, "_k", fold_rows).take(1):
        small, large = slim, None
    else:
        # Copies of a row (same key, same time) collapse before the shuffle.
        slim = slim.groupBy("_k", "_t").agg(F.min("_p").alias("_p"))
        sizes = slim.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_t0")).where(F.col("_n") > fold_rows)
        salted = lambda df: df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        tagged = slim.withColumn("_salt", F.pmod(F.xxhash64("_t"), F.lit(SALTS)).cast("int")).join(salted(sizes), ["_k", "_salt"], "left")
        small = tagged.where(F.col("_n").isNull()).select("_k", "_t", "_p")
        large = tagged.where(F.col("_n").isNotNull())
        most = large.groupBy("_k", F.expr(f"(_t - _t0) div {ttl_ms}").alias("_block")).count().groupBy("_k").agg(F.max("count").alias("_most"))
        large = _chain_of_large_keys(cut_lineage(large.join(salted(most), ["_k", "_salt"]).drop("_salt")), ttl_ms, group_rows)
    entries = F.sort_array(F.collect_list(F.struct(F.col("_t").alias("t"), F.col("_p").alias("p"))))
    folded = (
        small.groupBy("_k")
        .agg(entries.alias("_entries"))
        .select("_k", F.explode(_fold(F.col("_entries"), ttl_ms)).alias("_e"))
        .select("_k", F.col("_e.p").alias("_p"))
    )
    if large is not None:
        folded = folded.unionByName(large.select("_k", "_p"))
    return folded.select(F.col("_k").alias(key), F.col("_p").alias(position))
