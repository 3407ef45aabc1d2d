"""Packing documents into training sequences by swap-based local search.

A document's ids (and an end id) form one piece, or, if they are more than a sequence
holds, pieces of a whole sequence each behind a first one that may be shorter. Pieces are
dealt round-robin into groups of bounded size, so no key or source decides where they go,
and each group is packed on its own: best fit by decreasing length first, then local
search between underfull bins. From the least filled bin, a piece moves to another bin,
changes places with a smaller piece, or with two pieces, or two pieces change places with
one, whichever raises the sum of squared fills most; bins that become empty go. Each step
raises an integer that is bounded, so the search ends; it also ends when the group has no
more bins than its tokens need. A group leaves at most a part of one bin more than a single
packing of everything would.

Defined cases: null and empty texts give a piece of one id (the end id); repeated rows are
packed as often as they occur; an empty table gives no rows; ties are broken by the order
of pieces, so equal input in equal partitions gives equal output; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .base import kept_by_worker, pieces, ship
from .tokens import UnitEncoder, as_packed, tokenizer_path

ship(__name__)

CAPACITY, END_ID = 2048, 0
#: Pieces that are packed together.
GROUP_PIECES = 8000


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than a sequence."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n_tokens, capacity))] if n_tokens else []


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        at = bisect_left(open_bins, (need, -1))
        if at == len(open_bins):
            room, number = capacity, len(bins)
            bins.append([])
        else:
            room, number = open_bins.pop(at)
        bins[number].append(piece)
        if room > need:
            insort(open_bins, (room - need, number))
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing goes below: by tokens, by how many pieces of a size
    fit one bin, and by the room that pieces above half a bin leave for the others."""
    if not len(lengths):
        return 0
    ordered = np.sort(lengths)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    bounds = [-(-int(sums[-1]) // capacity)]
    for fit in range(1, 8):
        bounds.append(-(-int((lengths > capacity // (fit + 1)).sum()) // fit))
    half = int(np.searchsorted(ordered, capacity // 2, "right"))
    for small in np.unique(ordered[:half]).tolist():
        low, high = int(np.searchsorted(ordered, small, "left")), int(np.searchsorted(ordered, capacity - small, "right"))
        alone, large = len(ordered) - max(high, half), max(high, half) - half
        room = large * capacity - int(sums[max(high, half)] - sums[half])
        bounds.append(alone + large + max(0, -(-(int(sums[half] - sums[low]) - room) // capacity)))
    return max(bounds)


class LocalSearch:
    """Exchanges between underfull bins until no exchange raises the squared fill."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.size, self.capacity = lengths.astype(np.int64), capacity
        self.bins = [list(b) for b in bins]
        self.fill = np.array([int(self.size[b].sum()) for b in bins], np.int64)
        self.bin_of = np.zeros(len(lengths), np.int64)
        for number, members in enumerate(bins):
            self.bin_of[members] = number
        self.least = least_bins(lengths, capacity)
        self.pairs: dict[int, np.ndarray] = {}
        self.pair_table: np.ndarray | None = None

    def _pairs_of(self, number: int) -> np.ndarray:
        """(bin, sum, piece, piece), one pair for each sum."""
        own = self.bins[number]
        by_sum = {int(self.size[p] + self.size[q]): (p, q) for k, p in enumerate(own) for q in own[k + 1:]}
        return np.array([(number, total, *names) for total, names in by_sum.items()], np.int64).reshape(-1, 4)

    def _pair_rows(self) -> np.ndarray:
        if self.pair_table is None:
            for number in np.flatnonzero((self.fill > 0) & (self.fill < self.capacity)).tolist():
                if number not in self.pairs:
                    self.pairs[number] = self._pairs_of(number)
            self.pair_table = np.concatenate([*self.pairs.values(), np.empty((0, 4), np.int64)])
        return self.pair_table

    def _best(self, donor: int, out_size: int, back: np.ndarray, in_bin: np.ndarray) -> tuple[int, int]:
        """Gain and place of the best partner for pieces of ``out_size`` tokens."""
        grow = out_size - back
        fill = self.fill[in_bin]
        gain = np.where((grow > 0) & (grow <= self.capacity - fill) & (in_bin != donor) & (fill > 0), grow * (fill - self.fill[donor] + grow), 0)
        at = int(gain.argmax()) if len(gain) else 0
        return (int(gain[at]), at) if len(gain) else (0, 0)

    def _exchange(self, donor: int) -> bool:
        """The best move or exchange out of the donor; pairs are tried if nothing simpler gains."""
        own = self.bins[donor]
        singles = {int(self.size[p]): (p,) for p in reversed(own)}
        every = np.arange(len(self.fill))
        best, found = 0, None
        for size, out in singles.items():
            gain, at = self._best(donor, size, np.zeros(len(every), np.int64), every)
            if gain > best:
                best, found = gain, (out, at, ())
            gain, at = self._best(donor, size, self.size, self.bin_of)
            if gain > best:
                best, found = gain, (out, int(self.bin_of[at]), (at,))
        if not found:
            rows = self._pair_rows()
            for size, out in singles.items():
                gain, at = self._best(donor, size, rows[:, 1], rows[:, 0])
                if gain > best:
                    best, found = gain, (out, int(rows[at, 0]), tuple(rows[at, 2:].tolist()))
            for _, size, *out in self._pairs_of(donor).tolist():
                gain, at = self._best(donor, size, self.size, self.bin_of)
                if gain > best:
                    best, found = gain, (tuple(out), int(self.bin_of[at]), (at,))
        if found:
            self._apply(donor, *found)
        return found is not None

    def _apply(self, donor: int, out: tuple, other: int, back: tuple) -> None:
        for moving, source, target in ((out, donor, other), (back, other, donor)):
            for piece in moving:
                self.bins[source].remove(piece)
                self.bins[target].append(piece)
                self.bin_of[piece] = target
                self.fill[source] -= self.size[piece]
                self.fill[target] += self.size[piece]
        for number in (donor, other):
            self.pairs.pop(number, None)
        self.pair_table = None

    def run(self) -> list[list[int]]:
        moved = True
        while moved and int((self.fill > 0).sum()) > self.least:
            moved = False
            for donor in np.argsort(self.fill, kind="stable").tolist():
                while 0 < self.fill[donor] < self.capacity and self._exchange(donor):
                    moved = True
                if int((self.fill > 0).sum()) <= self.least:
                    break
        return [b for b in self.bins if b]


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    full = np.flatnonzero(lengths >= capacity)
    rest = np.flatnonzero(lengths < capacity)
    bins = LocalSearch(lengths[rest], best_fit(lengths[rest], capacity), capacity).run() if len(rest) else []
    return [[int(p)] for p in full] + [[int(rest[p]) for p in b] for b in bins]


def tokenised_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, groups: int, capacity: int, end_id: int) -> DataFrame:
    kind = docs.schema[id_col].dataType
    names = ["id", "piece", "start", "length", "ids_crc32", "group"]
    types = [to_arrow_type(kind), pa.int32(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("packed tokens", path), lambda: UnitEncoder(path, as_packed))
        end, dealt, partition = end_id.to_bytes(4, "little"), 0, TaskContext.get().partitionId()
        for batch in pieces(batches):
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(b"".join(encoder.values(text)) + end)
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    group = (partition + dealt) % groups
                    rows.append((name, number, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), group))
                    dealt += 1
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long, group long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id and offset.

    The number of groups follows the number of documents and the bytes of their texts, so a
    few very long documents spread over groups as well."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("bytes")).first()
    groups = max(1, -(-(size["n"] + (size["bytes"] or 0) // (4 * capacity)) // group_pieces))
    tokenised = tokenised_pieces(docs, id_col, text_col, path or tokenizer_path(), groups, capacity, end_id)
    kind = docs.schema[id_col].dataType.simpleString()

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "piece", "start"], kind="stable").reset_index(drop=True)
        lengths = frame["length"].to_numpy()
        sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        for number, members in enumerate(pack(lengths, capacity)):
            sequence[members] = (int(frame["group"].iloc[0]) << 32) + number
            offset[members] = np.concatenate([[0], np.cumsum(lengths[members])[:-1]])
        return frame.drop(columns="group").assign(sequence_id=sequence, offset=offset)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return tokenised.groupBy("group").applyInPandas(place, schema).withColumnRenamed("id", id_col)
