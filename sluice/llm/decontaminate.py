"""Benchmark decontamination with spaced seeds.

Texts become lower-case words. Fixed masks pick some positions of a run of words and ignore
the others; the hashes of the picked words of every run of a benchmark item are joined with
those of every run of a document. A common hash gives the alignment of item and document,
and the words along it are compared: the document leaks the item if some ``SPAN`` aligned
words in a row (all of the item's words, if it has fewer) agree in at least ``AGREE`` of
their places. Substituted words are thus tolerated wherever they fall; the masks differ so
that one of them meets unchanged words.

Any overlap that agrees in so many places is found: among 13 words in a row with at most two
others, or 7 to 12 with as many others as the share allows, one of the masks picks none of
them (a test goes through all cases).

Where words repeat, the same alignment comes from many common hashes: alignments are made
distinct in bounded steps, so a text and an item have no more of them than words together,
and each is compared once.

The benchmark side is cut into blocks of about ``BLOCK_WORDS`` words. A block's seeds go to
the tasks and all documents are read against them, so what is broadcast is bounded however
large the benchmark; documents are not shuffled. Items with the same words are looked up
once; the ids of all of them are joined to what is found, so the result does not depend on
the blocks.

Defined cases: null and empty texts leak nothing; items of fewer than ``LEAST_WORDS`` words
(null and empty ones too) are no evidence and match nothing; items of up to 7 words must
agree in all places; items with the same words are each named, rows of the same item once;
items without an id are left out; repeated documents give their rows again;
an empty benchmark gives no rows; texts of any length are handled in overlapping pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage
from .base import filter_rows, pieces, ship

ship(__name__)

#: Places of a run that a mask picks (1) or ignores (0).
MASKS = ("11111", "1101011", "10110011", "110010101")
SPAN, AGREE, LEAST_WORDS = 13, 0.8, 5
BLOCK_WORDS = 200_000
#: Longer items and documents are handled in parts of this many words that overlap by a span.
PART_WORDS, TEXT_WORDS = 512, 200_000
#: Pairs of places with a common hash that are looked at together.
STEP_HITS = 1_000_000
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def mask_places(masks: tuple[str, ...] = MASKS) -> list[np.ndarray]:
    return [np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1")) for mask in masks]


def seed_hashes(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs whose picked words all have an id above 0, and their hashes."""
    count = len(ids) - int(places[-1])
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    known = ids > 0
    all_known = known[:count].copy()
    for place in places[1:]:
        all_known &= known[place:place + count]
    starts = np.flatnonzero(all_known)
    hashes = np.zeros(len(starts), np.uint64)
    for place in places:
        hashes = (hashes + ids[starts + place].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    return starts, hashes


class SeedIndex:
    """Seeds of a block of items: sorted hashes per mask with the place each comes from."""

    def __init__(self, items: list[tuple[int, list[str]]], span: int = SPAN, agree: float = AGREE, masks: tuple[str, ...] = MASKS):
        self.span, self.agree, self.places = span, agree, mask_places(masks)
        self.vocabulary: dict[str, int] = {}
        self.items, self.names, flat = [], [], []
        for name, item in items:
            for at in range(0, max(1, len(item) - span), PART_WORDS - span):
                part = item[at:at + PART_WORDS]
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in part], np.int32)
                self.items.append(ids)
                self.names.append(name)
        for places in self.places:
            of_item, at, hashes = [], [], []
            for k, ids in enumerate(self.items):
                starts, found = seed_hashes(ids, places)
                of_item.append(np.full(len(starts), k))
                at.append(starts)
                hashes.append(found)
            hashes, of_item, at = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (hashes, of_item, at))
            order = np.argsort(hashes, kind="stable")
            flat.append((hashes[order], of_item[order], at[order]))
        self.seeds = flat

    def _aligned(self, ids: np.ndarray) -> np.ndarray:
        """Distinct (item, document place minus item place) of all common hashes."""
        found, shift_by = np.empty(0, np.int64), PART_WORDS
        for places, (hashes, of_item, at) in zip(self.places, self.seeds):
            starts, own = seed_hashes(ids, places)
            if not len(own) or not len(hashes):
                continue
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            hit = np.flatnonzero(high > low)
            ends = np.cumsum((high - low)[hit])
            begin = 0
            while begin < len(hit):  # some hits at a time, about ``STEP_HITS`` pairs
                before = int(ends[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + STEP_HITS, "right")))
                step = hit[begin:end]
                counts = (high - low)[step]
                which = np.repeat(low[step] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                pairs = (of_item[which].astype(np.int64) << 32) + np.repeat(starts[step], counts) - at[which] + shift_by
                found = pd.unique(np.concatenate([found, pd.unique(pairs)]))
                begin = end
        found.sort()
        return np.stack([found >> 32, (found & 0xFFFFFFFF) - shift_by], axis=1)

    def _overlap(self, ids: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
        """First word in the document, length and agreeing words of the leaked part, if any."""
        first, last = max(0, shift), min(len(ids), shift + len(item))
        span = min(self.span, len(item))
        if last - first < span:
            return None
        equal = ids[first:last] == item[first - shift:last - shift]
        sums = np.concatenate([[0], np.cumsum(equal)])
        need = span if span < 8 else int(np.ceil(self.agree * span - 1e-9))
        good = np.flatnonzero(sums[span:] - sums[:-span] >= need)
        if not len(good):
            return None
        begin, end = int(good[0]), int(good[-1]) + span
        return first + begin, end - begin, int(sums[end] - sums[begin])

    def leaks(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """Per leaked item the overlap with the most agreeing words: start, length, agreeing."""
        best: dict[int, tuple[int, int, int]] = {}
        own = words(text)
        get = self.vocabulary.get
        for begin in range(0, max(1, len(own) - PART_WORDS), TEXT_WORDS - PART_WORDS):
            part = own[begin:begin + TEXT_WORDS]
            ids = np.fromiter((get(w, 0) for w in part), np.int32, len(part))
            for k, shift in self._aligned(ids).tolist():
                overlap = self._overlap(ids, self.items[k], shift)
                name = self.names[k]
                if overlap and (name not in best or (overlap[2], -overlap[0] - begin) > (best[name][2], -best[name][0])):
                    best[name] = (overlap[0] + begin, *overlap[1:])
        return best


def keyed_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """name, words (joined), n and a digest of the words, of the items with an id and at least
    ``LEAST_WORDS`` words."""
    kind = items.schema[id_col].dataType.simpleString()
    narrow = items.select(F.col(id_col).alias("name"), F.col(text_col).cast("string").alias("text")).where("name IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            own = [words(text) for text in piece.column(1).to_pylist()]
            joined = [" ".join(w) for w in own]
            columns = [piece.column(0), pa.array(joined, pa.string()), pa.array(map(len, own), pa.int64()), pa.array([hashlib.md5(j.encode()).digest() for j in joined], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "words", "n", "key"])

    return narrow.mapInArrow(run, f"name {kind}, words string, n long, key binary").where(F.col("n") >= LEAST_WORDS)


def blocks(keyed: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[str]]]]:
    """The items with different words, block by block, under the smallest of their ids; each
    block is bounded by ``block_words`` on average, one item apart."""
    plain = keyed.groupBy("key").agg(F.min("name").alias("name"), F.first("words").alias("words"), F.first("n").alias("n"))
    total = plain.agg(F.sum("n")).first()[0] or 0
    count = -(-total // block_words)
    for k in range(count):
        rows = plain.where(F.pmod(F.xxhash64("key"), F.lit(count)) == k).select("name", "words").collect()
        if rows:
            yield sorted((row["name"], row["words"].split(" ")) for row in rows)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document row and leaked item: ids, first word, length in words, agreeing words."""
    kind, item_kind = docs.schema[id_col].dataType, items.schema[item_id].dataType
    schema = f"id {kind.simpleString()}, item {item_kind.simpleString()}, start_word int, n_words int, n_equal int"
    types = [to_arrow_type(kind), to_arrow_type(item_kind), pa.int32(), pa.int32(), pa.int32()]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    result, keyed = None, cut_lineage(keyed_items(items, item_id, item_text))
    for block in blocks(keyed, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = SeedIndex(sent.value)
            for piece in pieces(batches):
                rows = []
                for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    rows += [(name, item, *overlap) for item, overlap in sorted(index.leaks(text).items())]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "item", "start_word", "n_words", "n_equal"])

        part = narrow.mapInArrow(run, schema)
        result = part if result is None else result.union(part)
    if result is None:
        result = docs.sparkSession.createDataFrame([], schema)
    names = keyed.groupBy("key").agg(F.min("name").alias("item")).join(keyed, "key").select("item", "name").distinct().where("item != name")
    if not names.isEmpty():  # other items with the same words
        others = result.join(names, "item").select("id", F.col("name").alias("item"), "start_word", "n_words", "n_equal")
        result = result.union(others)
    return result.withColumnsRenamed({"id": id_col, "item": item_id})


def drop_leaking(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, with all columns, that leak no item."""
    for block in blocks(cut_lineage(keyed_items(items, item_id, item_text)), block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def make(sent=sent) -> Callable[[list], list]:
            index = SeedIndex(sent.value)
            return lambda texts: [not index.leaks(text) for text in texts]

        docs = filter_rows(docs, text_col, make)
    return docs
