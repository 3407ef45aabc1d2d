"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its runs of five lower-case words. Texts with the same set are one
*text class* from the start (exact copies among them), so copies never meet in pairs.
MinHash signatures of ``HASHES`` values give candidates: text classes that agree in a whole
band of four values. A band's bucket of up to ``PAIR_BUCKET`` classes gives its pairs;
a larger one ties its members to one of them instead. For each pair the MinHash values are
compared a few at a time, and the pair is dropped as soon as the posterior probability
(uniform prior) that its similarity reaches the threshold falls below ``TOLERANCE``. What
remains ties the classes to *cells*, which are compared within a task: again value by value
with the same pruning, then exactly, by counting common runs.

Cells above a bounded size are cut into blocks. One task for each block holds its members to
the cell's center, whose text it also gets, and returns each in *relative form*: a bit for
every run of the center, and the hashes of its other runs. Two such forms give the exact
number of common runs, and near copies are short in it. From there on only relative forms
travel: with ``links``, every two blocks meet in a task of their own that returns counts and
one link per class, never its pairs, so that every pair of a large group of near copies is
compared and none is written out. Where only classes are asked for, most members are tied by
the center and their block, and just those outside their cell's largest class so far are held
against all blocks. Texts move once, copies collapsed on the side of the sender.

Result: one row per document row with ``class_id`` (the smallest id among the documents that
are linked with it, directly or over others), ``n_links`` (other documents whose similarity
reaches the threshold, copies included), ``n_link_texts`` (text classes among them other
than its own) and ``n_copies`` (documents of its own text class).

Defined cases: null texts and texts without a word have no run; each is alone, with its own
id as class and no links; texts of fewer than five words are one run; repeated rows are
copies; a class whose ids are all null has a null id; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .base import over_texts, ship
from .components import components

ship(__name__)

RUN_WORDS, THRESHOLD = 5, 0.8
HASHES, BAND_ROWS = 80, 4
STEP, TOLERANCE = 16, 1e-6
PAIR_BUCKET = 16
#: Text classes and runs that a block holds, and runs of small cells that share a task.
BLOCK_TEXTS, BLOCK_RUNS, TASK_RUNS = 1024, 400_000, 250_000
FACTORS = np.random.default_rng(5).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = np.random.default_rng(7).integers(0, 2**63, HASHES, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def runs(text: str | None, run_words: int = RUN_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    count = max(1, len(one) - run_words + 1)
    mixed = np.zeros(count, np.uint64)
    for k in range(min(run_words, len(one))):
        mixed = (mixed + one[k:k + count]) * MIX
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def signature(run_hashes: np.ndarray) -> bytes:
    """``HASHES`` MinHash values, 16 bits of each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(run_hashes), 2048):
        part = run_hashes[at:at + 2048]
        np.minimum(least, (FACTORS[:, None] * (part ^ (part >> np.uint64(33)))[None, :] + SHIFTS[:, None]).min(axis=1), out=least)
    return ((least * MIX) >> np.uint64(48)).astype("<u2").tobytes()


@lru_cache(None)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[tuple[int, int], ...]:
    """(values compared, matches below which a pair is dropped). With a uniform prior the
    posterior after m of n matches is Beta(m + 1, n - m + 1); its tail above the threshold
    is the probability of at most m successes in n + 1 trials at the threshold."""
    steps = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        steps.append((n, m))
    return tuple(steps)


def surviving(left: np.ndarray, right: np.ndarray, steps: tuple) -> np.ndarray:
    """Row numbers at which the signatures in ``left`` and ``right`` stay in question."""
    alive, matches, at = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, least in steps:
        matches = matches + (left[alive, at:n] == right[alive, at:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, at = alive[keep], matches[keep], n
    return alive


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool, steps: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that no step drops; the first step goes by blocks."""
    (n, least), first, second = steps[0], [], []
    for at in range(0, len(left), 256):
        count = np.zeros((min(256, len(left) - at), len(right)), np.int16)
        for k in range(n):
            count += left[at:at + 256, k, None] == right[None, :, k]
        rows, columns = np.nonzero(count >= least)
        rows += at
        keep = rows < columns if same else slice(None)
        first.append(rows[keep])
        second.append(columns[keep])
    a, b = np.concatenate([*first, np.empty(0, np.int64)]), np.concatenate([*second, np.empty(0, np.int64)])
    rest = []
    for at in range(0, len(a), 200_000):
        part = surviving(left[a[at:at + 200_000]], right[b[at:at + 200_000]], steps)
        rest.append(part + at)
    keep = np.concatenate([*rest, np.empty(0, np.int64)])
    return a[keep], b[keep]


def similar(a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether the sets numbered ``a`` and ``b`` reach the threshold, exactly."""
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros(len(a), np.int64)
    possible = np.flatnonzero(np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b]) - 1e-9)
    if len(possible) <= 4 * len(sets):
        for k in possible:
            common[k] = len(np.intersect1d(sets[a[k]], sets[b[k]], assume_unique=True))
    else:
        names, place = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared = np.bincount(place, minlength=len(names)) > 1
        column = np.cumsum(shared) - 1
        keep = shared[place]
        owner, place = owner[keep], column[place[keep]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for low in range(0, int(shared.sum()), 4096):
            begin, end = np.searchsorted(place, [low, low + 4096])
            block = np.zeros((len(sets), 4096), np.float32)
            block[owner[begin:end], place[begin:end] - low] = 1
            total += block @ block.T
        common[possible] = total[a[possible], b[possible]].astype(np.int64)
    union = sizes[a] + sizes[b] - common
    return (common > 0) & (common >= threshold * union - 1e-9)


def link_counts(nodes: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Per class, numbered in ascending order, the number of linked classes and documents,
    and the smallest class it is linked with, directly or over others."""
    texts = np.bincount(a, minlength=len(nodes)) + np.bincount(b, minlength=len(nodes))
    docs = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
    root = np.arange(len(nodes))
    while True:  # smallest linked class, until it stays
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pd.DataFrame({"node": nodes, "texts": texts.astype(np.int64), "docs": docs.astype(np.int64), "parent": nodes[root]})


def signatures_of(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["sig"]), "<u2").reshape(-1, HASHES)


def compare_small(frame: pd.DataFrame, threshold: float, steps: tuple) -> pd.DataFrame:
    """Every pair of a cell of one block."""
    frame = frame.sort_values("node", kind="stable").reset_index(drop=True)
    signatures = signatures_of(frame)
    a, b = surviving_pairs(signatures, signatures, True, steps)
    good = similar(a, b, [runs(text) for text in frame["text"]], threshold) if len(a) else np.empty(0, bool)
    return link_counts(frame["node"].to_numpy(), frame["copies"].to_numpy(), a[good], b[good])


def relative(texts: Iterable[str], center: str) -> tuple[list[bytes], list[bytes]]:
    """For each text a bit for every run of the center, and the hashes of its other runs."""
    middle = runs(center)
    held, added = [], []
    for text in texts:
        own = runs(text)
        held.append(np.packbits(np.isin(middle, own, assume_unique=True)).tobytes())
        added.append(own[~np.isin(own, middle, assume_unique=True)].astype("<u8").tobytes())
    return held, added


def common_runs(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Common runs of every text of ``left`` with every one of ``right``, from relative forms."""
    total = np.zeros((len(left), len(right)), np.float32)
    bits = [np.frombuffer(b"".join(f["held"]), np.uint8).reshape(len(f), -1) for f in (left, right)]
    for at in range(0, bits[0].shape[1], 512):
        l, r = (np.unpackbits(b[:, at:at + 512], axis=1).astype(np.float32) for b in bits)
        total += l @ r.T
    names, owners = [], []
    for f in (left, right):
        names.append(np.frombuffer(b"".join(f["added"]), "<u8"))
        owners.append(np.repeat(np.arange(len(f)), [len(x) // 8 for x in f["added"]]))
    shared = np.intersect1d(names[0], names[1])
    places = []
    for name, owner in zip(names, owners):
        place = np.minimum(np.searchsorted(shared, name), max(0, len(shared) - 1))
        keep = shared[place] == name if len(shared) else np.zeros(len(name), bool)
        order = np.argsort(place[keep], kind="stable")
        places.append((place[keep][order], owner[keep][order]))
    for low in range(0, len(shared), 4096):
        blocks = []
        for (place, owner), f in zip(places, (left, right)):
            begin, end = np.searchsorted(place, [low, low + 4096])
            block = np.zeros((len(f), 4096), np.float32)
            block[owner[begin:end], place[begin:end] - low] = 1
            blocks.append(block)
        total += blocks[0] @ blocks[1].T
    return total


def compare_relative(left: pd.DataFrame, right: pd.DataFrame, same: bool, threshold: float, steps: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that reach the threshold, by signatures and then exactly."""
    a, b = surviving_pairs(signatures_of(left), signatures_of(right), same, steps)
    if not len(a):
        return a, b
    common = common_runs(left, right)[a, b].astype(np.int64)
    union = left["n_runs"].to_numpy()[a] + right["n_runs"].to_numpy()[b] - common
    good = (common > 0) & (common >= threshold * union - 1e-9)
    return a[good], b[good]


#: What the first comparison returns: links, and of large cells the relative forms.
FOUND = "node binary, texts long, docs long, parent binary, cell binary, own long, blocks long, copies long, n_runs long, sig binary, held binary, added binary"
FOUND_NAMES = [part.split()[0] for part in FOUND.split(", ")]


def compare_block(frame: pd.DataFrame, threshold: float, steps: tuple) -> pd.DataFrame:
    """A block of a large cell: its own pairs, each member's link to the center if that is in
    another block, and the relative forms of all members."""
    center = frame.loc[frame["node"] == frame["cell"]].iloc[0]
    mine = frame[frame["own"] == frame["block"]].sort_values("node", kind="stable").reset_index(drop=True)
    mine["held"], mine["added"] = relative(mine["text"], center["text"])
    a, b = compare_relative(mine, mine, True, threshold, steps)
    counts = link_counts(mine["node"].to_numpy(), mine["copies"].to_numpy(), a, b)
    out = mine.drop(columns=["text", "block"]).merge(counts, on="node")
    if center["own"] != center["block"]:
        middle = pd.DataFrame([center])
        middle["held"], middle["added"] = relative([center["text"]], center["text"])
        a, _ = compare_relative(mine, middle.reset_index(drop=True), False, threshold, steps)
        tie = pd.DataFrame({"node": mine["node"].to_numpy()[a], "texts": 0, "docs": 0, "parent": center["node"]})
        out = pd.concat([out, tie])
    return out.reindex(columns=FOUND_NAMES)


def compare_cells(frame: pd.DataFrame, threshold: float, steps: tuple) -> pd.DataFrame:
    """The cells of a task, or one block of a large cell."""
    parts = []
    for _, part in frame.groupby(["cell", "block"], sort=False):
        large = part["blocks"].iloc[0] > 1
        parts.append(compare_block(part, threshold, steps) if large else compare_small(part, threshold, steps).reindex(columns=FOUND_NAMES))
    return pd.concat(parts)


def compare_blocks(frame: pd.DataFrame, threshold: float, steps: tuple) -> pd.DataFrame:
    """Two blocks of a cell in relative form: every text of one with every text of the other."""
    frame = frame.sort_values(["node", "side"], kind="stable").reset_index(drop=True)
    left, right = (frame[frame["side"] == side] for side in (1, 2))
    a, b = compare_relative(left.reset_index(drop=True), right.reset_index(drop=True), False, threshold, steps)
    return link_counts(frame["node"].to_numpy(), frame["copies"].to_numpy(), left.index.to_numpy()[a], right.index.to_numpy()[b])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row its id, the digest of its set of runs, of its text, the set's size and the
    MinHash values; null where the text has no word."""

    def make() -> Callable[[list], dict]:
        def run(texts: list) -> dict:
            out = {"node": [], "text_key": [], "n_runs": [], "sig": []}
            for text in texts:
                own = runs(text)
                some = len(own) > 0
                out["node"].append(xxhash.xxh3_128_digest(own.tobytes()) if some else None)
                out["text_key"].append(hashlib.md5(text.encode()).digest() if some else None)
                out["n_runs"].append(len(own))
                out["sig"].append(signature(own) if some else None)
            return out

        return run

    return over_texts(docs, id_col, text_col, make, "node binary, text_key binary, n_runs long, sig binary").withColumnRenamed(id_col, "id")


def candidate_links(classes: DataFrame, threshold: float, tolerance: float, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """(a, b) of text classes that share a band and are not dropped by their signatures,
    and for large buckets the tie of every member to the bucket's first."""
    bands = HASHES // BAND_ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.substring("sig", b * 8 + 1, F.lit(8)).alias("key")))
    member = classes.select("node", F.explode(keys).alias("k")).select("k.band", "k.key", "node")
    bucket = member.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    met = cut_lineage(member.join(bucket, ["band", "key"]))
    ties = met.where((F.col("n") > pair_bucket) & (F.col("node") != F.col("first"))).select(F.col("first").alias("a"), F.col("node").alias("b"))
    small = met.where(F.col("n") <= pair_bucket)
    left, right = small.select("band", "key", F.col("node").alias("a")), small.select("band", "key", F.col("node").alias("b"))
    pairs = left.join(right, ["band", "key"]).where("a < b").select("a", "b").distinct()
    signatures = classes.select("node", "sig")
    pairs = pairs.join(signatures.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a").join(signatures.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
    steps = least_matches(threshold, tolerance)

    def prune(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            left, right = (np.frombuffer(b"".join(frame[c]), "<u2").reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            yield frame[["a", "b"]].iloc[surviving(left, right, steps)]

    return pairs.mapInPandas(prune, "a binary, b binary").union(ties.distinct())


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE, pair_bucket: int = PAIR_BUCKET, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """Per row of ``docs``: id, class_id, n_links, n_link_texts, n_copies."""
    rows, classes = similar_classes(docs, id_col, text_col, threshold, tolerance, pair_bucket, block_texts)
    found = rows.where("node IS NOT NULL").join(classes, "node")
    alone = rows.where("node IS NULL")
    zero = F.lit(0).cast("long")
    return found.select(
        "id", "class_id", (F.col("docs") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_link_texts"), F.col("copies").alias("n_copies"),
    ).union(alone.select("id", F.col("id").alias("class_id"), zero, zero, F.lit(1).cast("long"))).withColumnRenamed("id", id_col)


def _cells_with_texts(docs: DataFrame, text_col: str, member: DataFrame, block_texts: int) -> DataFrame:
    """The members of cells with their texts, dealt to the tasks that compare them first. A
    large cell's center goes to each of its blocks."""
    cell = member.groupBy("cell").agg(F.greatest(F.ceil(F.count("*") / block_texts), F.ceil(F.sum("n_runs") / BLOCK_RUNS)).alias("blocks"))
    total = member.agg(F.sum("n_runs")).first()[0] or 0
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").groupBy(F.unhex(F.md5("text")).alias("text_key")).agg(F.first("text").alias("text"))
    full = member.join(cell, "cell").join(texts, "text_key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    large = F.col("blocks") > 1
    block = F.when(large & (F.col("node") == F.col("cell")), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("own"))
    full = full.withColumn("block", F.explode(block))
    task = F.when(large, F.xxhash64("cell", "block")).otherwise(F.pmod(F.xxhash64("cell"), F.lit(max(1, total // TASK_RUNS))))
    return full.select(task.alias("task"), "cell", "blocks", "own", "block", "node", "copies", "n_runs", "sig", "text")


def _meet(left: DataFrame, right: DataFrame, threshold: float, steps: tuple) -> DataFrame:
    """Compares the rows of ``left`` and ``right`` (relative forms with cell, i and j) that have the same cell, i and j."""
    columns = ["cell", "i", "j", "node", "copies", "n_runs", "sig", "held", "added"]
    both = left.select(F.lit(1).alias("side"), *columns).union(right.select(F.lit(2), *columns))
    return both.groupBy("cell", "i", "j").applyInPandas(lambda frame: compare_blocks(frame, threshold, steps), "node binary, texts long, docs long, parent binary")


def _up_to(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _all_blocks(forms: DataFrame, threshold: float, steps: tuple) -> DataFrame:
    """Links between the members of different blocks of the same cell."""
    other = forms.withColumn("other", _up_to(F.col("blocks")))
    ends = {"i": F.least("own", "other"), "j": F.greatest("own", "other")}
    return _meet(other.where("own < other").withColumns(ends), other.where("own > other").withColumns(ends), threshold, steps)


def _rest_of_cells(forms: DataFrame, roots: DataFrame, block_texts: int, threshold: float, steps: tuple) -> DataFrame | None:
    """Links of the members outside their cell's largest class so far to all other members."""
    rooted = forms.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("cell", "root").agg(F.count("*").alias("n"), F.sum("n_runs").alias("n_runs"))
    largest = sizes.groupBy("cell").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"), F.sum("n_runs").alias("runs"))
    cell = cut_lineage(largest.where(F.col("all") > F.col("most")).withColumn("parts", F.greatest(F.ceil((F.col("all") - F.col("most")) / block_texts), F.ceil(F.col("runs") / BLOCK_RUNS))))
    if cell.isEmpty():
        return None
    rooted = rooted.join(cell.select("cell", "largest", "parts"), "cell")
    rest = rooted.where(F.col("root") != F.col("largest")).withColumns({"i": F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")), "j": _up_to(F.col("blocks"))})
    return _meet(rest, rooted.withColumns({"i": _up_to(F.col("parts")), "j": F.col("own")}), threshold, steps)


def similar_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, pair_bucket: int = PAIR_BUCKET, block_texts: int = BLOCK_TEXTS, links: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): per row its id, text class (node) and text digest; per text class its
    copies, linked texts and documents, root, and the smallest id of all linked documents.
    Without ``links`` the numbers of links are not complete, but classes are."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col))
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id"), F.min("text_key").alias("text_key"), F.max("n_runs").alias("n_runs"), F.min("sig").alias("sig"),
    )
    classes = cut_lineage(classes)
    cells = components(candidate_links(classes, threshold, tolerance, pair_bucket))
    member = cut_lineage(classes.join(cells.withColumnRenamed("root", "cell"), "node"))
    steps = least_matches(threshold, tolerance)
    dealt = _cells_with_texts(docs, text_col, member, block_texts)
    found = cut_lineage(dealt.groupBy("task").applyInPandas(lambda frame: compare_cells(frame, threshold, steps), FOUND))
    forms = found.where("held IS NOT NULL")
    ties = lambda df: df.where("node != parent").select(F.col("node").alias("a"), F.col("parent").alias("b"))
    counts, tied = found.select("node", "texts", "docs"), ties(found)
    if not forms.isEmpty():
        more = _all_blocks(forms, threshold, steps) if links else _rest_of_cells(forms, components(tied), block_texts, threshold, steps)
        if more is not None:
            more = cut_lineage(more)
            counts, tied = counts.union(more.select("node", "texts", "docs")), tied.union(ties(more))
    counts = counts.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    roots = components(tied)
    whole = classes.join(counts, "node", "left").join(roots, "node", "left").select(
        "node", "text_key", "copies", "least_id", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("root", "node").alias("root"),
    )
    whole = cut_lineage(whole)
    least = whole.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return rows, whole.join(least, "root")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """The documents, with all columns, but of each class of linked documents only one: the
    one with the smallest id, and of equal ids the one with the smallest text digest. Rows
    without a word stay. Rows with equal id and text are the same document. Names of columns
    do not matter: they travel as one struct."""
    rows, classes = similar_classes(docs, id_col, text_col, threshold, block_texts=block_texts, links=False)
    best = rows.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("best"))
    chosen = best.join(classes.select("node", "root"), "node").groupBy("root").agg(F.min("best").alias("best")).select("best.id", "best.text_key")
    again = rows.groupBy("id", "text_key").agg(F.count("*").alias("same"))
    chosen = cut_lineage(chosen.join(again, chosen["id"].eqNullSafe(again["id"]) & (chosen["text_key"] == again["text_key"])).select(
        chosen["id"].alias("chosen_id"), chosen["text_key"].alias("chosen_key"), (F.col("same") > 1).alias("again")))
    text = F.col(f"`{text_col}`").cast("string")
    blank = text.isNull() | ~text.rlike(r"(?U)[^\s\x1c-\x1f]")
    keyed = docs.select(F.col(f"`{id_col}`").alias("own_id"), F.unhex(F.md5(text)).alias("own_key"), blank.alias("blank"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = keyed.where("NOT blank").join(chosen, F.col("own_key").eqNullSafe(F.col("chosen_key")) & F.col("own_id").eqNullSafe(F.col("chosen_id")))
    single = kept.where("NOT again").select("row.*")
    if not chosen.where("again").isEmpty():
        single = single.union(kept.where("again").groupBy("own_id", "own_key").agg(F.first("row").alias("row")).select("row.*"))
    return single.union(keyed.where("blank").select("row.*"))
