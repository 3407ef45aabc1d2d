"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is
read in windows of about 48 bytes that begin and end at words and overlap by half, and each
window is compressed with both. What the toxic dictionary saves is the window's margin; the
numbers of windows whose margin reaches each of a row of thresholds, and the largest margin,
go through a logistic calibration fitted on labelled documents that the dictionaries have
not seen.

Labels mark documents, while few of a toxic document's words are toxic. What counts as toxic
text is therefore what the labelled documents say in words that are far more frequent, by
document, among toxic ones (log-likelihood ratio, tested with a correction for the number of
words, so a rare word counts whatever the ratios of others are). The words of all windows of
all sampled documents are counted in Spark. The toxic dictionary is trained on the toxic
documents' *toxic excerpts*, those words in the order in which a document first has them; the
ordinary one on windows of ordinary documents. Both share the ordinary training result as
their nearer part, so that an ordinary window compresses alike with both and its margin stays
near zero. They are used as raw content: windows are too short for stored entropy tables to
pay.

The fit uses a sample of labelled documents of about ``SAMPLE_DOCS`` per class (chosen by a
hash of the id), whole, and about ``ORDINARY_WINDOWS`` of the ordinary ones' windows, chosen
by a hash among all of them. Copies count once (of a toxic and an ordinary copy the toxic one),
and a word counts once per label in a group of near copies. Scoring reads every text whole.

Defined cases: null and empty texts have no window and get the score of a text without any
margin; without labels of both classes the score is the share of toxic labels (0 if there
are none); repeated rows and ids give one row each; other columns are not touched. A label
counts as toxic for an id if any of its rows says so.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .base import filter_rows, over_texts, ship
from .samples import turn

ship(__name__)

SAMPLE_DOCS, ORDINARY_WINDOWS = 2000, 40_000
WINDOW, ORDINARY_BYTES, TOXIC_BYTES = 48, 32768, 8192
#: Lengths of the segments and of the strings by which training picks the toxic dictionary's content.
SEGMENT_BYTES, STRING_BYTES = 48, 8
#: A word is taken as toxic from this log-likelihood ratio on, if chance gives less than so many such words among all that are tested.
LEAST_RATIO, FALSE_WORDS = 15.0, 0.01
#: Near copies are found by least hashes of their five-word runs: those that share all values of a band.
BANDS, BAND_VALUES = 12, 4
MARGINS = (1, 2, 3, 4, 5, 6, 8)
THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_]+")


def windows(text: str | None, step: int = WINDOW // 2) -> Iterator[bytes]:
    """Windows of the lower-cased text that begin and end at spaces, about ``step`` apart."""
    data = b" " + b" ".join((text or "").lower().encode().split()) + b" "
    at, last = 0, len(data) - 1
    while last > 0:
        if at + WINDOW >= last:
            yield data[at:]
            return
        yield data[at:data.find(b" ", at + WINDOW) + 1]
        at = data.find(b" ", at + step)
        if at >= last:
            return


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(
        13, source_size=WINDOW, dict_size=len(content), min_match=4, search_log=8, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=how)


class Margins:
    """A text's features: windows by margin, the largest margin, the number of windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = compressor(ordinary).compress, compressor(toxic).compress

    def __call__(self, text: str | None) -> list[float]:
        ordinary, toxic = self.ordinary, self.toxic
        seen = Counter(len(ordinary(window)) - len(toxic(window)) for window in windows(text))
        counts = [math.log1p(sum(n for margin, n in seen.items() if margin >= least)) for least in MARGINS]
        return [*counts, float(max(0, *seen, 0)), math.log1p(seen.total())]


def words_of(text: str) -> list[str]:
    """The words of all windows, in the order in which the text first has them."""
    return list(dict.fromkeys(w for window in windows(text) for w in WORD.findall(window.decode())))


def toxic_words(words: DataFrame) -> list[str]:
    """Words that speak clearly for the toxic class, from rows (label, near_group, word) of
    documents; a group's documents count as one per label."""
    once = words.distinct()
    sizes = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count_distinct("near_group").alias("n")).collect()}
    ordinary, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not ordinary or not toxic:
        return []
    share, a, b = toxic / (ordinary + toxic), F.col("a"), F.col("b")
    counts = once.groupBy("word").agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("b")).where("a > 0")
    of_ordinary = F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
    counts = cut_lineage(counts.withColumn("ratio", 2 * (a * F.log(a / ((a + b) * share)) + of_ordinary)))
    chance = FALSE_WORDS / max(1, counts.count())
    likely = counts.where((a * ordinary > 2 * b * toxic) & (F.col("ratio") >= LEAST_RATIO)).select("word", "ratio").collect()
    return sorted(r["word"] for r in likely if math.erfc(math.sqrt(r["ratio"] / 2)) <= chance)


def trained(samples: list[bytes], size: int, **how: int) -> bytes:
    """The content of a dictionary trained on the samples; with too few of them for
    training, the distinct samples themselves."""
    # By default training reads the first three quarters only, and the samples are in order: the last words would be lost.
    try:
        learned = zstandard.train_dictionary(size, samples, split_point=1.0, **how).as_bytes()
    except zstandard.ZstdError:
        learned = b""
    return learned or b"".join(dict.fromkeys(samples))[-size:]


def dictionaries(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary, from ordinary windows and toxic excerpts."""
    base = trained(ordinary, ORDINARY_BYTES)
    return base, trained(toxic, TOXIC_BYTES, k=SEGMENT_BYTES, d=STRING_BYTES) + base


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def near_copy_key(text: str) -> int:
    """The least hash of the text's five-word runs, which near copies mostly share."""
    words = text.lower().split()
    return min(crc32(" ".join(words[k:k + 5]).encode()) for k in range(max(1, len(words) - 4)))


def bands(text: str) -> list[str]:
    """Least hashes of the text's five-word runs, in bands; near copies share a band."""
    words = text.lower().split()
    runs = np.array([crc32(" ".join(words[k:k + 5]).encode()) for k in range(max(1, len(words) - 4))], np.uint64)
    dealt = np.random.default_rng(9)
    least = []
    for times, plus in dealt.integers(1, 1 << 31, (BANDS * BAND_VALUES, 2), np.uint64):
        least.append(int(((runs * times + plus) % np.uint64((1 << 31) - 1)).min()))
    return [f"{k}:{least[k * BAND_VALUES:(k + 1) * BAND_VALUES]}" for k in range(BANDS)]


def copy_groups(signatures: list[list[str]]) -> list[int]:
    """A group number per signature; those that share a band, also by way of others, are in one group."""
    parent = list(range(len(signatures)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    first: dict[str, int] = {}
    for k, signature in enumerate(signatures):
        for band in signature:
            parent[root(k)] = root(first.setdefault(band, k))
    return [root(k) for k in range(len(signatures))]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_of: int = 5, held_out: int = 0, sample_docs: int = SAMPLE_DOCS) -> dict:
    """The two dictionaries and the calibration, from labelled rows that are not held out."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).where(F.crc32(F.col(id_col).cast("string").cast("binary")) % held_out_of != held_out)
    usable = usable.groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).alias("label"))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ordinary, toxic = counts.get(0, 0), counts.get(1, 0)
    model = {"share": toxic / max(1, ordinary + toxic), "weights": None}
    if not ordinary or not toxic:
        return model
    chosen = usable.where(turn(F.col("key")) < F.when(F.col("label") == 1, sample_docs / toxic).otherwise(sample_docs / ordinary))
    narrow = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    # The sample is small, so as many parts as there are cores do: every task with Python beyond
    # them is one more worker process beside the others on its executor.
    parts = docs.sparkSession.sparkContext.defaultParallelism
    sample = cut_lineage(narrow.join(F.broadcast(chosen), "key").withColumn("third", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(3))).repartition(parts))

    def signatures() -> Callable[[list, list], dict]:
        return lambda texts, _: {"near": [near_copy_key(t) for t in texts], "bands": [bands(t) for t in texts], "words": [words_of(t) for t in texts], "body": texts}

    first = over_texts(sample.where("third > 0"), "label", "text", signatures, "near long, bands array<string>, words array<string>, body string", "key")
    # of copies the toxic one, and of those one that does not depend on the order of rows
    one = F.min_by(F.struct("label", "bands", "words", "body"), F.struct(-F.col("label"), F.md5("body")))
    taken = cut_lineage(first.groupBy("near").agg(one.alias("d")).select("near", "d.*").repartition(parts))
    rows = taken.select("near", "bands").orderBy("near").collect()
    groups = taken.sparkSession.createDataFrame(list(zip([r["near"] for r in rows], copy_groups([r["bands"] for r in rows]))), "near long, near_group long")
    chosen_words = toxic_words(taken.join(F.broadcast(groups), "near").select("label", "near_group", F.explode("words").alias("word")))
    known = set(chosen_words)

    def excerpts() -> Callable[[list], dict]:
        return lambda texts: {"excerpt": [f" {' '.join(w for w in words_of(t) if w in known)} ".encode() for t in texts]}

    said = over_texts(taken.where("label = 1"), "near", "body", excerpts, "excerpt binary").where(F.length("excerpt") > 2).orderBy("excerpt")

    def cut() -> Callable[[list], dict]:
        return lambda texts: {"windows": [list(windows(t, WINDOW)) for t in texts]}

    plain = cut_lineage(over_texts(taken.where("label = 0"), "near", "body", cut, "windows array<binary>").select("near", F.posexplode("windows").alias("at", "window")))
    some = plain.where(turn(F.col("near"), F.col("at")) < ORDINARY_WINDOWS / max(1, plain.count())).orderBy("near", "at")
    model["ordinary"], model["toxic"] = dictionaries([bytes(r["window"]) for r in some.select("window").collect()], [bytes(r["excerpt"]) for r in said.collect()])
    measured = sorted(features(sample.where("third = 0"), model, "label", "text").collect(), key=lambda r: (r["label"], r["features"]))
    y = np.array([r["label"] for r in measured], float)
    if 0 < y.sum() < len(y):
        weights = logistic(np.array([r["features"] for r in measured]), y)
        weights[-1] += math.log(toxic / ordinary) - math.log(y.sum() / (len(y) - y.sum()))
        model["weights"] = weights.tolist()
    return model


def features(docs: DataFrame, model: dict, id_col: str, text_col: str) -> DataFrame:
    ordinary, toxic = model["ordinary"], model["toxic"]

    def make() -> Callable[[list], dict]:
        measure = Margins(ordinary, toxic)
        return lambda texts: {"features": [measure(text) for text in texts]}

    return over_texts(docs, id_col, text_col, make, "features array<double>")


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, score between 0 and 1, predicted 0 or 1, for every row."""
    if not model["weights"]:
        share = F.lit(float(model["share"]))
        return docs.select(F.col(id_col), share.alias("score"), (share >= threshold).cast("int").alias("predicted"))
    *weights, intercept = model["weights"]
    parts = [F.col("features")[k] * F.lit(float(w)) for k, w in enumerate(weights)]
    score = 1 / (1 + F.exp(-(sum(parts[1:], parts[0]) + F.lit(float(intercept)))))
    return features(docs, model, id_col, text_col).select(F.col(id_col), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all columns, whose score stays below the threshold."""
    if not model["weights"]:
        return docs if model["share"] < threshold else docs.limit(0)
    ordinary, toxic, weights = model["ordinary"], model["toxic"], np.array(model["weights"])
    least = math.log(threshold / (1 - threshold))

    def make() -> Callable[[list], list]:
        measure = Margins(ordinary, toxic)
        return lambda texts: [float(np.dot(weights[:-1], measure(text)) + weights[-1]) < least for text in texts]

    return filter_rows(docs, text_col, make)
