"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are its words and the shapes of its tokens (upper, lower, digits and signs,
runs made one), hashed into buckets, and a few terms for its length, repeated tokens and
repeated lines. Labelled documents give term weights (log counts, inverse document frequency)
and, by a truncated singular value decomposition, a space of ``DIMENSIONS``. The labelled
vectors go to the tasks; every document's cosine with every one of them is computed, in
blocks, and its ``NEIGHBOURS`` nearest vote with weights that grow with their similarity.
Votes are scaled by class so that the score follows the labels' own shares.

The fit uses about ``SAMPLE_DOCS`` labelled documents per class, chosen by a hash of the id,
which bounds what is broadcast; scoring reads every text whole. A token of more than
``PIECE_CHARS`` characters counts as several, its consecutive pieces of that length; a shape
of more than ``SHAPE_RUNS`` runs gives a term for each so many of them.

Defined cases: null counts as empty; a text whose terms no labelled document has gets the
share of label 1; so do all without labels of both classes (0.5 without any); equal
similarities are ordered by the labelled documents' order; an id is of label 1 if most of
its label rows are; repeated rows give one row each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .base import over_texts, ship
from .samples import per_class

ship(__name__)

SAMPLE_DOCS, DIMENSIONS, NEIGHBOURS = 1500, 64, 25
WORD_BUCKETS, SHAPE_BUCKETS, OTHER_BUCKETS = 2048, 1024, 128
SHAPE_WEIGHT, SIMILARITY_POWER = 2.0, 8.0
THRESHOLD = 0.7
MEMO_TOKENS = 200_000
PIECE_CHARS, SHAPE_RUNS = 64, 8
LETTERS = re.compile(r"[^\W\d_]+")
RUNS = re.compile(r"(.)\1+", re.S)


def split(text: str) -> list[str]:
    """The text's tokens, long ones in pieces."""
    tokens = text.split()
    if not tokens or max(map(len, tokens)) <= PIECE_CHARS:
        return tokens
    return [token[k:k + PIECE_CHARS] for token in tokens for k in range(0, len(token), PIECE_CHARS)]


def shapes(token: str) -> list[str]:
    kinds = RUNS.sub(r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdecimal() else c for c in token))
    return [kinds[k:k + SHAPE_RUNS] for k in range(0, len(kinds), SHAPE_RUNS)]


class Terms:
    """Sparse term counts of a text: (buckets, weights)."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}
        self.more: dict[str, list[int]] = {}  # shape buckets behind the first

    def token(self, token: str) -> int:
        core = "".join(LETTERS.findall(token.lower()))
        word = crc32(core.encode()) % WORD_BUCKETS
        first, *more = (crc32(part.encode()) % SHAPE_BUCKETS for part in shapes(token))
        if more:
            self.more[token] = more
        return word * SHAPE_BUCKETS + first

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = split(text or "")
        unknown = {t for t in tokens if t not in self.memo}
        if len(self.memo) + len(unknown) > MEMO_TOKENS:
            self.memo, self.more, unknown = {}, {}, set(tokens)
        for t in unknown:
            self.memo[t] = self.token(t)
        codes = np.fromiter(map(self.memo.__getitem__, tokens), np.int64, len(tokens))
        more = [bucket for t in tokens if t in self.more for bucket in self.more[t]] if self.more else []
        lines = [line for line in (text or "").split("\n") if line.strip()]
        same = float((codes[1:] == codes[:-1]).mean()) if len(codes) > 1 else 0.0
        again = 1 - len(set(lines)) / len(lines) if lines else 0.0
        varied = len(unknown | set(tokens)) / len(tokens) if tokens else 0.0
        base = WORD_BUCKETS + SHAPE_BUCKETS
        other = [base + len(tokens).bit_length(), base + 40 + int(10 * same), base + 60 + int(10 * again), base + 80 + int(10 * varied)]
        buckets, counts = np.unique(np.concatenate([codes // SHAPE_BUCKETS, WORD_BUCKETS + codes % SHAPE_BUCKETS, WORD_BUCKETS + np.array(more, np.int64), np.array(other)]), return_counts=True)
        weights = 1 + np.log(counts)
        weights[buckets >= WORD_BUCKETS] *= SHAPE_WEIGHT
        weights[buckets >= base] *= np.sqrt(1 + len(codes)) / 4  # as heavy as a share of the words
        return buckets, weights


def weighted(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    matrix = np.zeros((len(rows), len(idf)), np.float32)
    for k, (buckets, weights) in enumerate(rows):
        matrix[k, buckets] = weights * idf[buckets]
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms > 0, norms, 1)


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 1e-6, norms, np.inf)).astype(np.float32)


def latent_space(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    width = min(dimensions + 10, *matrix.shape)
    basis = np.linalg.qr(matrix.T @ np.random.default_rng(3).standard_normal((matrix.shape[0], width)).astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :dimensions].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out_of: int = 4, held_out: int = 2, sample_docs: int = SAMPLE_DOCS) -> dict:
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % held_out_of != held_out))
    usable = usable.groupBy(F.col(id_col).alias("key")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    chosen, counts = per_class(usable, "label", F.col("key"), sample_docs)
    total = sum(counts.values())
    model: dict = {"share": counts.get(1, 0) / total if total else 0.5, "space": None}
    if len(counts) < 2:
        return model
    narrow = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    sample = narrow.join(F.broadcast(chosen), "key").select(F.struct("key", "label").alias("id"), "text")

    def make() -> Callable[[list], dict]:
        terms = Terms()

        def run(texts: list) -> dict:
            found = [terms(text) for text in texts]
            return {"buckets": [b.tolist() for b, _ in found], "weights": [w.tolist() for _, w in found]}

        return run

    rows = over_texts(sample.select(F.to_json("id").alias("id"), "text"), "id", "text", make, "buckets array<int>, weights array<double>")
    rows = rows.withColumn("label", F.get_json_object("id", "$.label").cast("int")).orderBy("id").collect()
    vectors = [(np.array(r["buckets"]), np.array(r["weights"])) for r in rows]
    y = np.array([r["label"] for r in rows])
    if not 0 < y.sum() < len(y):
        return model
    seen = np.bincount(np.concatenate([b for b, _ in vectors]), minlength=WORD_BUCKETS + SHAPE_BUCKETS + OTHER_BUCKETS)
    idf = np.where(seen > 0, np.log(1 + len(rows) / np.maximum(seen, 1)), 0.0).astype(np.float32)
    matrix = weighted(vectors, idf)
    space = latent_space(matrix, DIMENSIONS)
    scale = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    return model | {"space": space, "idf": idf, "vectors": unit(matrix @ space), "labels": y, "scale": scale / scale.mean()}


def vote(vectors: np.ndarray, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of unit vectors: cosine with every labelled vector, the nearest weighted."""
    cosines = vectors @ model["vectors"].T
    count = min(neighbours, cosines.shape[1])
    nearest = np.sort(np.argpartition(-cosines, count - 1, axis=1)[:, :count], axis=1)
    similarity = np.clip(np.take_along_axis(cosines, nearest, axis=1), 0, 1).astype(float) ** SIMILARITY_POWER * model["scale"][nearest]
    total = similarity.sum(axis=1)
    for_one = (similarity * model["labels"][nearest]).sum(axis=1)
    share = model["share"]
    return np.clip((for_one + 1e-3 * share) / (total + 1e-3), 0, 1)


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, score, predicted."""
    if model["space"] is None:
        share = F.lit(float(model["share"]))
        return docs.select(id_col, share.alias("score"), (share >= threshold).cast("int").alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list], dict]:
        terms, own = Terms(), sent.value

        def run(texts: list) -> dict:
            scores = vote(unit(weighted([terms(text) for text in texts], own["idf"]) @ own["space"]), own)
            return {"score": scores.tolist(), "predicted": (scores >= threshold).astype(int).tolist()}

        return run

    return over_texts(docs, id_col, text_col, make, "score double, predicted int")
