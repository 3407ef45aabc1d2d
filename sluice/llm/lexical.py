"""Ranked lexical search over impact vectors in norm buckets.

A document's impact vector has, for each term of the queries that it holds, the term's
saturated frequency as a whole number; a query's vector has the terms' weights. The score is
their inner product, and only the ``top`` best documents of a query are wanted. Following
LEMP, documents are ordered by the length of their vectors, longest first, and cut into
buckets of similar length. A bucket whose longest vector times the query's length stays
below the query's threshold is left out, with all that follow (Cauchy-Schwarz). In a bucket
that stays, the query's heaviest coordinates are multiplied first, and the product of the
remaining lengths bounds the rest:

    score <= sum over heavy terms + |rest of query| * |rest of document|

Only documents whose bound reaches the threshold are scored, exactly, in whole numbers.
Bounds get a margin above all rounding, and documents are left out below the threshold only,
never at it, so the result is that of scoring everything.

Length classes are global: one pass over the classes' counts finds the classes that hold
the longest vectors; these are searched first, and each query's worst result so far is the
threshold with which all other classes are searched, beside what a task finds itself.
Documents are never grouped by term, class or query: every task searches the rows it has,
and returns at most ``top`` rows for each query.

Tables: terms of each document (query terms only) and impact vectors, both in the shared
folder, removed when the result is there. Queries are taken in blocks of bounded text, each
with passes of its own.

Defined cases: null texts and texts without a term are no documents; queries without a term
have no results; documents that share no term with a query, or only terms of weight 0, are
no results; equal scores go by id, null ids first; documents with equal ids are ranked each
on its own, and so are repeated queries; an empty table gives no rows; texts of any length
are read in segments; other columns are not touched. Document ids must be integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from ..session import cut_lineage, remove_path, scratch_path
from .base import pieces, ship

ship(__name__)

TOP = 50
#: Fixed values of the score: scale of weights, share of the mean length (in hundredths) and saturation.
SCALE, LENGTH_SHARE, IMPACT = 1000, 50, 1_000_000_000
#: Text of the queries that are searched together.
QUERY_BLOCK_BYTES = 4_000_000
#: Ratio of lengths within a class or bucket, and the least rows of a bucket.
RATIO, BUCKET_ROWS = 0.9, 256
#: Rows that a task sorts and searches at once; vectors of the first round.
BLOCK_ROWS, FIRST_ROWS = 4096, 4096
#: Share of a query's squared length that the terms multiplied first have.
HEAVY = 0.6
SEGMENT_BYTES = 4_000_000
#: Bytes that are no part of a term become spaces, A-Z become a-z.
TO_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, segment by segment."""
    raw = text.encode().translate(TO_TERMS) if text else b""
    at = 0
    while len(raw) - at > SEGMENT_BYTES:
        border = raw.find(b" ", at + SEGMENT_BYTES)
        if border < 0:
            break
        yield raw[at:border].split()
        at = border
    yield raw[at:].split()


@dataclass(frozen=True)
class Queries:
    """A block of queries over a vocabulary of its own."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]

    @staticmethod
    def of(texts: list) -> Queries:
        vocabulary: dict[bytes, int] = {}
        own = [sorted({vocabulary.setdefault(t, len(vocabulary)) for part in terms_of(text) for t in part}) for text in texts]
        return Queries(vocabulary, [np.array(o, np.int64) for o in own])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all rows of a binary column, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4").astype(np.int64), np.array([len(r) // 4 for r in rows], np.int64)


def as_binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    raw = values.astype("<u4").tobytes()
    ends = 4 * np.cumsum(lengths)
    return pa.array([raw[a:b] for a, b in zip((ends - 4 * lengths).tolist(), ends.tolist())], pa.binary())


def count_terms(docs: DataFrame, queries: Queries, id_col: str, text_col: str) -> DataFrame:
    """Per document with a term: id, n (its terms), and the query terms it has with their counts."""
    vocabulary = queries.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sizes, keys = [], []
            for row, text in enumerate(piece.column(1).to_pylist()):
                n = 0
                for part in terms_of(text):
                    n += len(part)
                    found = np.array([t for t in map(vocabulary.get, part) if t is not None], np.int64)
                    keys.append(found + row * len(vocabulary))
                sizes.append(n)
            key, tf = np.unique(np.concatenate([*keys, np.empty(0, np.int64)]), return_counts=True)
            row, term = np.divmod(key, max(1, len(vocabulary)))
            lengths = np.bincount(row, minlength=piece.num_rows)
            out = [piece.column(0), pa.array(sizes, pa.int64()), as_binary(term, lengths), as_binary(tf, lengths)]
            batch = pa.RecordBatch.from_arrays(out, names=["id", "n", "terms", "tf"])
            yield batch.filter(pa.array(np.array(sizes, np.int64) > 0))

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, n long, terms binary, tf binary")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many documents each query term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(numbers(batch.column(0))[0], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])

    found = np.zeros(size, np.int64)
    for row in counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        found[row["term"]] = row["df"]
    return found


def impact_vectors(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """id, length and its class, terms and impacts of all documents with a query term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, lengths = numbers(batch.column(2))
            tf, _ = numbers(batch.column(3))
            mean_share = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            impact = IMPACT * tf // (1000 * tf + 20 * np.repeat(mean_share, lengths))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, batch.num_rows))
            with np.errstate(divide="ignore"):
                klass = np.floor(np.log(norm) / -math.log(RATIO))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), pa.array(np.where(norm > 0, klass, -1).astype(np.int32)), batch.column(2), as_binary(impact, lengths)],
                names=["id", "norm", "klass", "terms", "impacts"],
            )
            yield out.filter(pa.array(norm > 0))

    return counted.mapInArrow(run, "id long, norm double, klass int, terms binary, impacts binary").sortWithinPartitions(F.col("norm").desc())


class Bucket:
    """Documents of similar length: their postings by term."""

    def __init__(self, term: np.ndarray, row: np.ndarray, impact: np.ndarray, norm: np.ndarray, ids: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.row, self.impact, self.norm, self.ids = row[order], impact[order], norm, ids
        self.term, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.squares = norm**2

    def postings(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, impact and the query's weight of all entries of the terms."""
        at = np.searchsorted(self.term, terms)
        here = at < len(self.term)
        here[here] = self.term[at[here]] == terms[here]
        starts, ends = self.starts[at[here]], self.ends[at[here]]
        lengths = ends - starts
        total = int(lengths.sum())
        places = np.arange(total) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        return self.row[places], self.impact[places], np.repeat(weights[here], lengths)


class Search:
    """The best documents of each query among those a task has seen."""

    def __init__(self, queries: list[np.ndarray], weights: np.ndarray, thresholds: np.ndarray, top: int):
        self.top, self.parts, self.norms = top, [], []
        self.thresholds = thresholds.astype(np.int64).copy()
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
        self.scored = self.bounded = 0
        for terms in queries:
            own = weights[terms]
            order = np.argsort(-own, kind="stable")
            terms, own = terms[order], own[order]
            squares = np.cumsum(own.astype(float) ** 2)
            total = squares[-1] if len(squares) else 0.0
            heavy = int(np.searchsorted(squares, HEAVY * total)) + 1
            rest = math.sqrt(max(0.0, total - squares[min(heavy, len(squares)) - 1])) if len(squares) else 0.0
            self.parts.append((terms, own, heavy, rest))
            self.norms.append(math.sqrt(total))

    def add_block(self, block: pa.RecordBatch) -> None:
        """Cuts a block of vectors, longest first, into buckets and searches them."""
        norm = block.column(1).to_numpy()
        order = np.argsort(-norm, kind="stable")
        block = block.take(pa.array(order))
        norm, ids = norm[order], block.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
        term, lengths = numbers(block.column(2))
        impact, _ = numbers(block.column(3))
        ends = np.cumsum(lengths)
        waiting, at = list(range(len(self.parts))), 0
        while at < len(norm) and waiting:
            # a bucket ends where lengths fall below RATIO of its first, and has BUCKET_ROWS rows at least
            stop = max(at + BUCKET_ROWS, int(np.searchsorted(-norm, -RATIO * norm[at], "right")))
            stop = min(stop, len(norm))
            waiting = [q for q in waiting if self.norms[q] * norm[at] * (1 + 1e-9) + 1 >= self.thresholds[q]]
            low, high = int(ends[at] - lengths[at]), int(ends[stop - 1])
            if waiting:
                row = np.repeat(np.arange(stop - at), lengths[at:stop])
                bucket = Bucket(term[low:high], row, impact[low:high], norm[at:stop], ids[at:stop])
                for q in waiting:
                    self._search(q, bucket)
            at = stop

    def _search(self, q: int, bucket: Bucket) -> None:
        terms, weights, heavy, rest = self.parts[q]
        size, threshold = len(bucket.norm), self.thresholds[q]
        row, impact, weight = bucket.postings(terms[:heavy], weights[:heavy])
        first = np.bincount(row, impact * weight, size)
        left = bucket.squares - np.bincount(row, impact.astype(float) ** 2, size)
        bound = first + rest * np.sqrt(np.maximum(left, 0) + 1e-9 * bucket.squares)
        possible = bound * (1 + 1e-9) + 1 >= threshold
        self.bounded += size
        if not possible.any():
            return
        row, impact, weight = bucket.postings(terms, weights)
        keep = possible[row]
        score = np.zeros(size, np.int64)
        np.add.at(score, row[keep], impact[keep] * weight[keep])
        self.scored += int(possible.sum())
        good = np.flatnonzero((score > 0) & (score >= threshold) & possible)
        if len(good):
            self._keep(q, score[good], bucket.ids[good])

    def _keep(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.found[q][0], score]), np.concatenate([self.found[q][1], ids])
        best = np.lexsort((ids, -score))[:self.top]
        self.found[q] = score[best], ids[best]
        if len(best) == self.top:
            self.thresholds[q] = max(self.thresholds[q], score[best[-1]])

    def rows(self) -> pa.RecordBatch:
        query = np.repeat(np.arange(len(self.found)), [len(s) for s, _ in self.found])
        score, ids = (np.concatenate([np.empty(0, np.int64), *(f[k] for f in self.found)]) for k in (0, 1))
        doc = pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).min)
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), doc, pa.array(score)], names=["query", "id", "score"])


def search(vectors: DataFrame, queries: Queries, weights: np.ndarray, thresholds: np.ndarray, top: int) -> DataFrame:
    """query, id, score: what every task finds, at most ``top`` rows of each query."""
    terms = queries.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting, rows = Search(terms, weights, thresholds, top), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                waiting.append(batch.slice(at, BLOCK_ROWS))
                rows += waiting[-1].num_rows
                if rows >= BLOCK_ROWS:
                    found.add_block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, rows = [], 0
        if rows:
            found.add_block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
        yield found.rows()

    return vectors.select("id", "norm", "terms", "impacts").mapInArrow(run, "query int, id long, score long")


def best(found: DataFrame, top: int, salts: int = 32) -> DataFrame:
    """The ``top`` rows of each query with their ranks, over parts of its rows first."""
    order = (F.col("score").desc(), F.col("id").asc_nulls_first())
    parts = Window.partitionBy("query", F.pmod(F.xxhash64("id", "score"), F.lit(salts))).orderBy(*order)
    some = found.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[Row], id_col: str, text_col: str, top: int) -> DataFrame | None:
    spark, queries = docs.sparkSession, Queries.of([item["text"] for item in items])
    path = scratch_path(spark, "lexical")
    count_terms(docs, queries, id_col, text_col).write.parquet(f"{path}/terms")
    counted = spark.read.schema("id long, n long, terms binary, tf binary").parquet(f"{path}/terms")
    sums = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = sums["docs"], sums["terms"]
    if not n_docs:
        remove_path(spark, path)
        return None
    df = document_frequencies(counted, len(queries.vocabulary))
    weights = np.array([math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    impact_vectors(counted, n_docs, n_terms).write.parquet(f"{path}/vectors")
    vectors = spark.read.schema("id long, norm double, klass int, terms binary, impacts binary").parquet(f"{path}/vectors")
    classes = sorted(((r["klass"], r["count"]) for r in vectors.groupBy("klass").count().collect()), reverse=True)
    border, rows = 0, 0
    for border, count in classes:
        rows += count
        if rows >= FIRST_ROWS:
            break
    first = cut_lineage(best(search(vectors.where(F.col("klass") >= border), queries, weights, np.zeros(len(items), np.int64), top), top))
    thresholds = np.zeros(len(items), np.int64)
    for row in first.where(F.col("rank") == top).collect():
        thresholds[row["query"]] = row["score"]
    norms = np.array([math.sqrt(float((weights[t].astype(float) ** 2).sum())) for t in queries.terms])
    reach = min([float(t / n) for t, n in zip(thresholds, norms) if n > 0], default=0.0) * (1 - 1e-9) - 1
    others = search(vectors.where((F.col("klass") < border) & (F.col("norm") >= reach)), queries, weights, thresholds, top)
    names = spark.createDataFrame([(k, item["item_id"]) for k, item in enumerate(items)], f"query int, item_id {items[0]['kind']}")
    ranked = best(first.select("query", "id", "score").union(others), top)
    out = cut_lineage(ranked.join(F.broadcast(names), "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    remove_path(spark, path)
    return out


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """Per item its ``top`` documents: item_id, rank, doc_id, score."""
    spark: SparkSession = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    narrow = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"), F.lit(kind).alias("kind"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    dealt = narrow.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    found = [_search_block(docs, dealt.where(F.col("block") == k).collect(), id_col, text_col, top) for k in range(blocks)]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in found:
        out = out.union(part) if part is not None else out
    return out


def ranks_sql(top: int = TOP) -> str:
    """The same in DuckDB: every score, no bounds."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = lambda name, key: f"SELECT {key}, regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM {name} WHERE text IS NOT NULL"
    return (
        f"WITH d AS MATERIALIZED (SELECT doc_id, t, len(t) AS n FROM ({cut('documents', 'doc_id')}) WHERE len(t) > 0), "
        "total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM d), "
        f"q AS (SELECT DISTINCT item_id, unnest(t) AS term FROM ({cut('benchmark', 'item_id')})), "
        "tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term), "
        f"w AS (SELECT term, CAST(floor({SCALE} * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, total GROUP BY term), "
        f"v AS (SELECT doc_id, term, ({IMPACT} * tf) // (1000 * tf + 20 * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * nd) // l)) AS v FROM tf, total), "
        "s AS (SELECT item_id, doc_id, CAST(sum(w * v) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN v USING (term) GROUP BY item_id, doc_id) "
        "SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS FIRST) AS rank FROM s WHERE score > 0) "
        f"WHERE rank <= {top}"
    )
