"""Centroid clustering with bounds from PCA-rotated coordinates.

Vectors become integers, ``floor(64 * x)`` in doubles, and all distances are exact. The
covariance of all vectors, summed up exactly from partial sums of the tasks, gives a
rotation; each vector is stored with its ``LEADING`` rotated coordinates and the norm of the
rest, once. For a vector v and a centroid c, turned the same way,

    |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2  <=  |v - c|^2

as the norms of two vectors differ by no more than their difference's norm. A vector's
distance to the centroid with the least bound is computed in integers; of the others only
those whose bound, less a margin for rounding, does not exceed it are verified, also in
integers, and the smallest (distance, number) wins. No centroid that could win or tie is
left out, so the result is that of the full comparison.

A round is one pass over the stored table. Tasks return a sum and a count for each centroid,
which Spark adds up; only the 16 centroids themselves meet on the driver, for an exact
``floor(sum / count)``. So neither large clusters nor repeated vectors meet in one task.

Defined cases: vectors that are null, have another number of components, or a null or
non-finite one, are left out; components beyond +-2^27 count as +-2^27, so that distances
fit 64 bits; fewer vectors than centroids make fewer centroids; repeated rows are vectors of
their own; of equal hashes the smaller integer vector comes first, rows with a null id come
last; an empty table gives no rows; inertias that exceed 64 bits are null; other columns are
not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import remove_path, scratch_path
from .base import ship

ship(__name__)

COMPONENTS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
LEADING = 16
MOST = 1 << 27
#: Vectors that a task handles at once.
BLOCK_ROWS = 4096
STORED = "id long, v binary, lead binary, rest double"


def whole_numbers(vectors: pa.ListArray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The row numbers that are kept and their integer vectors."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == components)
    flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, components)
    good = np.isfinite(flat).all(axis=1)  # a null became nan
    numbers = np.floor(np.clip(SCALE * flat[good], -MOST, MOST))
    return rows[good], numbers.astype(np.int64)


def rotation(total: np.ndarray, products: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the directions of most variance, as columns."""
    mean = total / max(count, 1)
    covariance = products / max(count, 1) - np.outer(mean, mean)
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    return mean, directions[:, np.argsort(-values, kind="stable")]


def rotated(numbers: np.ndarray, mean: np.ndarray, directions: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest."""
    turned = (numbers - mean) @ directions
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))


def nearest(numbers: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, lead_c: np.ndarray, rest_c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per vector the nearest centroid and its squared distance, and how many distances were
    computed in whole numbers."""
    bound = ((lead[:, None, :] - lead_c[None]) ** 2).sum(axis=2) + (rest[:, None] - rest_c[None]) ** 2
    size = (lead**2).sum(axis=1) + rest**2
    margin = 1e-9 * (size[:, None] + ((lead_c**2).sum(axis=1) + rest_c**2)[None]) + 1e-6
    bound -= margin

    def exact(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((numbers[rows] - centroids[which]) ** 2).sum(axis=1)

    every = np.arange(len(numbers))
    best = bound.argmin(axis=1)
    distance = exact(every, best)
    bound[every, best] = np.inf
    rows, which = np.nonzero(bound <= distance[:, None])
    other = exact(rows, which)
    # smallest (distance, number) of each row: better ones overwrite in that order
    order = np.lexsort((which, other, rows))
    rows, which, other = rows[order], which[order], other[order]
    first = np.append(True, rows[1:] != rows[:-1]) if len(rows) else np.empty(0, bool)
    rows, which, other = rows[first], which[first], other[first]
    better = (other < distance[rows]) | ((other == distance[rows]) & (which < best[rows]))
    best[rows[better]], distance[rows[better]] = which[better], other[better]
    return best, distance, len(numbers) + len(order)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def _partial_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, total, products = 0, np.zeros(COMPONENTS), np.zeros((COMPONENTS, COMPONENTS))
    for block in _blocks(batches):
        _, numbers = whole_numbers(block.column(0))
        count, total = count + len(numbers), total + numbers.sum(axis=0)
        products += numbers.astype(float).T @ numbers
    names = np.arange(COMPONENTS * (COMPONENTS + 1) + 1, dtype=np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate([[count], total, products.ravel()]))], names=["at", "value"])


def store(embeddings: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
    """Writes id, integer vector, leading coordinates and residual norm of every kept vector;
    returns the rotation."""
    vectors = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    sums = vectors.select("x").mapInArrow(_partial_moments, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    moments = np.zeros(COMPONENTS * (COMPONENTS + 1) + 1)
    for row in sums.collect():
        moments[row["at"]] = row["value"]
    mean, directions = rotation(moments[1:COMPONENTS + 1], moments[COMPONENTS + 1:].reshape(COMPONENTS, COMPONENTS), int(moments[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            rows, numbers = whole_numbers(block.column(1))
            lead, rest = rotated(numbers, mean, directions, leading)
            raw = [pa.array([row.tobytes() for row in part], pa.binary()) for part in (numbers.astype("<i4"), lead.astype("<f8"))]
            yield pa.RecordBatch.from_arrays([block.column(0).take(pa.array(rows)), *raw, pa.array(rest, pa.float64())], names=["id", "v", "lead", "rest"])

    vectors.mapInArrow(run, STORED).write.parquet(path)
    return mean, directions


def as_rows(block: pa.RecordBatch, leading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer vectors, leading coordinates and residual norms of stored rows."""
    join = lambda k: b"".join(block.column(k).to_pylist())
    numbers = np.frombuffer(join(1), "<i4").reshape(-1, COMPONENTS).astype(np.int64)
    return numbers, np.frombuffer(join(2), "<f8").reshape(-1, leading), block.column(3).to_numpy()


def first_centroids(stored: DataFrame, centroids: int = CENTROIDS) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    chosen = stored.select(hashed.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), F.hex("v")).limit(centroids).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in chosen], np.int64).reshape(-1, COMPONENTS)


def _assign(stored: DataFrame, centroids: np.ndarray, turn: tuple[np.ndarray, np.ndarray], leading: int, sums: bool) -> DataFrame:
    """Per vector id, cluster and distance; with ``sums`` per task and centroid its count and sums."""
    lead_c, rest_c = rotated(centroids, *turn, leading)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for block in _blocks(batches):
            numbers, lead, rest = as_rows(block, leading)
            yield block, numbers, *nearest(numbers, lead, rest, centroids, lead_c, rest_c)[:2]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, best, distance in assigned(batches):
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), COMPONENTS + 1), np.int64)
        for _, numbers, best, _ in assigned(batches):
            for cluster in np.unique(best).tolist():
                own = numbers[best == cluster]
                total[cluster] += np.append(own.sum(axis=0), len(own))
        cluster, at = np.divmod(np.arange(total.size, dtype=np.int32), COMPONENTS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(at, pa.int32()), pa.array(total.ravel())], names=["cluster", "at", "value"])

    return stored.mapInArrow(totals, "cluster int, at int, value long") if sums else stored.mapInArrow(rows, "id long, cluster int, distance long")


def moved(stored: DataFrame, centroids: np.ndarray, turn: tuple[np.ndarray, np.ndarray], leading: int) -> np.ndarray:
    """The centroids after one round; empty clusters keep theirs."""
    exact = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    sums = {(r["cluster"], r["at"]): int(r["value"]) for r in _assign(stored, centroids, turn, leading, True).groupBy("cluster", "at").agg(exact).collect()}
    new = centroids.copy()
    for cluster in range(len(centroids)):
        if count := sums.get((cluster, COMPONENTS), 0):
            new[cluster] = [sums[cluster, at] // count for at in range(COMPONENTS)]
    return new


def cluster_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS, leading: int = LEADING) -> DataFrame:
    """Per kept vector: id, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    spark = embeddings.sparkSession
    path = scratch_path(spark, "vectors")
    turn = store(embeddings, path, id_col, vector_col, leading)
    stored = spark.read.schema(STORED).parquet(path)
    at = first_centroids(stored, centroids)
    for _ in range(rounds):
        at = moved(stored, at, turn, leading)
    found = f"{path}-found"
    _assign(stored, at, turn, leading, False).write.parquet(found)
    remove_path(spark, path)
    assigned = spark.read.schema("id long, cluster int, distance long").parquet(found)
    inertia = {r["cluster"]: int(r["n"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    rows = [
        (k, fits(inertia.get(k, 0)), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, at[k].tolist())).encode()).hexdigest())
        for k in range(len(at))
    ]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clusters_sql(rounds: int = ROUNDS, centroids: int = CENTROIDS) -> str:
    """The same in DuckDB: every distance, no bounds."""
    floor = "(s - ((s % n) + n) % n) // n"
    kept = (
        f"kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        f"WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {COMPONENTS})"
    )
    first = f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS k, v AS c FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT {centroids}))"
    squares = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [kept, first]
    for r in range(rounds + 1):
        parts.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, v, k, CAST(d AS BIGINT) AS d FROM (SELECT vec_id, v, k, {squares} AS d FROM kept, c{r}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)"
        )
        if r < rounds:
            parts.append(f"s{r} AS (SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {COMPONENTS + 1}) AS g(i) GROUP BY k, i)")
            parts.append(f"m{r} AS (SELECT k, list(CAST({floor} AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON m{r}.k = c{r}.k)")
    last, ends = f"a{rounds}", f"c{rounds}"
    return (
        "WITH " + ", ".join(parts) + f" SELECT vec_id, {last}.k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY {last}.k) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string({ends}.c, ',')) AS centroid_sha256 FROM {last} JOIN {ends} ON {last}.k = {ends}.k"
    )
