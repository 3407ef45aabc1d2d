"""Clustering with bounds against a full comparison in whole numbers."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import centroids


def brute(rows, k=16, rounds=3):
    """(id, cluster, distance, cluster inertia, inertia, hash) by every distance."""
    kept = [(n, [max(-centroids.MOST, min(centroids.MOST, math.floor(64 * x))) for x in v]) for n, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda n: (n is None, hashlib.sha256(f"1:{n}".encode()).hexdigest())
    raw = lambda v: np.array(v, "<i4").tobytes()
    at = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), raw(r[1])))[:k]]
    every = np.array([v for _, v in kept], np.int64).reshape(-1, 64)

    def assign():
        d = ((every[:, None] - np.array(at, np.int64)[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    if not kept:
        return []
    for _ in range(rounds):
        best, _ = assign()
        for c in range(len(at)):
            own = every[best == c]
            if len(own):
                at[c] = [int(s) // len(own) for s in own.sum(axis=0)]
    best, d = assign()
    inertia = [int(d[best == c].sum()) for c in range(len(at))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((n, int(b), int(x), inertia[b], int(d.sum()), digest[b]) for (n, _), b, x in zip(kept, best, d)), key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(n, v, "k", 5, 1.0) for n, v in rows], "vec_id long, embedding array<float>, id string, cluster int, rest double").repartition(3)
    return sorted((tuple(r) for r in centroids.cluster_vectors(frame).collect()), key=str)


def floats(values):
    return [float(np.float32(x)) for x in values]


def test_equal_to_the_full_comparison(spark):
    dealt = np.random.default_rng(1)
    middle = dealt.normal(0, 1, (20, 64))
    rows = [(k, floats(middle[k % 20] + dealt.normal(0, 0.4, 64))) for k in range(600)]
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_bad_vectors(spark):
    dealt = np.random.default_rng(2)
    rows = [(k, floats(dealt.integers(-2, 3, 64) / 64)) for k in range(60)]
    rows += [(k, rows[0][1]) for k in range(100, 160)] + [(7, rows[7][1])] * 3 + [(None, rows[1][1]), (None, rows[2][1])]
    rows += [(200, None), (201, []), (202, [0.5] * 63), (203, [0.5] * 63 + [None]), (204, [0.5] * 63 + [float("nan")]), (205, [float("inf")] + [0.0] * 63)]
    rows += [(300, [3e38] * 64), (301, [-3e38] + [0.0] * 63)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, count):
    rows = [(k, [k / 64] * 64) for k in range(count)]
    assert run(spark, rows) == brute(rows)


def test_bounds_spare_most_distances_and_lose_none():
    dealt = np.random.default_rng(3)
    middle = dealt.normal(0, 64, (16, 64))
    numbers = np.floor(middle[dealt.integers(0, 16, 3000)] + dealt.normal(0, 12, (3000, 64))).astype(np.int64)
    at = np.floor(middle).astype(np.int64)
    values = numbers.astype(float)
    turn = centroids.rotation(values.sum(axis=0), values.T @ values, len(numbers))
    lead, rest = centroids.rotated(numbers, *turn, 16)
    lead_c, rest_c = centroids.rotated(at, *turn, 16)
    full = ((numbers[:, None] - at[None]) ** 2).sum(axis=2)
    bound = ((lead[:, None] - lead_c[None]) ** 2).sum(axis=2) + (rest[:, None] - rest_c[None]) ** 2
    assert (bound <= full + 1e-3).all()
    best, distance, computed = centroids.nearest(numbers, lead, rest, at, lead_c, rest_c)
    assert (best == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert computed < 0.2 * full.size


def test_whole_numbers_floor_below_zero():
    rows, numbers = centroids.whole_numbers(pa.array([[-1 / 64 - 1e-9] + [0.0] * 63, None, [1.0]], pa.list_(pa.float64())))
    assert rows.tolist() == [0] and numbers[0, 0] == -2
