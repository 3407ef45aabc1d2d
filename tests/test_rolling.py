"""The kernel of windowed statistics against each window by itself."""

import random
import statistics
import time

import numpy as np
import pytest

from sluice.operators import rolling


def samples(seed, count):
    dealt = random.Random(seed)
    out = []
    while len(out) < count:  # stretches of equal values, far apart
        out += [dealt.choice([0.0, 5.5, 1e9, -3e-7, dealt.random()])] * dealt.randint(1, 6) if dealt.random() < 0.5 else [dealt.gauss(100, 5) for _ in range(dealt.randint(1, 8))]
    return out[:count]


@pytest.mark.parametrize("width", [1, 2, 5, 20, 300])
@pytest.mark.parametrize("held", [0, 3, 25, 400])
def test_moments(width, held):
    x = samples(width + held, held + 120)
    n, mean, squares = rolling.window_moments(np.array(x[:held]), np.array(x[held:]), width)
    for k in range(120):
        window = x[max(0, held + k - width):held + k]
        assert n[k] == len(window)
        if window:
            assert mean[k] == pytest.approx(statistics.fmean(window), rel=1e-9, abs=1e-6)
        if len(window) > 1:
            assert np.sqrt(squares[k] / (n[k] - 1)) == pytest.approx(statistics.stdev(window), rel=1e-6, abs=1e-6)
            assert (squares[k] == 0) == (len(set(window)) == 1)


def test_a_bad_value_leaves_with_its_window():
    x = np.array([1.0, np.nan, 2.0, 3.0, 4.0, 5.0, np.inf, 6.0, 7.0, 8.0, 9.0])
    n, mean, _ = rolling.window_moments(np.empty(0), x, 3)
    assert n.tolist() == [0, 1, 2, 3, 3, 3, 3, 3, 3, 3, 3] and mean[5] == 3.0 and mean[10] == 7.0 and np.isnan(mean[3])


@pytest.mark.parametrize("width", [1, 4, 9, 300])
@pytest.mark.parametrize("held", [0, 3, 40])
def test_quartiles(width, held):
    x = samples(held, held + 150)
    n, low, high = rolling.quartiles(np.array(x[:held]), np.array(x[held:]), width)
    for k in range(150):
        window = x[max(0, held + k - width):held + k]
        assert n[k] == len(window)
        if window:
            assert [low[k], high[k]] == pytest.approx(np.percentile(window, [25, 75]).tolist(), rel=1e-12, abs=1e-12)
    n, low, high = rolling.quartiles(np.empty(0), np.array([1.0, np.nan, 2.0, 3.0, 4.0, 0.0]), 4)
    assert np.isnan(high[2]) and low[3] == 1.5 and np.isnan(high[4]) and high[5] == pytest.approx(np.nan, nan_ok=True)


@pytest.mark.parametrize("kernel", [rolling.window_moments, rolling.quartiles])
def test_cost_does_not_follow_the_window(kernel):
    x = np.random.default_rng(1).normal(size=60_000)
    took = {}
    for width in (20, 3600):
        best = []
        for _ in range(3):
            begin = time.process_time()
            kernel(np.empty(0), x, width)
            best.append(time.process_time() - begin)
        took[width] = min(best)
    assert took[3600] < 3 * took[20] + 0.05


def test_tables(spark):
    """Keys of any size, nulls, two key columns, batches that cut keys."""
    dealt = random.Random(3)
    rows = [("hot" if dealt.random() < 0.6 else dealt.choice(["a", "b", None]), dealt.choice([None, 1]), k, None if dealt.random() < 0.2 else dealt.random(), {"m": k}) for k in range(900)]
    df = spark.createDataFrame(rows, "k string, c int, t long, v double, extra map<string,long>").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for exact in (False, True):
            got = {r["t"]: r for r in rolling.rolling_stats(df, ["k", "c"], ["t"], "v", 12, exact).collect()}
            seen = {}
            for k, c, t, v, extra in rows:
                window = seen.setdefault((k, c), [])[-12:]
                assert got[t]["extra"] == extra
                if v is None:
                    assert got[t]["_n"] is None
                    continue
                assert got[t]["_n"] == len(window)
                if window:
                    want = np.percentile(window, 25) if exact else statistics.fmean(window)
                    assert got[t]["_stat_a"] == pytest.approx(want)
                seen[(k, c)].append(v)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
