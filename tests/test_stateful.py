"""Dedup and anomaly rules against brute force, hot keys included."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from sluice.config import AnomalyRule
from sluice.operators.anomaly import detect_anomalies
from sluice.operators.dedup import dedup
from sluice.operators.ordered import previous_value, running_count, split_hot_keys
from sluice.operators import ttl
from sluice.operators.ttl import accepted_rows
from sluice.operators.verdict import ANOMALY, FAILURES, LIVE
from pyspark.sql import functions as F


def chain(rows, ttl):
    last, accepted = {}, set()
    for key, time, position in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or time - last[key] >= ttl:
            last[key] = time
            accepted.add(position)
    return accepted


HOUR = 3_600_000


def test_dedup_case(spark):
    rows = [("k", h * HOUR, i) for i, h in enumerate([0, 23, 24, 47])]
    df = spark.createDataFrame(rows, "id string, eventTime bigint, seq bigint")
    result = {r["seq"]: r[LIVE] for r in dedup(df, ["id"], 24, position="seq").collect()}
    assert result == {0: True, 1: False, 2: True, 3: False}


def test_dedup_identical_copies_without_position(spark):
    rows = [("k", 5)] * 40 + [(None, 7)] * 3 + [("", 8)]
    df = spark.createDataFrame(rows, "id string, eventTime bigint").repartition(4)
    result = dedup(df, ["id"], 24, fold_rows=10)
    assert result.where(LIVE).count() == 2  # a null key counts as the empty key
    assert result.count() == 44 and "_position" not in result.columns
    assert {r[FAILURES][0]["reason"] for r in result.where(~F.col(LIVE)).collect()} == {"DUPLICATE_EVENT"}


def test_dedup_compound_and_absent_key(spark):
    df = spark.createDataFrame([("a", "x", 1, 1), ("a", "y", 1, 2), ("a", "x", 2, 3)], "a string, b string, eventTime bigint, seq bigint")
    assert {r.seq for r in dedup(df, ["a", "b"], 1, position="seq").where(LIVE).collect()} == {1, 2}
    assert {r.seq for r in dedup(df, ["absent"], 1, position="seq").where(LIVE).collect()} == {1}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seed=st.integers(0, 10_000), span=st.sampled_from([30, 400, 5000]), ttl=st.sampled_from([1, 7, 50, 900]),
    groups=st.sampled_from([3, 40, 500]),
)
def test_chain_of_hot_keys_equals_brute_force(spark, seed, span, ttl, groups):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("abc"), rng.randrange(span), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, t bigint, p bigint")
    expected = chain(rows, ttl)
    for fold_rows in (10_000, 20):
        got = accepted_rows(df, "k", "t", "p", ttl, fold_rows=fold_rows, group_rows=groups).collect()
        assert sorted(r["p"] for r in got) == sorted(expected)


def test_chain_of_a_hot_key_over_many_blocks(spark):
    """A limit of one minute and 10^5 blocks: ranges of 300 rows and three levels of jump maps."""
    rng, minute = random.Random(8), 60_000
    rows = [("hot", rng.randrange(100_000) * minute + rng.choice([0, 5, 30_000, rng.randrange(minute)]), i) for i in range(120_000)]
    rows += [("hot", k * minute, 200_000 + k) for k in range(3_000, 9_000)] + [("cold", k * 31_000, 300_000 + k) for k in range(200)]
    df = spark.createDataFrame(rows, "k string, t bigint, p bigint").repartition(4)
    got = accepted_rows(df, "k", "t", "p", minute, fold_rows=1_000, group_rows=300).collect()
    assert sorted(r["p"] for r in got) == sorted(chain(rows, minute))


def test_maps_of_ranges_compose():
    import pandas as pd
    ranges = [pd.DataFrame({"_k": "k", "_range": n, "_u": u, "_length": 20}) for n, u in ((0, [0, 4, 9, 15]), (1, [1, 8]), (3, [19]))]
    maps = pd.concat([ttl._map_of_range(r, 10) for r in ranges])
    both = ttl._compose(maps)
    assert both["_range"].tolist() == [0] and both["_leaves"].tolist() == [0]  # ranges 4 to 7 have no row
    entries = ttl._thresholds(maps, pd.DataFrame({"_entry": [0]}))
    # 0 and 15 are accepted in the first range; 25 becomes 5 in the second, and accepts 8
    assert list(zip(entries["_range"], entries["_entry"])) == [(0, 0), (1, 5), (3, 0)]


def brute_flags(rows, rule, k):
    seen, out = {}, {}
    for key, time, position, value in sorted(rows, key=lambda r: (r[1], r[2])):
        past = seen.setdefault(key, [])
        sample = past[-rule.window_rows :] if rule.window_rows else past
        flag = False
        if value is not None and len(sample) >= 5:
            if rule.method == "THRESHOLD":
                flag = value < rule.threshold
            else:
                deviation = statistics.stdev(sample)
                flag = deviation > 0 and abs(value - statistics.fmean(sample)) > rule.threshold * deviation
        if value is not None:
            past.append(value)
        out[position] = flag
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 60, 9])
@pytest.mark.parametrize(
    "rule",
    [
        AnomalyRule("v", threshold=1.7),
        AnomalyRule("v", "IQR", threshold=1.2),
        AnomalyRule("v", "THRESHOLD", threshold=-1.0),
        AnomalyRule("v", threshold=1.7, window_rows=25),
    ],
)
def test_anomaly_equals_brute_force(spark, rule, hot_rows):
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(200), i, rng.gauss(1000, 1) if rng.random() < 0.9 else None)
        for i in range(500)
    ]
    rule = AnomalyRule(rule.field, rule.method, threshold=rule.threshold if rule.method != "THRESHOLD" else 999.0, window_rows=rule.window_rows)
    df = spark.createDataFrame(rows, "customerId string, eventTime bigint, seq bigint, v double")
    got = {r["seq"]: r[ANOMALY] for r in detect_anomalies(df, [rule], "s", position="seq", hot_rows=hot_rows).collect()}
    assert got == brute_flags(rows, rule, 0)


def flags(spark, values, rule):
    df = spark.createDataFrame([(i, i, float(v)) for i, v in enumerate(values)], "eventTime bigint, seq bigint, v double")
    found = detect_anomalies(df, [rule], "s", position="seq")
    return [r["seq"] for r in found.where(ANOMALY).orderBy("seq").collect()]


def test_anomaly_cases(spark):
    assert flags(spark, [10, 11, 9, 10, 10, 100], AnomalyRule("v")) == [5]
    assert flags(spark, [1] * 6, AnomalyRule("v", "THRESHOLD", threshold=5)) == [5]
    assert flags(spark, [4, 4, 4, 4, 4, 9], AnomalyRule("v")) == []
    assert flags(spark, [1, 2, 3, 4, 5, 50], AnomalyRule("v", "IQR_EXACT", threshold=1.5)) == [5]


@pytest.mark.parametrize("hot_rows", [1000, 7])
def test_suppressed_rows_leave_later_statistics(spark, hot_rows):
    values = [10, 11, 9, 10, 10, 500, 11, 10, 300, 10]
    df = spark.createDataFrame([(i, i, float(v), f"{v}") for i, v in enumerate(values)], "eventTime bigint, seq bigint, v double, w string")
    rules = [AnomalyRule("v", threshold=3.0, on_anomaly="DROP_RECORD"), AnomalyRule("w", threshold=2.0, on_anomaly="DLQ")]
    rows = detect_anomalies(df, rules, "s", position="seq", hot_rows=hot_rows).orderBy("seq").collect()
    # 500 is dropped by the first rule but widens its statistics, so 300 passes
    # it and falls to the second, whose statistics never saw 500.
    assert [r["seq"] for r in rows if not r[LIVE]] == [5, 8]
    assert [r["seq"] for r in rows if r[FAILURES]] == [8]


@pytest.mark.parametrize("hot_rows", [1000, 12])
def test_ordered_primitives(spark, hot_rows):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else "b", rng.randrange(50), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t bigint, p bigint")
    split = split_hot_keys(df, "k", ["t", "p"], hot_rows)
    assert split.hot == (hot_rows == 12)
    split = running_count(split, F.col("p") % 3 == 0, "n", inclusive=False)
    split = previous_value(split, "p", "prev")
    counts, last = {}, {}
    expected = {}
    for k, t, p in sorted(rows, key=lambda r: (r[1], r[2])):
        expected[p] = (counts.get(k, 0), last.get(k))
        counts[k] = counts.get(k, 0) + (p % 3 == 0)
        last[k] = p
    assert {r["p"]: (r["n"], r["prev"]) for r in split.rows.collect()} == expected
    if split.hot:
        sizes = [r["count"] for r in split.rows.groupBy("k", "_chunk").count().collect()]
        assert max(sizes) < 100  # the hot key has some 240 rows


def test_copies_at_one_time_are_split_too(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(1).cast("bigint").alias("t"), F.col("id").alias("p"))
    split = split_hot_keys(df, "k", ["t", "p"], 100)
    sizes = [r["count"] for r in split.rows.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 400
