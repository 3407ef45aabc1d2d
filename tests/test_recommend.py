"""Scoring and top N against scoring every pair."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.operators import recommend as rec
from sluice.plans.jobs import recommendations
from sluice.schemas import stream_schema
from sluice.sources.catalog import catalog_latest

CATALOG_DDL = "productId string, eventTime bigint, eventType string, isActive boolean, targetSkinConcerns array<string>, targetSkinTypes array<string>"
SNAP_DDL = "customerId string, scanId string, eventTimeMs bigint, scores map<string,double>"


def weights_of(scores):
    return {c: (100.0 - scores[s]) / 100.0 for c, s in rec.CONCERNS if scores.get(s) is not None}


def score_of(scores, concerns, types, skin, owned):
    total = 0.0
    for concern in concerns:
        total += weights_of(scores).get(concern.lower(), 0.0)
    if skin is not None and types:
        total += 0.2 if skin in types else -0.1
    return max(0.0, total * (0.3 if owned else 1.0))


def test_weight_and_score_cases(spark):
    snap = spark.createDataFrame([("c", "s", 1, {"hydration": 40.0, "poreScore": 90.0})], SNAP_DDL)
    product = spark.createDataFrame([(["HYDRATION", "PORES"], ["DRY"]), (["OTHER"], ["OILY"]), ([], [])], "con array<string>, typ array<string>")
    scored = snap.join(product).select(
        rec.concern_weights(F.col("scores")).alias("w"),
        rec.product_score(rec.concern_weights(F.col("scores")), F.col("con"), F.col("typ"), F.lit("DRY"), True).alias("score"),
    ).collect()
    assert scored[0].w == {"hydration": 0.6, "pores": 0.1}
    assert sorted(round(r.score, 10) for r in scored) == [0.0, 0.0, 0.27]
    worse = snap.select(rec.concern_weights(F.col("scores"), ("hydration",)).alias("w")).first().w
    assert worse["hydration"] == 0.4


@pytest.mark.parametrize("part_profiles,hot_rows", [(1000, 1000), (7, 3)])
@pytest.mark.parametrize("with_customer", [False, True])
def test_top_n_equals_all_pairs(spark, part_profiles, hot_rows, with_customer):
    rng = random.Random(2)
    names = [c.upper() for c, _ in rec.CONCERNS] + ["OTHER"]
    products = [
        (f"p{i:02d}", i, "UPSERT", rng.random() < 0.9, [rng.choice(names) for _ in range(rng.randrange(3))],
         rng.sample(["DRY", "OILY", "NORMAL"], rng.randrange(3)))
        for i in range(60)
    ]
    keys = sorted({s for _, s in rec.CONCERNS})
    snaps = [(f"c{i % 7}", f"s{i}", i, {k: float(rng.randrange(0, 100, 10)) for k in keys if rng.random() < 0.6}) for i in range(40)]
    skins = {f"c{i}": rng.choice(["DRY", "OILY", None]) for i in range(5)}
    owned = {(f"c{rng.randrange(7)}", f"p{rng.randrange(62):02d}") for _ in range(120)}
    found = rec.recommend(
        spark.createDataFrame(snaps, SNAP_DDL),
        spark.createDataFrame(products, CATALOG_DDL),
        spark.createDataFrame(list(skins.items()), "customerId string, skinType string") if with_customer else None,
        spark.createDataFrame(list(owned), "customerId string, productId string") if with_customer else None,
        part_profiles=part_profiles, hot_rows=hot_rows,
    )
    got = {r.scanId: [(p.productId, p["rank"], round(p.score, 9), p.targetConcerns) for p in r.products] for r in found.collect()}
    for customer, scan, _, scores in snaps:
        skin = skins.get(customer) if with_customer else None
        all_pairs = sorted(
            (-score_of(scores, con, typ, skin, with_customer and (customer, pid) in owned), pid, con)
            for pid, _, _, active, con, typ in products if active
        )
        assert got[scan] == [(pid, i + 1, round(0.0 - s, 9), con) for i, (s, pid, con) in enumerate(all_pairs[:5])]


def test_a_large_catalogue_and_a_customer_who_owns_its_best(spark):
    """250,000 products; the plan has no single partition, no literal and no list of the catalogue."""
    concerns = F.expr("array(element_at(array('HYDRATION','PORES','TEXTURE','OTHER'), cast(id % 4 + 1 as int)), element_at(array('WRINKLES','CLARITY','x'), cast(id % 3 + 1 as int)))")
    catalogue = spark.range(250_000).select(
        F.format_string("p%06d", "id").alias("productId"), F.lit(1).cast("bigint").alias("eventTime"), F.lit("UPSERT").alias("eventType"),
        F.lit(True).alias("isActive"), concerns.alias("targetSkinConcerns"), F.array(F.lit("DRY")).alias("targetSkinTypes"))
    snaps = spark.createDataFrame([("a", "s1", 1, {"hydration": 10.0, "wrinkle": 20.0}), ("b", "s2", 2, {"hydration": 10.0, "wrinkle": 20.0})], SNAP_DDL)
    best = [k for k in range(250_000) if k % 12 == 0]  # hydration and wrinkles: 0.9 + 0.8
    owned = [("b", f"p{k:06d}") for k in best if k not in (24, 36, 120_000, 240_000)] + [("b", "p000001")]
    bought = spark.createDataFrame(owned, "customerId string, productId string")
    found = rec.recommend(snaps, catalogue, bought=bought)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "p000012" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = {r.scanId: [(p.productId, round(p.score, 6)) for p in r.products] for r in found.collect()}
    assert got["s1"] == [(f"p{12 * k:06d}", 1.7) for k in range(5)]
    # four of the best are free, then hydration with clarity (0.9): ids that are 4 or 8 modulo 12
    assert got["s2"] == [("p000024", 1.7), ("p000036", 1.7), ("p120000", 1.7), ("p240000", 1.7), ("p000004", 0.9)]


def test_empty_and_inactive_catalogue(spark):
    snaps = spark.createDataFrame([("c", "s", 1, {"hydration": 1.0})], SNAP_DDL)
    off = spark.createDataFrame([("p", 1, "UPSERT", False, ["HYDRATION"], [])], CATALOG_DDL)
    assert rec.recommend(snaps, off).count() == 0 and rec.recommend(snaps, off.limit(0)).count() == 0


def test_catalogue_feed(spark):
    rows = [
        ("a", 1, "UPSERT", True, [], []), ("a", 2, "DELETED", True, [], []), ("b", 1, "DISCONTINUED", True, [], []),
        ("b", 2, "ACTIVATED", True, ["X"], []), ("c", 5, "UPSERT", False, [], []),
    ]
    latest = catalog_latest(spark.createDataFrame(rows, CATALOG_DDL)).collect()
    assert {(r.productId, r.eventType) for r in latest} == {("b", "ACTIVATED"), ("c", "UPSERT")}


@pytest.mark.parametrize("hot_rows", [1000, 2])
def test_change_gate(spark, hot_rows):
    rows = [("c", f"s{t}", t, {"overall": v}) for t, v in enumerate([50.0, 52.9, 55.9, 55.0, 40.0])] + [("d", "x", 1, {"hydration": 1.0})]
    kept = rec.change_gate(spark.createDataFrame(rows, SNAP_DDL), hot_rows=hot_rows).orderBy("eventTimeMs").collect()
    assert [r.scanId for r in kept] == ["s0", "s2", "s4"]
    assert kept[0].previous is None and round(kept[1].change, 6) == 3.0


def test_job_output_layout(spark):
    day = rec.DAY_MS
    snaps = spark.createDataFrame([("c", "s", 100 * day, {"hydration": 40.0}), ("c", "old", day, {"hydration": 1.0})], SNAP_DDL)
    changes = spark.createDataFrame([("p1", 1, "UPSERT", True, ["HYDRATION"], ["DRY"]), ("p2", 1, "UPSERT", True, ["HYDRATION"], ["DRY"])], CATALOG_DDL)
    prefs = spark.createDataFrame([("c", "OILY", 1), ("c", "DRY", 2)], "customerId string, skinType string, eventTime bigint")
    item = "lineItems array<struct<productId:string,quantity:int>>"
    orders = spark.createDataFrame([("c", 90 * day, [("p1", 1)]), ("c", 101 * day, [("p2", 1)])], f"customerId string, eventTime bigint, {item}")
    out = recommendations(snaps, changes, prefs, orders, as_of_ms=100 * day, gate=False)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in stream_schema("product-recommendations").fields]
    row = out.collect()
    assert len(row) == 1 and len(row[0].recommendationId) == 64
    assert [(p.productId, round(p.score, 5), p.targetConcern) for p in row[0].products] == [("p2", 0.8, "HYDRATION"), ("p1", 0.24, "HYDRATION")]


def test_replacement_scoring(spark):
    snaps = spark.createDataFrame([("c", "s", 1, {"hydration": 100.0})], SNAP_DDL)
    catalogue = spark.createDataFrame([("p1", 1, "UPSERT", True, ["PORES"], []), ("p0", 1, "UPSERT", True, [], [])], CATALOG_DDL)
    model = lambda df: df.withColumn("weights", F.create_map(F.lit("pores"), F.lit(0.9)))
    assert [p.productId for p in rec.recommend(snaps, catalogue, score_fn=model).first().products] == ["p1", "p0"]


@pytest.mark.parametrize("hot_rows", [1000, 5])
def test_next_purchases(spark, hot_rows):
    rows = [("c", "a", 1), ("c", "b", 2), ("c", "a", 3), ("c", "d", 4), ("e", "a", 9), ("e", "b", 9), (None, "a", 1)]
    rows += [("hot", f"p{i:02d}", i) for i in range(30)]
    found = rec.next_purchases(spark.createDataFrame(rows, "customerId string, productId string, eventTime bigint"), hot_rows=hot_rows)
    counts = {(r.productId, r.nextProductId): r.customers for r in found.collect()}
    assert counts[("a", "b")] == 2 and counts[("b", "d")] == 1 and counts[("p07", "p08")] == 1 and len(counts) == 2 + 29


@pytest.mark.parametrize("block_items", [1000, 4])
def test_copurchases_are_exact_and_heavy_customers_split(spark, block_items):
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(30)}", f"p{rng.randrange(25):02d}", f"o{rng.randrange(90)}") for _ in range(500)]
    rows += [("heavy", f"p{k:02d}", "o0") for k in range(40)] + [(None, "p01", "o1"), ("c1", None, "o2")]
    df = spark.createDataFrame(rows, "customerId string, productId string, orderId string")
    for basket, at in (("customerId", 0), ("orderId", 2)):
        baskets = {}
        for row in rows:
            if row[at] is not None and row[1] is not None:
                baskets.setdefault(row[at], set()).add(row[1])
        counts = {}
        for own in baskets.values():
            for a in own:
                for b in own:
                    if a < b:
                        counts[(a, b)] = counts.get((a, b), 0) + 1
        for least in (1, 3):
            got = {(r.productId, r.otherId): r.baskets for r in rec.copurchases(df, least, basket, block_items).collect()}
            assert got == {pair: n for pair, n in counts.items() if n >= least}
    assert rec.copurchases(df.limit(0), 1).count() == 0


@pytest.mark.parametrize("hot_baskets", [1_000_000, 20])
def test_copurchase_tasks_follow_the_pairs(spark, hot_baskets):
    """Tasks that count pairs grow in number, not in size; pairs of two frequent products combine apart."""
    rows = [(f"c{k}", f"p{(k * 7 + i * i) % 60:02d}") for k in range(120) for i in range(12)] + [(f"c{k}", p) for k in range(120) for p in ("x", "y")]
    counts = {}
    for k in range(120):
        own = sorted({p for c, p in rows if c == f"c{k}"})
        for a, b in itertools.combinations(own, 2):
            counts[(a, b)] = counts.get((a, b), 0) + 1
    df = spark.createDataFrame(rows, "customerId string, productId string")
    few, many = (rec.copurchases(df, 2, task_pairs=n, hot_baskets=hot_baskets) for n in (1_000_000, 100))
    for found in (few, many):
        assert {(r.productId, r.otherId): r.baskets for r in found.collect()} == {pair: n for pair, n in counts.items() if n >= 2}
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(_a#\d+L, _b#\d+L, (\d+)\)", many._jdf.queryExecution().executedPlan().toString())]
    assert dealt and max(dealt) >= sum(counts.values()) / 100


def test_blocks_of_snapshots_equal_snapshot_by_snapshot(spark, monkeypatch):
    """Ties, scores that are no numbers, changed and owned products; few snapshots are left to the slow way."""
    from sluice.operators import topn

    rng = random.Random(8)
    kinds = [(c, t) for c in ([1, 7], [4], [8, 8], []) for t in ("a", "b")]
    heads = [
        {"profile": f"{k}", "place": n + 1, "productId": f"p{rng.randrange(10**5)}", "concerns": [t], "places": c, "types": [t]}
        for k, (c, t) in enumerate(kinds) for n in range(1 if k == 3 else 3)
    ]
    entry = lambda k: (f"{k}", rng.random() < 0.2, [("free", ["x"])], [(f"own{rng.randrange(99)}", ["y"])])
    rows = [
        (i, [float("nan") if i % 31 == 0 else round(rng.random(), 1) - 0.3 for _ in rec.CONCERNS], rng.choice(["a", "b", None]),
         None if i % 3 == 0 else [entry(k) for k in rng.sample(range(10), 4)], None)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, f"row int, weights array<double>, skin string, own array<struct<profile:string,changed:boolean,free:{topn.LISTED},owned:{topn.LISTED}>>, products {topn.PRODUCTS}")
    part = topn.Profiles(heads, len(rec.CONCERNS), topn.Factors(rec.TYPE_BONUS, rec.TYPE_PENALTY, rec.OWNED_FACTOR))
    pick = lambda found: sorted((r.row, repr(r.products)) for r in found.collect())
    expected = pick(topn.improve(df, part, 4, sorted_profiles=0))
    assert pick(topn.improve(df, part, 4)) == expected
    monkeypatch.setattr(topn.Profiles, "leading", lambda *args: 1 / 0)
    assert pick(topn.improve(df.where("own IS NULL"), part, 4)) == [e for e in expected if e[0] % 3 == 0]
