"""The continuous recommendation job: from declared streams to the recommendation table."""

import pytest

from sluice.config import load_topology, topology_from_dict
from sluice.operators import recommend as rec
from sluice.plans.jobs import recommendations
from sluice.operators.scans import snapshots
from sluice.session import scratch_path
from sluice.sinks.compact import compact, read_lake
from sluice.sources.readers import union_streams, with_envelope
from sluice.streaming.jobs import catalog_now, recommend_from_topology

SCANS = "customerId string, scanId string, eventTime bigint, overallHydrationScore float, overallSkinScore float"
CHANGES = "productId string, eventTime bigint, eventType string, isActive boolean, targetSkinConcerns array<string>, targetSkinTypes array<string>"


def declared(path):
    """The shipped topology with its file sources below ``path``."""
    streams = [{"key": key, "streamType": "SCAN", "source": {"type": "FILE", "path": f"{path}/{key}"}} for key in ("scan-hydration", "scan-overall")]
    streams.append({"key": "product-catalog", "streamType": "PRODUCT", "source": {"type": "FILE", "path": f"{path}/product-catalog"}})
    target = {"type": "ICEBERG", "database": "product", "table": "product_recommendations", "partitionColumns": ["eventDate"]}
    streams.append({"key": "product-recommendations", "streamType": "PRODUCT", "sinks": [target]})
    return topology_from_dict({"streams": streams})


def products_of(df):
    return {r.scanId: [(p.productId, p["rank"], round(p.score, 4)) for p in r.products] for r in df.collect()}


def test_job_follows_scans_and_catalogue(spark):
    path, root = scratch_path(spark, "rec-input"), scratch_path(spark, "rec-tables")
    topology = declared(path)

    def arrive(number, hydration, overall, changes):
        for key, ddl, rows in (("scan-hydration", SCANS, hydration), ("scan-overall", SCANS, overall), ("product-catalog", CHANGES, changes)):
            spark.createDataFrame(rows, ddl).write.parquet(f"{path}/{key}/wave={number}")
        for running in recommend_from_topology(spark, topology, root, f"{root}-state", available_now=True):
            running.awaitTermination()

    bought = ["HYDRATION"]
    arrive(1, [("c", "s1", 1000, 40.0, None)], [("c", "s1", 2000, None, 50.0)],
           [("p1", 5, "UPSERT", True, bought, []), ("p2", 5, "UPSERT", True, ["PORES"], []), ("p3", 9, "DISCONTINUED", True, bought, [])])
    table = f"{root}/product_dev/product_recommendations"
    assert products_of(read_lake(spark, table)) == {"s1": [("p1", 1, 0.6), ("p2", 2, 0.0)]}
    # p1 goes, p4 comes, p3's older change arrives late and revives nothing
    arrive(2, [("c", "s2", 5000, 20.0, None)], [("c", "s2", 6000, None, 50.0)],
           [("p1", 10, "DELETED", True, bought, []), ("p4", 10, "UPSERT", True, bought, []), ("p3", 2, "UPSERT", True, bought, [])])
    found = products_of(read_lake(spark, table))
    assert found == {"s1": [("p1", 1, 0.6), ("p2", 2, 0.0)], "s2": [("p4", 1, 0.8), ("p2", 2, 0.0)]}
    arrive(3, [], [], [])  # nothing new, nothing twice
    rows = read_lake(spark, table)
    assert rows.count() == 2 and rows.select("recommendationId").distinct().count() == 2
    assert compact(spark, table, ["eventDate"]) >= 2 and read_lake(spark, table).count() == 2
    # the batch job gives the same for the second state of the catalogue
    frames = [with_envelope(spark.read.parquet(f"{path}/{key}"), key) for key in ("scan-hydration", "scan-overall")]
    batch = products_of(recommendations(snapshots(union_streams(*frames)).where("complete"), spark.read.parquet(f"{path}/product-catalog")))
    assert batch["s2"] == found["s2"] and len(batch["s2"]) <= rec.TOP_N


def test_no_catalogue_yet_gives_no_rows(spark):
    nowhere = scratch_path(spark, "no-catalogue")
    assert catalog_now(spark, nowhere).count() == 0
    snaps = spark.createDataFrame([("c", "s", 1, {"hydration": 40.0})], "customerId string, scanId string, eventTimeMs bigint, scores map<string,double>")
    assert rec.recommend(snaps, catalog_now(spark, nowhere)).count() == 0


def test_topologies_without_scans_or_catalogue_are_refused(spark):
    topology = load_topology()
    only = lambda *keys: type(topology)(**{**vars(topology), "streams": [s for s in topology.streams if s.key in keys]})
    with pytest.raises(ValueError, match="scan stream"):
        recommend_from_topology(spark, only("product-recommendations"), "x", "y")
