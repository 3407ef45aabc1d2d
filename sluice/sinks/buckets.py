"""Upsert tables as hash buckets under manifests.

A key belongs to one of a table's buckets, by hash. An upsert reads and rewrites only the
buckets that its keys touch, into a folder of its own, and then writes a manifest: one row per
bucket with the folder that holds it. A version is a manifest; it counts when it is complete,
so readers see the table before or after an upsert, and a repeated micro-batch replaces its
own version. The version before stays for readers at work; what neither of the two names is
removed.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.verdict import ANOMALY, ENVELOPE
from ..session import path_files

BUCKETS = 64
_BUCKET, _UPDATE, _CONTENT = "_bucket", "_is_update", "_content"
MANIFEST = "bucket int, folder string, buckets int, columns string"


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``. Combines before the shuffle, so a
    key with most of the rows costs no more than any other."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


def merged(current: DataFrame | None, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table after the upsert: per key (null is a key as well) the newest row of
    table and updates. Of equal order the update wins, and of updates the one that
    is last by its content, so that a repeat gives the same table."""
    rows = updates.withColumn(_UPDATE, F.lit(1))
    if current is not None:
        rows = current.withColumn(_UPDATE, F.lit(0)).unionByName(rows, allowMissingColumns=True)
    content = F.xxhash64(F.to_json(F.struct(*[c for c in rows.columns if c != _UPDATE])))
    ordered = rows.withColumn(_CONTENT, content)
    return newest_per_key(ordered, keys, [*order, _UPDATE, _CONTENT]).drop(_UPDATE, _CONTENT)


def versions(spark: SparkSession, table: str) -> dict[int, tuple[str, int | None]]:
    """Name and batch of each complete version by number."""
    files, root = path_files(spark, f"{table}/manifests")
    found = {}
    for entry in files.listStatus(root) if files.exists(root) else ():
        name = re.fullmatch(r"version=(\d+)(?:\.batch=(\d+))?", entry.getPath().getName())
        if name and files.exists(path_files(spark, f"{table}/manifests/{name[0]}/_SUCCESS")[1]):
            found[int(name[1])] = (name[0], int(name[2]) if name[2] else None)
    return found


def _manifest(spark: SparkSession, table: str, name: str) -> list:
    """At most one row per bucket."""
    return spark.read.schema(MANIFEST).parquet(f"{table}/manifests/{name}").collect()


def _rows(spark: SparkSession, table: str, manifest: list, buckets: set[int] | None = None) -> DataFrame | None:
    """The rows of some buckets, or all."""
    folders = sorted(f"{table}/data/{r['folder']}/{_BUCKET}={r['bucket']}" for r in manifest if buckets is None or r["bucket"] in buckets)
    if not folders:
        return None
    schema = T.StructType.fromJson(json.loads(manifest[0]["columns"]))
    return spark.read.schema(schema).parquet(*folders)


def read_upserts(spark: SparkSession, table: str) -> DataFrame:
    """The newest complete version of an upsert table."""
    found = versions(spark, table)
    if not found:
        raise FileNotFoundError(f"no complete version of {table}")
    return _rows(spark, table, _manifest(spark, table, found[max(found)][0]))


def upsert_version(updates: DataFrame, keys: list[str], order: list[str], table: str, batch_id: int | None = None, buckets: int = BUCKETS, codec: str = "zstd") -> str:
    """Merge into the newest complete version and write the next one; returns its name. The
    number of buckets is that of the table's first version."""
    spark = updates.sparkSession
    updates = updates.drop(*ENVELOPE, ANOMALY)
    found = versions(spark, table)
    newest = max(found, default=-1)
    number = newest if batch_id is not None and found.get(newest, ("", None))[1] == batch_id else newest + 1
    before = [n for n in found if n < number]
    manifest = _manifest(spark, table, found[max(before)][0]) if before else []
    count = manifest[0]["buckets"] if manifest else buckets
    own = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(count)).cast("int")
    touched = {r[0] for r in updates.select(own).distinct().collect()}  # as many as buckets at most
    if manifest and not touched:
        return found[max(before)][0]
    result = merged(_rows(spark, table, manifest, touched), updates, keys, order)
    folder = uuid.uuid4().hex
    if manifest:  # columns that only untouched buckets have stay in the table
        known = T.StructType.fromJson(json.loads(manifest[0]["columns"]))
        result = result.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in known if f.name not in result.columns])
    result.withColumn(_BUCKET, own).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).option("compression", codec).parquet(f"{table}/data/{folder}")
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in result.schema]).json()
    rows = [(r["bucket"], r["folder"], count, columns) for r in manifest if r["bucket"] not in touched] + [(b, folder, count, columns) for b in sorted(touched)]
    name = f"version={number}" + (f".batch={batch_id}" if batch_id is not None else "")
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{table}/manifests/{name}")
    _clean(spark, table, rows, manifest, {n: found[n][0] for n in before if n < number - 1})
    return name


def _clean(spark: SparkSession, table: str, now: list, before: list, old: dict[int, str]) -> None:
    """Remove versions before the last two and the buckets that only they have, and folders of
    writes that never became a version."""
    kept = {(folder, bucket) for bucket, folder, *_ in now} | {(r["folder"], r["bucket"]) for r in before}
    for name in old.values():
        files, place = path_files(spark, f"{table}/manifests/{name}")
        files.delete(place, True)
    files, root = path_files(spark, f"{table}/data")
    for entry in files.listStatus(root):
        folder = entry.getPath().getName()
        if folder not in {f for f, _ in kept}:
            files.delete(entry.getPath(), True)
            continue
        for part in files.listStatus(entry.getPath()):
            name = re.fullmatch(rf"{_BUCKET}=(\d+)", part.getPath().getName())
            if name and (folder, int(name[1])) not in kept:
                files.delete(part.getPath(), True)
