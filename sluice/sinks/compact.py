"""Lake tables that micro-batches append to, and their compaction.

Every micro-batch writes a folder of its own (``batch_id=N``), which leaves many small files.
``compact`` takes all complete batches that are not compacted yet, plans output files by their
measured bytes, writes them into one folder, and then a manifest that names the compacted
folders and the last batch in them. ``read_lake`` follows the newest complete manifest and adds
the batches behind it, so a reader sees every row once before, during and after a compaction.
Batches and folders that the last two manifests do not need are removed one compaction later,
which leaves readers at work their files.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import path_files
from .lake import CODEC, TARGET_FILE_BYTES

MANIFEST = "folder string, last_batch bigint"
_SLICE, _FILE = "_slice", "_file"


def _complete(spark: SparkSession, path: str, pattern: str) -> dict[int, str]:
    """Number and name of each folder that a write has finished."""
    files, root = path_files(spark, path)
    found = {}
    for entry in files.listStatus(root) if files.exists(root) else ():
        name = re.fullmatch(pattern, entry.getPath().getName())
        if name and files.exists(path_files(spark, f"{path}/{name[0]}/_SUCCESS")[1]):
            found[int(name[1])] = name[0]
    return found


def _newest(spark: SparkSession, path: str) -> tuple[int, list[str], int]:
    """Number of the newest manifest, its folders, and the last batch in them."""
    known = _complete(spark, f"{path}/_manifests", r"version=(\d+)")
    if not known:
        return -1, [], -1
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/_manifests/{known[max(known)]}").collect()
    return max(known), sorted(r["folder"] for r in rows if r["folder"]), max(r["last_batch"] for r in rows)


def _has_data(spark: SparkSession, folder: str) -> bool:
    """A micro-batch without rows leaves a folder without files when it is partitioned."""
    files, root = path_files(spark, folder)
    walk = files.listFiles(root, True)
    while walk.hasNext():
        if not walk.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The folders' rows; each has partition columns below it, so each is a table of its own."""
    frames = [spark.read.option("basePath", folder).parquet(folder) for folder in folders if _has_data(spark, folder)]
    if not frames:
        raise FileNotFoundError(f"no rows in {', '.join(folders) or 'a table without batches'}")
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of micro-batches, compacted or not."""
    _, folders, last = _newest(spark, path)
    batches = [name for number, name in sorted(_complete(spark, path, r"batch_id=(\d+)").items()) if number > last]
    return _read(spark, [f"{path}/_compacted/{f}" for f in folders] + [f"{path}/{b}" for b in batches])


def _bytes_by_partition(spark: SparkSession, folder: str) -> dict[tuple, int]:
    """Bytes of the data files below a folder, by their partition folders."""
    files, root = path_files(spark, folder)
    found: dict[tuple, int] = {}
    walk, base = files.listFiles(root, True), files.makeQualified(root).toString()
    while walk.hasNext():
        entry = walk.next()
        below = entry.getPath().toString()[len(base) + 1:].split("/")
        if not below[-1].startswith(("_", ".")):
            found[tuple(below[:-1])] = found.get(tuple(below[:-1]), 0) + entry.getLen()
    return found


def _dealt(df: DataFrame, sizes: dict[tuple, int], columns: list[str], target_bytes: int) -> DataFrame:
    """Rows dealt to one task for each planned file: a partition value gets as many files as
    its bytes ask for."""
    spark, rows, total = df.sparkSession, [], 0
    for place, size in sorted(sizes.items()):
        count = max(1, round(size / target_bytes))
        rows.append(("/".join(place), count, total))
        total += count
    plan = spark.createDataFrame(rows, "place string, files int, first int")
    # numbers that Spark's hash partitioning sends to tasks 0, 1, 2, ... of ``total``
    numbers = spark.range(0, 64 * total * max(1, math.ceil(math.log2(total + 1)))).select(F.pmod(F.hash("id"), F.lit(total)).alias("task"), "id")
    numbers = numbers.groupBy("task").agg(F.min("id").alias(_FILE))
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    place = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), value(c)) for c in columns]) if columns else F.lit("")
    slices = df.withColumn("place", place).join(F.broadcast(plan), "place", "left")
    own = F.coalesce("first", F.lit(0)) + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")]), F.coalesce("files", F.lit(1))).cast("int")
    slices = slices.withColumn("task", own).join(F.broadcast(numbers), "task")
    return slices.repartition(total, F.col(_FILE)).select(*[F.col(f"`{c}`") for c in df.columns])


def compact(spark: SparkSession, path: str, partition_columns: list[str] | None = None, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Merge all batches that are complete now; returns how many there were. Folders of earlier
    compactions stay as they are: their files have the right size already."""
    number, folders, last = _newest(spark, path)
    batches = {n: name for n, name in _complete(spark, path, r"batch_id=(\d+)").items() if n > last}
    if not batches:
        return 0
    names = [f"{path}/{name}" for _, name in sorted(batches.items())]
    if not any(_has_data(spark, name) for name in names):
        return 0
    sizes: dict[tuple, int] = {}
    for name in names:
        for place, size in _bytes_by_partition(spark, name).items():
            sizes[place] = sizes.get(place, 0) + size
    rows = _read(spark, names)
    columns = [c for c in partition_columns or [] if c in rows.columns]
    folder = f"upto={max(batches)}"
    writer = _dealt(rows, sizes, columns, target_bytes).write.mode("overwrite").option("compression", CODEC)
    (writer.partitionBy(*columns) if columns else writer).parquet(f"{path}/_compacted/{folder}")
    manifest = spark.createDataFrame([(f, max(batches)) for f in [*folders, folder]], MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifests/version={number + 1}")
    for old, name in _complete(spark, path, r"batch_id=(\d+)").items():
        if old <= last:  # in the manifest before this one already
            files, place = path_files(spark, f"{path}/{name}")
            files.delete(place, True)
    return len(batches)
