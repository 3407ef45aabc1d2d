"""Session helpers: the shared folder, lineage cuts and streaming defaults."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_fallback_dirs: dict[str, str] = {}


def build_session(app_name: str = "sluice", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library relies on. On a cluster leave
    ``master`` and ``shuffle_partitions`` to the submit command."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        # One machine: small data, so let small partitions keep all cores busy.
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``. Only on a
    local master without that setting (tests) a temporary folder stands in."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="sluice-")
    return _fallback_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call uses."""
    return f"{shared_dir(spark).rstrip('/')}/sluice/{label}-{uuid.uuid4().hex}"


def path_files(spark: SparkSession, path: str) -> tuple:
    """The path's file system and the path as its class has it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a path of ``scratch_path`` that no plan reads any more."""
    if "/sluice/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    files, target = path_files(spark, path)
    files.delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that several readers see the very same rows and
    a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def use_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors keep their state in RocksDB with changelog uploads."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def ship_with_tasks(module_name: str) -> None:
    """Send a module's functions and classes to Python workers by value, so they
    run on executors that do not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
