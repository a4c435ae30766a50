"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "zoneflow") -> SparkSession:
    """A local session for tests and the bench. Clusters pass their own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a folder every executor can reach) and is only
    read here; without it this raises. On a local master (tests), where the driver is the only
    machine, a fresh scratch folder is set for this session.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="zoneflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """Whether one process on one machine runs everything (``local``, ``local[8]``, not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder; ``unique`` appends a fresh id."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return "/".join([base, *tail]) if "://" in base else os.path.join(base, *tail)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries (none if it is missing)."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def intermediate_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder for an intermediate table. Frames that read it are
    lazy, so it stays while the application lives and is removed when the application ends (the
    file system deletes it on exit); ``remove_path`` removes it earlier."""
    path = shared_path(spark, "zoneflow-intermediate", name, unique=True)
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)  # only what exists can be marked; the table itself lies in it
    fs.deleteOnExit(target)
    return f"{path}/table"


# Settings for a large cluster (runtime SQL settings; a deployment may override any of them).
CLUSTER_CONF = {
    # AQE re-plans from runtime sizes: joins become broadcasts only when a side is measured small,
    # small shuffle partitions are merged and skewed ones split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Scan splits sized for executor memory; many files make many tasks.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Streaming state (latest reading per zone) in RocksDB: large populations stay off-heap,
    # and the state is versioned in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_cluster_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply ``CLUSTER_CONF`` (and an initial shuffle width, which AQE then coalesces).

    Streaming queries fix their shuffle width at the first checkpoint, so set it before the
    first start of a stream.
    """
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    ensure_checkpoint_dir(spark)
    return spark
