"""Session construction and the shared scratch location.

Scratch tables (staged loads, lineage cuts) live under the folder the
cluster names in ``spark.checkpoint.dir``. A local folder is created only in
local mode and when that setting is absent, as in tests; on a cluster its
absence is an error, since executors would write to disks of their own.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI on (Spark 4 default) with try_* casts,
# AQE for runtime re-planning and skew splitting, and UTC session time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Page extraction ships whole HTML documents per Arrow batch: keep batches
    # small enough that a batch of large pages fits comfortably in a worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}

MB = 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * MB) -> dict:
    """Partition sizing for a given input volume (e.g. 100 TB on 1000 executors).

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` so a
    task's working set fits executor memory without spilling; AQE starts from
    that many shuffle partitions and coalesces small ones at runtime, and
    splits skewed ones.
    """
    parts = max(total_cores * 3, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata", extra: dict | None = None,
                input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Session with the engine's settings; with ``input_bytes`` and ``total_cores``
    the partition sizing of ``scale_conf`` is applied as well."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if input_bytes and total_cores:
        conf.update(scale_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is a cluster)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only in local mode and if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif is_local(sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {sc.master} shares")
    return sc.getCheckpointDir()


def workspace_path(spark: SparkSession, name: str) -> str:
    """A fresh directory path (not created) under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "strata", f"{name}-{uuid.uuid4().hex[:12]}")


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the jobs depend on (safe on an existing session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


_shipped: set = set()
_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in Python workers (as ``--py-files`` would).

    Only ``mapInPandas`` stages run Python on executors; they import the
    extraction rules from this package. The zip is built once per application
    and distributed by Spark's file server.
    """
    sc = spark.sparkContext
    with _ship_lock:
        if sc.applicationId in _shipped:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        zpath = os.path.join(tempfile.mkdtemp(prefix="strata-pyfiles-"), "strata.zip")
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        sc.addPyFile(zpath)
        _shipped.add(sc.applicationId)
