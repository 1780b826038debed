"""Session settings and the shared working folder.

Settings pinned for every job:

* ``spark.sql.session.timeZone=UTC`` - all market times are zone-less UTC.
* AQE on (runtime coalescing, skew-join splitting).
* ``partitionOverwriteMode=dynamic`` - upserts replace only touched partitions.
* ZSTD Parquet.
* RocksDB streaming state (kept off the heap; needed by ``transformWithState``).

Scratch output (lineage cuts, staged writes, files a query lays down) goes to
the shared folder named by ``spark.checkpoint.dir``. On a cluster that setting
must point at shared storage; a local default is only set when it is absent
(tests, local runs).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Starting points for a large cluster (hundreds of executors, ~100 TB of ticks):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, 256 MB
# scan splits, skew splitting on. Broadcasts stay size-checked by Spark.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "candlewright", extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """``profile="cluster"`` applies :data:`CLUSTER_CONF` (``shuffle_partitions``
    is then ignored); ``extra`` overrides both."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    profile_conf = CLUSTER_CONF if profile == "cluster" else {}
    for k, v in {**PINNED_CONF, **profile_conf, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the session settings on an existing session (the driver makes its own)."""
    for k, v in PINNED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``candlewright`` importable in Python workers (archive readers and
    writers run there): zip the package once per application into the shared
    folder and add it with ``addPyFile``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark).replace("file://", "").replace("file:", "")
    out_dir = os.path.join(root, "candlewright", "pyfiles", app)
    if re.match(r"[a-z][a-z0-9+.-]*:", out_dir):  # remote shared folder: stage the zip next to the driver instead
        out_dir = tempfile.mkdtemp(prefix="candlewright-pyfiles-")
    os.makedirs(out_dir, exist_ok=True)
    zpath = os.path.join(out_dir, "candlewright.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set a local one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="candlewright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, unique per call."""
    root = checkpoint_root(spark)
    return os.path.join(root, "candlewright", name, uuid.uuid4().hex)
