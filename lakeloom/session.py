"""Session builder and shared-folder helpers.

Every operator in this package is a plain function from DataFrame to DataFrame, so
the session is the only place where execution settings live: ANSI on, UTC, AQE
(coalesce, skew join, runtime broadcast), case-insensitive names.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting values for a large cluster (hundreds of executors, ~100 TB inputs). Many
# shuffle partitions with AQE coalescing keeps each reducer near the advisory size
# whatever the stage volume; skewed join partitions are split; a side is broadcast
# only when its runtime size is under the adaptive threshold.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "lakeloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test builder; with a cluster's master the settings of ``CLUSTER_CONF`` apply."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not master.startswith("local"):
        conf.update(CLUSTER_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if master.startswith("local"):
        ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not run where
    the driver does."""
    sc = spark.sparkContext
    if getattr(sc, "_lakeloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lakeloom-zip-"), "lakeloom_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _dirs, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(target)
    sc._lakeloom_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names it. Only a local master (one machine, tests) gets a private folder of
    its own where it is unset; on a cluster that folder would not be shared, so this raises.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        cur = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder.

    Jobs that stage data (file fixtures, manifests, quarantine) write here so that
    every executor sees the same path and lineage can be cut by a written table.
    """
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
