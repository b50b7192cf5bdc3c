"""Spark session defaults and the shared scratch folder.

The library never creates a session behind the caller's back: every operator
takes DataFrames, every job takes a ``SparkSession``.  ``lake_session`` is a
convenience for tests, notebooks and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the lake relies on.  Session time zone: all key
# derivations are zone-independent (see functions/time.py), but collected
# TIMESTAMP values are rendered in the session zone, so UTC keeps them equal to
# the stored instants.
LAKE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Local mode only: one JVM holds driver and executors; tiny test tables should
# still spread over the cores (AQE would merge them into one task); and listing
# a local disk from the driver beats a distributed listing job (which pays off
# on HDFS / object stores, where the default threshold stays).
LOCAL_CONF = {
    "spark.driver.memory": os.environ.get("LAKE_DRIVER_MEMORY", "16g"),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000000",
}


def lake_session(
    master: str | None = None,
    app_name: str = "telemetry_lake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the lake's settings.

    ``master`` defaults to ``local[$BENCH_CPUS or *]``; on a cluster pass the
    session from ``spark-submit`` to the jobs instead of calling this.
    """
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LAKE_CONF)
    if master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Render collected timestamps in UTC (the zone of every stored key)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system or object store);
    a machine-local temporary folder is used only in local mode, where the
    setting is unset in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: configuration only
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        root = tempfile.mkdtemp(prefix="telemetry-lake-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/telemetry_lake/{name}-{uuid.uuid4().hex}"
