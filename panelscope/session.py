"""Spark session helpers.

Cluster jobs get their session (and `spark.checkpoint.dir`) from the cluster;
`local_session` is for tests, the bench and the examples only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package expects; safe on a cluster as well.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Plan text is built for every adaptive re-plan; cap it so deep plans stay cheap.
    "spark.sql.maxPlanStringLength": "1000000",
}


# Recommended settings for a large cluster (applied by whoever builds the cluster
# session; jobs never override the cluster's own `spark.checkpoint.dir`).
CLUSTER_CONF = {
    **JOB_CONF,
    # Start with many shuffle partitions; AQE coalesces them to ~advisory size.
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Broadcasts are hinted only behind counts; keep the automatic threshold modest.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelscope",
                  extra_conf: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PANELSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once their DataFrames are garbage-collected.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**JOB_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    A folder already set on the context wins, then the setting. Only a local
    session (one machine) may have neither; it then gets a fresh scratch folder.
    """
    of_context = spark.sparkContext._jsc.sc().getCheckpointDir()
    if of_context.isDefined():
        return of_context.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="panelscope-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured
