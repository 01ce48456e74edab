"""Session helpers.

Library code never creates a session; it takes the caller's. ``build_session`` exists for
tests and the bench, and ``shared_dir`` resolves where durable intermediate tables go.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed session settings the data model depends on (timestamps are UTC-anchored).
UTC = "UTC"


# Settings for a large cluster (hundreds of executors, ~100 TB inputs). Partition sizes are
# driven by bytes, not counts: scans split at 256 MB, AQE starts from many shuffle partitions
# and coalesces them to ~256 MB, and splits skewed join partitions. Broadcasts stay under a
# fixed size threshold checked by the planner on measured sizes.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": UTC,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", app: str = "ledgerspark", shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None, extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERSPARK_DRIVER_MEMORY", "8g"))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in {**(CLUSTER_CONF if cluster else {}), **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone; the daily grain shifts otherwise."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for durable intermediate tables (``spark.checkpoint.dir``).

    Read from the session. Where it is unset, a local master (tests) gets a temporary folder of its
    own; on a cluster, whose executors would each write to their own disk, this raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for durable tables")
        path = tempfile.mkdtemp(prefix="ledgerspark-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a durable intermediate table."""
    return f"{shared_dir(spark)}/ledgerspark/{name}-{uuid.uuid4().hex}"
