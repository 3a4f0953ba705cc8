"""Session helpers.

Library code never creates its own session on a cluster: it takes the caller's
``SparkSession``. ``local_session`` exists for tests, the bench and notebooks.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode stays on (Spark default); the code is
# written against it (``try_divide`` etc.). The session time zone must be UTC so
# that naive parquet timestamps map to the same calendar day everywhere.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "eqlake") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("EQLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


#: Bytes of a source's files whose rows one task aggregates or sorts, about.
SOURCE_BYTES_PER_TASK = 4 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tasks_for(spark: SparkSession, n_bytes: int) -> int:
    """Partitions for rows that come from ``n_bytes`` of files: in proportion to them, so a task's share
    stays the same whatever the size; small sources keep the cores busy."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(least, math.ceil(n_bytes / SOURCE_BYTES_PER_TASK))


def size_shuffles(spark: SparkSession, n_bytes: int) -> None:
    """Shuffles of what follows start with partitions in proportion to the source (never fewer than
    ``spark.sql.shuffle.partitions``); AQE joins those that turn out small."""
    spark.conf.set(_INITIAL, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks_for(spark, n_bytes))))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that shuffles start with now (Spark checks the default of an unset number as well, so there is none)."""
    return max(int(spark.conf.get(_INITIAL, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets ``spark.checkpoint.dir`` to a shared folder
    (HDFS/object store); it is read and used as is. Only when it is unset and the
    master is local (tests, a laptop) a private scratch folder is created and registered;
    a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    scratch = tempfile.mkdtemp(prefix="eqlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch
