"""Session construction and cluster-aware settings.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with the settings the operators assume (UTC session time
zone, ANSI mode, adaptive execution with skew-join handling) and a helper that
resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on.  Shuffle partitions are sized by the caller
# (``local[8]`` wants ~8, a 1000-executor cluster wants thousands); AQE then
# coalesces small partitions and splits skewed ones at runtime.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, scan_partition_mb: int = 256, shuffle_partition_mb: int = 128) -> dict[str, str]:
    """Settings for a large cluster (for example 1000 executors reading 100 TB).

    Scans split into ``scan_partition_mb`` pieces (100 TB is about 400k tasks
    at 256 MB).  Shuffles start with three partitions per core and AQE merges
    them towards ``shuffle_partition_mb`` each, so a small stage does not run
    thousands of empty tasks and a large one keeps every partition within
    executor memory.  A partition over five times the median (and over 256 MB)
    is split by the skew-join rule.
    """
    return {
        "spark.sql.files.maxPartitionBytes": f"{scan_partition_mb}m",
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_partition_mb}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the operators in this package."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("TIDEMARK_DRIVER_MEMORY"):
        conf["spark.driver.memory"] = os.environ["TIDEMARK_DRIVER_MEMORY"]
    elif (master or "").startswith("local"):
        conf["spark.driver.memory"] = "4g"  # one JVM holds the executor too
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS, object store); it is read from the session and never
    replaced.  Only in local mode is a scratch folder chosen when it is unset; on a
    cluster that is an error, as executors could not see a folder of the driver's.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
