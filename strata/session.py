"""Session helpers: recommended settings and a shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  ANSI mode stays on: every parse in
# ``strata.functions.clean`` uses a ``try_`` form, so bad text becomes null
# instead of failing the job.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a table of daily folders is listed by a few tasks of many folders each, not by a task per folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting points for a large cluster (about 100 TB of input), on top of
# RECOMMENDED_CONF.  The shuffle width is an upper bound that adaptive
# execution coalesces down to ``advisoryPartitionSizeInBytes`` per task
# (``parallelismFirst=false`` makes it honour that size instead of keeping
# many tiny tasks); skewed join and rebalance partitions are split to the
# same size.  Scans read 512 MB splits.  Broadcasts stay size-checked by the
# default threshold; nothing in the library forces one.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """A local session for tests and benchmarks (clusters bring their own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by whoever runs the job (it has to be
    visible to every executor).  Only a local-mode session without one gets a
    fresh temporary folder, which is then registered as its checkpoint dir
    and removed when the process ends.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="strata-ckpt-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
