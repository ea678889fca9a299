"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle partitions to the advisory size instead of
    # keeping them for parallelism: fewer tiny tasks on a shared cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # checkpoint files go once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (not applied locally): AQE sizes the
# reduce side from measured map output, so the initial partition count only
# has to be an upper bound; skewed join partitions are split at runtime.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "emporium", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster, pass the master
    and let the cluster's spark-defaults supply the rest."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    in local mode (tests) do we pick a scratch folder of our own. On a
    cluster a missing setting is an error: a machine-local folder would not
    survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(checkpoints and written tables must survive lost executors)")
    local = tempfile.mkdtemp(prefix="emporium-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


#: Frames written at the same time: one that ends in few tasks leaves cores to the others.
LANDED_AT_ONCE = 4


def landed(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write each frame as Parquet under its path, a few at a time, and read it back: what several others read is computed once."""
    def one(item: tuple[str, DataFrame]) -> DataFrame:
        path, df = item
        df.write.option("compression", "snappy").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    with ThreadPoolExecutor(LANDED_AT_ONCE) as pool:
        return dict(zip(frames, pool.map(one, frames.items())))
