"""Session factory (C6) and shared-folder lookup."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Streaming state is partitioned by the shuffle width of the first run; it stays fixed for the life of a
# checkpoint, so streams name it.  Batch jobs size theirs from their input (``size_batch``).
STREAM_SHUFFLE = 16


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app: str = "fleetlake", master: str | None = None, *, state_store: str = "default",
              stream: bool = False, **conf: str) -> SparkSession:
    """Build or reuse a session with UTC and AQE.

    ``stream=True`` fixes the shuffle width that a stream's checkpoint is tied
    to.  ``state_store="rocksdb"`` keeps streaming state off the JVM heap, for
    windows over many vehicles or long watermarks.  Extra settings are passed
    as keywords with ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {**DEFAULT_CONF, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    if stream:
        merged.setdefault("spark.sql.shuffle.partitions", str(STREAM_SHUFFLE))
    if state_store == "rocksdb":
        merged["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system as Hadoop resolves them (default file system included)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def size_batch(spark: SparkSession, *paths: str, target_bytes: int = 128 << 20) -> int:
    """Set the shuffle width of a batch job from the bytes of its inputs: one partition per
    ``target_bytes``, two per core at least; AQE merges what turns out small.  Returns the width."""
    total = 0
    for path in paths:
        p, fs = hadoop_path(spark, path)
        total += fs.getContentSummary(p).getLength()
    width = max(2 * spark.sparkContext.defaultParallelism, -(-total // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may run without that setting: it then gets a
    temporary folder, registered so that later calls agree.  On a cluster each
    executor would write to its own disk, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fleetlake-")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])
