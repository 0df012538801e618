"""Helpers shared by the corpus operators: table access, lineage cuts, word splitting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one run under the cluster's ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark).rstrip('/')}/fleetlake-llm/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts the lineage, so a lost
    executor costs one file read instead of the whole job, and later readers share the work."""
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of a text table in one Arrow batch; Spark's default of 10,000 can be a gigabyte of long texts
BATCH_ROWS = 1000


def in_batches(df: DataFrame, run, schema, batch_bytes: int | None = None) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches of at most ``BATCH_ROWS`` rows and, if given, about
    ``batch_bytes``, which bounds what a task holds on both sides of the pipe.  The settings are the session's: they
    stay, and only ever get smaller."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", batch_bytes)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(conf.get(key).rstrip("bB")) if most else 0
        if most and (now <= 0 or now > most):
            conf.set(key, str(most))
    return df.mapInArrow(run, schema)


def blobs(column) -> list:
    """UTF-8 bytes (or None) of an Arrow string column."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()


def free(name: str, *taken: str) -> str:
    """``name``, with underscores before it until no column of ``taken`` is called so in any case."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name = "_" + name
    return name


def width(spark: SparkSession) -> int:
    """The session's shuffle width, which the cluster sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
