"""Zone map of the raw layer: which file holds which offsets and times.

``replay`` over a folder lists and opens the footers of all its files.  The
index has one row per file, topic and partition with the least and greatest
offset and Kafka time, kept up by landing from the new files alone, so a replay
of a week or of a range of offsets opens the files that overlap it only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.exprs import lit_ntz
from fleetlake.schemas import BRONZE_EVENTS_SCHEMA
from fleetlake.sinks import TableStore

INDEX = "replay_index"
_PLACE = ("topic", "partition")


def _raw(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(BRONZE_EVENTS_SCHEMA).parquet(*paths)


def zones(raw: DataFrame) -> DataFrame:
    """``(file, topic, partition, min/max offset, min/max time, records)`` of the files of ``raw``."""
    return (raw.select(F.col("_metadata.file_path").alias("file"), *_PLACE, "offset", "timestamp").groupBy("file", *_PLACE)
            .agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"),
                 F.min("timestamp").alias("min_time"), F.max("timestamp").alias("max_time"), F.count(F.lit(1)).alias("records")))


def index_landed(store: TableStore, *paths: str) -> int:
    """Add the files under ``paths`` that the index lacks; returns how many were added.

    Which files are new is asked of the listing, so indexed files are not opened.
    """
    spark = store.spark
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(list(paths))
    listed = files.select(F.col("_metadata.file_path").alias("file"))
    if store.exists(INDEX):
        listed = listed.join(store.read(INDEX).select("file").distinct(), "file", "left_anti")
    new = [r["file"] for r in listed.collect()]
    if new:
        store.write_append(INDEX, zones(_raw(spark, *new)).coalesce(1))
    return len(new)


def files_between(index: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Files that may hold records with ``start <= timestamp < end``."""
    if start is not None:
        index = index.filter(F.col("max_time") >= lit_ntz(start))
    if end is not None:
        index = index.filter(F.col("min_time") < lit_ntz(end))
    return index.select("file").distinct()


def files_of_offsets(index: DataFrame, ranges: DataFrame) -> DataFrame:
    """Files that may hold offsets of ``ranges(topic, partition, from_offset, to_offset)``, ends included."""
    r = ranges.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "from_offset", "to_offset")
    hit = ((F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p"))
           & (F.col("min_offset") <= F.col("to_offset")) & (F.col("max_offset") >= F.col("from_offset")))
    return index.join(r, hit, "left_semi").select("file").distinct()


def _open(store: TableStore, files: DataFrame) -> DataFrame:
    """The raw records of these files; the driver gets the names of the files that the replay reads."""
    names = sorted(r["file"] for r in files.collect())
    return _raw(store.spark, *names) if names else store.spark.createDataFrame([], BRONZE_EVENTS_SCHEMA)


def replay_between(store: TableStore, start: str | None = None, end: str | None = None) -> DataFrame:
    """The records of ``sources.kafka.replay``, from the files of the index that overlap the range."""
    df = _open(store, files_between(store.read(INDEX), start, end))
    if start is not None:
        df = df.filter(F.col("timestamp") >= lit_ntz(start))
    if end is not None:
        df = df.filter(F.col("timestamp") < lit_ntz(end))
    return df


def replay_offsets(store: TableStore, ranges: DataFrame) -> DataFrame:
    """Records by offset: those of ``ranges(topic, partition, from_offset, to_offset)``, ends included, once each."""
    df = _open(store, files_of_offsets(store.read(INDEX), ranges))
    r = ranges.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "from_offset", "to_offset")
    return df.join(r, (df["topic"] == F.col("_t")) & (df["partition"] == F.col("_p"))
                   & df["offset"].between(F.col("from_offset"), F.col("to_offset")), "left_semi")
