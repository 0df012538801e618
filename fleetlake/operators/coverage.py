"""Incremental audit of missing offsets: intervals of covered offsets, merged load by load.

The full audit (``analytics.offset_gaps``) reads every offset ever landed.  Here
a load is reduced to its covered intervals, which are merged with the stored
ones; old bronze is never read again.  The stored table has one row per hole
and a little more, whatever the length of the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.sinks import TableStore

PLACE = ["topic", "kafka_partition"]
COVERED = "covered_offsets"


def covered(bronze: DataFrame, topic_col: str = "topic", partition_col: str = "partition", offset_col: str = "offset",
            bucket_size: int = 1 << 20) -> DataFrame:
    """``(topic, kafka_partition, lo, hi)``: maximal runs of consecutive offsets of a load.

    Islands are found inside buckets of ``bucket_size`` offsets (offset less row
    number is constant within one), so a Kafka partition of any length is
    dealt to many tasks; neighbouring buckets' islands are then merged.
    Repeated offsets count once; rows without an offset are left out.
    """
    one = (bronze.select(F.col(topic_col).alias("topic"), F.col(partition_col).alias("kafka_partition"), F.col(offset_col).alias("o"))
           .filter(F.col("o").isNotNull()).distinct().withColumn("b", F.floor(F.col("o") / bucket_size)))
    island = F.col("o") - F.row_number().over(Window.partitionBy(*PLACE, "b").orderBy("o"))
    runs = one.withColumn("island", island).groupBy(*PLACE, "b", "island").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))
    return merged(runs.select(*PLACE, "lo", "hi"))


def merged(intervals: DataFrame) -> DataFrame:
    """Overlapping and adjacent intervals of a Kafka partition put together.

    An interval opens a new one when it starts beyond all that came before it;
    a running count of the openings numbers the results.
    """
    ordered = Window.partitionBy(*PLACE).orderBy("lo", "hi")
    reached = F.max("hi").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("lo") > reached + 1), 1).otherwise(0)
    numbered = intervals.withColumn("opens", opens).withColumn(
        "run", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*PLACE, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def holes(intervals: DataFrame) -> DataFrame:
    """The gaps between the covered intervals, in the shape of ``analytics.offset_gaps``."""
    following = F.lead("lo").over(Window.partitionBy(*PLACE).orderBy("lo"))
    return (intervals.withColumn("next", following).filter(F.col("next").isNotNull())
            .select(*PLACE, (F.col("hi") + 1).alias("missing_start"), (F.col("next") - 1).alias("missing_end"),
                    (F.col("next") - F.col("hi") - 1).alias("missing_count")))


def audit_load(store: TableStore, load: DataFrame, bucket_size: int = 1 << 20) -> DataFrame:
    """Merge a load into the stored intervals and return the holes that are left; late rows close theirs.

    Loading the same rows again changes nothing.
    """
    now = covered(load, bucket_size=bucket_size)
    if store.exists(COVERED):
        now = merged(store.read(COVERED).unionByName(now))
    store.write_refresh(COVERED, now)
    return holes(store.read(COVERED))
