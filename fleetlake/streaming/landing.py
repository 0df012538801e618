"""Streaming landing into bronze with an idempotent ``foreachBatch`` (K1-K3).

Each micro-batch is written under ``landed=<day>/batch_id=<id>`` with dynamic
partition overwrite.  A batch replayed after a failure (same id, offsets and
batch time from the checkpoint) replaces its own partition instead of
appending a second copy: effectively exactly-once into bronze.  Readers that
want what is new list the days since their last load only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.functions.exprs import utc_ntz
from fleetlake.operators.envelope import journey_reason
from fleetlake.sinks import TableStore


def with_landing_time(stream: DataFrame) -> DataFrame:
    """``insert_time`` = micro-batch time as UTC ntz (one value per batch)."""
    return stream.withColumn("insert_time", utc_ntz(F.current_timestamp()))


def _by_batch(df: DataFrame, batch_id: int, day, target: str) -> None:
    """Write a micro-batch under its day and its id; a replay replaces exactly its own partitions."""
    (df.withColumn("landed", day).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("landed", "batch_id").parquet(target))


def append_batch(batch_df: DataFrame, batch_id: int, target: str, modes: Sequence[str] | None = None) -> None:
    """Idempotent append (K1).  With ``modes``, only ongoing journeys of these modes land; the others go
    to ``<target>_rejected`` with the reason (P13)."""
    day = F.col("insert_time").cast("date")
    if not modes:
        return _by_batch(batch_df, batch_id, day, target)
    fields = ("journey_type", "temporal_type", "transport_mode", "vehicle_number", "route_id")
    topic = {f: F.get_json_object("json_str", f"$.topic.{f}") for f in fields}
    judged = batch_df.withColumns({f"_{f}": c for f, c in topic.items()}).withColumn(
        "_tst", F.get_json_object("json_str", "$.payload.VP.tst"))
    judged = judged.withColumn("reject_reason", journey_reason(modes, prefix="_")).drop(*[f"_{f}" for f in (*fields, "tst")])
    judged.persist()
    try:
        _by_batch(judged.filter(F.col("reject_reason").isNull()).drop("reject_reason"), batch_id, day, target)
        _by_batch(judged.filter(F.col("reject_reason").isNotNull()), batch_id, day, f"{target}_rejected")
    finally:
        judged.unpersist()


def start_landing(stream: DataFrame, target: str, checkpoint: str, *, trigger: str | None = "10 seconds",
                  available_now: bool = False, query_name: str | None = None,
                  modes: Sequence[str] | None = None) -> StreamingQuery:
    """Start the bronze landing query; ``available_now`` drains the backlog and stops (backfill, tests)."""
    w = (with_landing_time(stream).writeStream
         .foreachBatch(lambda df, bid: append_batch(df, bid, target, modes))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def compact_days(store: TableStore, name: str, target: str, before: str) -> list[str]:
    """Put the small directories of whole landing days together: days before ``before`` that are not yet in the
    table ``name``, a part each (K1).  Returns those days.

    A 10 s trigger leaves 8,640 directories a day.  A day is closed once its
    last batch has landed, so it is copied once; ``read_landed`` then reads the
    copy, and the day's directories under ``target`` can go.
    """
    landed = store.spark.read.parquet(target)
    known = list(store.parts(name))
    fresh = landed.filter((F.col("landed") < F.lit(before).cast("date")) & ~F.col("landed").cast("string").isin(known))
    days = sorted(str(r[0]) for r in fresh.select("landed").distinct().collect())
    if days:
        only = landed.filter(F.col("landed").isin([F.lit(d).cast("date") for d in days]))
        store.replace_parts(name, only.drop("batch_id"), F.col("landed"))
    return days


def read_landed(store: TableStore, name: str, target: str) -> DataFrame:
    """All landed rows: days that ``compact_days`` has put together from its table, the others as they landed."""
    live, known = store.spark.read.parquet(target).drop("batch_id"), list(store.parts(name))
    if not known:
        return live
    return store.read_parts(name).select(live.columns).unionByName(live.filter(~F.col("landed").cast("string").isin(known)))
