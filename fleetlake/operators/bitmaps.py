"""Exact distinct counts that merge: dense ids and bitmaps per day and route.

``count(distinct)`` can't be added up over days, and a report over all history
reads all of the fact.  Here every vehicle, stop and direction gets a dense
number once, and each day's fact is reduced to bitmaps of the numbers seen per
route.  Bitmaps are merged with OR and counted with popcount, so a report over
any days reads a few KB per day and route and not the fact, and nothing is
expanded per distinct column.  A bitmap covers 32,768 numbers; more numbers
take more rows, each merged by itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.operators.gold import join_active_dim
from fleetlake.sinks import TableStore

# What is counted: the name of a kind of bitmap and the fact's column.
KINDS = {"vehicle": "vehicle_number", "stop": "stop", "direction": "direction_id"}
ROUTE_DAY = ["oday", "route_id", "route"]
BITMAPS = "route_day_bitmaps"
_SPREAD = 64


def dense_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``(value, id)`` of the values of ``column`` that ``known(value, id)`` lacks: the next whole numbers, from 1.

    Numbers are given per hash bucket, each bucket starting where the ones
    before it end, so no task sees all values; gaps never arise.
    """
    new = values.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known, "value", "left_anti")
        start = F.coalesce(known.select(F.max("id")).scalar(), start)
    new = new.withColumn("b", F.pmod(F.xxhash64("value"), F.lit(_SPREAD)))
    # one row a bucket: the only window without a partition
    before = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = new.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select("b", F.coalesce(before, F.lit(0)).alias("o"))
    ranked = new.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("value")))
    return ranked.join(F.broadcast(offsets), "b").select("value", (start + F.col("o") + F.col("r")).cast("long").alias("id"))


def bitmaps_of(fact: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """``(oday, route_id, route, kind, bucket, bits)`` of a fact; ``ids``: ``(value, id)`` of each kind."""
    out = None
    for kind, column in KINDS.items():
        # the pairs are made unique before anything else, map side first: a hot route is a few rows a task
        seen = fact.select(*ROUTE_DAY, F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
        own = (seen.join(ids[kind], "value")
               .groupBy(*ROUTE_DAY, F.lit(kind).alias("kind"), F.bitmap_bucket_number("id").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))
        out = own if out is None else out.unionByName(own)
    return out


def refresh_bitmaps(store: TableStore, fact: DataFrame, days: Iterable | None = None) -> list[str]:
    """Bring the stored bitmaps up to date for ``days`` (all days of ``fact`` if None); returns the days written.

    New values are numbered first and appended to the stored dictionaries; the
    bitmaps of the given days are then made from those days of the fact alone
    and replace the stored ones of these days.
    """
    load = fact if days is None else fact.filter(F.col("oday").isin([str(d) for d in days]))
    ids = {}
    for kind, column in KINDS.items():
        name = f"ids_{kind}"
        known = store.read(name) if store.exists(name) else None
        store.write_append(name, dense_ids(load, column, known))
        ids[kind] = store.read(name)
    return store.replace_parts(BITMAPS, bitmaps_of(load, ids), F.col("oday"), [str(d) for d in days or ()])


def day_bitmaps(store: TableStore, days: Iterable | None = None) -> DataFrame:
    return store.read_parts(BITMAPS, None if days is None else [str(d) for d in days])


def distinct_counts(bitmaps: DataFrame, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """``keys`` and, for each kind, its number of distinct values (``kinds``: kind -> name of the column)."""
    merged = (bitmaps.filter(F.col("kind").isin(list(kinds))).groupBy(*keys, "kind", "bucket")
              .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
    return merged.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("long").alias(name) for k, name in kinds.items()])


def route_density(bitmaps: DataFrame, routes: DataFrame, n: int = 10) -> DataFrame:
    """A7 from the bitmaps of a day."""
    counted = distinct_counts(bitmaps, ROUTE_DAY, {"vehicle": "bus_count", "stop": "unique_stops"})
    j = join_active_dim(counted, routes, "route_id", columns=["route_short_name", "route_long_name", "route_type"])
    ratio = F.round(F.col("bus_count").cast("double") / F.nullif(F.col("unique_stops"), F.lit(0)).cast("double"), 2)
    return (j.withColumn("veh_to_stops_ratio", ratio)
            .orderBy(F.col("veh_to_stops_ratio").desc_nulls_last(), "route_id").limit(n))


def route_bus_count(bitmaps: DataFrame, n: int = 10) -> DataFrame:
    """A12 from the bitmaps of any days."""
    return (distinct_counts(bitmaps, ["oday", "route_id"], {"vehicle": "bus_count"})
            .orderBy(F.col("bus_count").desc(), "oday", "route_id").limit(n))


def route_stop_coverage(bitmaps: DataFrame, n: int = 10) -> DataFrame:
    """A13 from the bitmaps of any days: merged over days, both directions together."""
    return (distinct_counts(bitmaps, ["route_id"], {"stop": "unique_stops", "direction": "directions"})
            .orderBy(F.col("unique_stops").desc(), "route_id").limit(n))
