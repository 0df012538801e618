"""Slowly-changing dimension, type 2, without MERGE.

``scd2_apply`` returns the complete next snapshot of the dimension; the
caller writes it to a new location and swaps (``sinks.write_refresh``), so
the path being read is never overwritten.  One full outer join on the
business key decides every active row; closed history is passed through by a
second read of the dimension.  An empty or missing dimension makes the same
code a full load.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.exprs import lit_ntz, null_safe_changed, surrogate_key
from fleetlake.sinks import TableStore

# Open-ended validity and the attributes whose change opens a new version.
OPEN_END = "9999-12-31 00:00:00"
ROUTE_ATTRS = ("route_short_name", "route_long_name", "route_type")
STOP_ATTRS = ("stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id", "parent_station",
              "wheelchair_boarding", "platform_code", "vehicle_type", "radius")


def scd2_version(stg: DataFrame, key: str, now: str | _dt.datetime) -> DataFrame:
    """Staged rows as new active versions starting at ``now``."""
    t = lit_ntz(now)
    return (stg.withColumn("effective_start_dt", t)
            .withColumn("effective_end_dt", lit_ntz(OPEN_END))
            .withColumn("active_flg", F.lit(1))
            .withColumn("insert_dt", t)
            .withColumn("update_dt", t)
            .withColumn("row_wid", surrogate_key(F.col(key), F.date_format(t, "yyyy-MM-dd HH:mm:ss"))))


def _active(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("active_flg") == 1)


def new_or_changed_keys(stg: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str] = (),
                        now: str | _dt.datetime = OPEN_END, null_safe: bool = True) -> DataFrame:
    """Staged rows that get a new version (J2): the key has no active version, or, given ``attrs``, had
    one that this load closes.  ``left_anti``, not outer join + IS NULL."""
    kept = _active(dim).select(key)
    if attrs:
        kept = kept.join(scd2_close(dim, stg, key, attrs, now, null_safe).select(key), key, "left_anti")
    return stg.join(kept, key, "left_anti")


def scd2_close(dim: DataFrame, stg: DataFrame, key: str, attrs: Sequence[str], now: str | _dt.datetime,
               null_safe: bool = True) -> DataFrame:
    """Active versions that a changed staged row closes, as they look after closing."""
    t = lit_ntz(now)
    s = stg.select(key, *attrs)
    j = _active(dim).alias("d").join(s.alias("s"), F.col(f"d.{key}") == F.col(f"s.{key}"), "inner")
    closed = j.filter(null_safe_changed("d", "s", attrs, null_safe)).select("d.*")
    return _closed(closed, t)


def _closed(rows: DataFrame, t) -> DataFrame:
    return (rows.withColumn("effective_end_dt", t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1)))
            .withColumn("active_flg", F.lit(0))
            .withColumn("update_dt", t))


def scd2_apply(dim: DataFrame | None, stg: DataFrame, key: str, attrs: Sequence[str],
               now: str | _dt.datetime, null_safe: bool = True) -> DataFrame:
    """Next dimension snapshot after loading ``stg`` at ``now``.

    * key active and an attribute changed -> old version closed
      (end = now - 1 s, ``active_flg`` 0) and a new version opened;
    * key active and unchanged, or absent from ``stg`` -> kept as is;
    * key new -> new version; closed history -> kept.

    ``null_safe=False`` compares with plain ``<>`` and so misses changes to
    or from NULL, as a MERGE with ``<>`` conditions does.
    """
    new = scd2_version(stg, key, now)
    cols = new.columns
    if dim is None:
        dim = new.limit(0)
    dim = dim.select(*cols)
    t = lit_ntz(now)
    j = _active(dim).alias("d").join(new.alias("s"), F.col(f"d.{key}") == F.col(f"s.{key}"), "full_outer")
    has_d, has_s = F.col(f"d.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = has_d & has_s & null_safe_changed("d", "s", attrs, null_safe)
    one_sec = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    old = F.struct(*[
        (F.when(changed, t - one_sec).otherwise(F.col("d.effective_end_dt")) if c == "effective_end_dt"
         else F.when(changed, F.lit(0)).otherwise(F.col("d.active_flg")) if c == "active_flg"
         else F.when(changed, t).otherwise(F.col("d.update_dt")) if c == "update_dt"
         else F.col(f"d.{c}")).alias(c)
        for c in cols])
    opened = F.struct(*[F.col(f"s.{c}").alias(c) for c in cols])
    out = j.select(F.explode(F.array_compact(F.array(
        F.when(has_d, old),
        F.when(has_s & (~has_d | changed), opened),
    ))).alias("r")).select("r.*")
    return out.unionByName(dim.filter(F.col("active_flg") != 1))


def bucket_of(key: str, buckets: int):
    """Hash bucket of a business key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def scd2_touched(stg: DataFrame, active: DataFrame, key: str, attrs: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Staged keys that a load changes: without an active version, or with one whose attributes differ."""
    d = active.select(key, *attrs).alias("d")
    j = stg.select(key, *attrs).alias("s").join(d, F.col(f"s.{key}") == F.col(f"d.{key}"), "left")
    hit = F.col(f"d.{key}").isNull() | null_safe_changed("d", "s", attrs, null_safe)
    return j.filter(hit & F.col(f"s.{key}").isNotNull()).select(F.col(f"s.{key}").alias(key)).distinct()


def scd2_load(store: TableStore, name: str, stg: DataFrame, key: str, attrs: Sequence[str], now: str | _dt.datetime,
              buckets: int = 64, null_safe: bool = True) -> list[int]:
    """Load ``stg`` into a dimension kept in hash buckets of its key; returns the buckets rewritten.

    The active keys and attributes of the dimension are compared with the
    staged ones first.  Only buckets that hold a new or changed key are then
    read, put through ``scd2_apply`` with their staged rows, and written; all
    others stay as they are, so a daily load that changes one key in a
    dimension of a billion rewrites one bucket.  ``buckets`` is fixed by the
    first load (later ones take it from the stored table) and bounds what the
    driver sees: bucket numbers.
    """
    current = store.read_parts(name)
    if current is None:
        first = scd2_apply(None, stg, key, attrs, now, null_safe)
        return sorted(int(p) for p in store.replace_parts(name, first, bucket_of(key, buckets), map(str, range(buckets))))
    buckets = len(store.parts(name))
    hit = scd2_touched(stg, current.filter(F.col("active_flg") == 1), key, attrs, null_safe)
    touched = sorted(r["b"] for r in hit.select(bucket_of(key, buckets).alias("b")).distinct().collect())
    if not touched:
        return []
    ours = bucket_of(key, buckets).isin(touched)
    nxt = scd2_apply(store.read_parts(name, map(str, touched)), stg.filter(ours), key, attrs, now, null_safe)
    store.replace_parts(name, nxt, bucket_of(key, buckets), map(str, touched))
    return touched


def scd2_dimension(store: TableStore, name: str) -> DataFrame:
    """The whole dimension as ``scd2_load`` keeps it."""
    return store.read_parts(name)
