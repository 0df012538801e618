"""Gold fact and star-schema joins."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.exprs import epoch_seconds, lit_ntz
from fleetlake.operators.scd2 import OPEN_END
from fleetlake.operators.silver import with_audit
from fleetlake.schemas import FACT_COLUMNS


def to_fact(silver: DataFrame, now: str | _dt.datetime) -> DataFrame:
    """Project the 20 business columns and stamp the audit columns."""
    return with_audit(silver.select(*FACT_COLUMNS), now)


def fact_new_rows(batch: DataFrame, existing: DataFrame,
                  key: Sequence[str] = ("vehicle_number", "tst"), partition_col: str = "oday") -> DataFrame:
    """Rows of ``batch`` not yet in the fact: the idempotent append set (K6).

    The days of the batch, one value each, are fetched first and filter the
    existing fact on its partition column: static pruning, so only the touched
    ``oday=`` directories are listed and read.  Keys match null-safely.
    """
    days = [r[0] for r in batch.select(partition_col).distinct().collect()]
    touched = F.col(partition_col).isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col(partition_col).isNull()
    keys = [partition_col, *key]
    old = existing.filter(touched).select(*[F.col(c).alias(f"_old_{c}") for c in keys])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return batch.join(old, same, "left_anti")


def active(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("active_flg") == 1)


def join_active_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                    columns: Sequence[str] | None = None, how: str = "inner") -> DataFrame:
    """Fact rows joined to the active version of their dimension row.

    No hint: the planner broadcasts the dimension when its measured bytes are
    small and splits hot keys of the fact when they are not.
    """
    dim_key = dim_key or fact_key
    cols = [c for c in (columns or dim.columns) if c != dim_key]
    d = active(dim).select(F.col(dim_key).alias("_dim_key"), *cols)
    return fact.join(d, F.col(fact_key) == F.col("_dim_key"), how).drop("_dim_key")


def dim_versions(dim: DataFrame, key: str) -> DataFrame:
    """Dimension rows with ``valid_from``/``valid_to`` = ``[effective_start_dt, next start)``.

    The window is per business key; a key has a handful of versions, so no
    partition grows with the fact.  The open end of the current version is
    NULL.
    """
    w = Window.partitionBy(key).orderBy("effective_start_dt")
    return (dim.withColumn("valid_from", F.col("effective_start_dt"))
            .withColumn("valid_to", F.lead("effective_start_dt").over(w)))


def dim_as_of(dim: DataFrame, key: str, at: str | _dt.datetime) -> DataFrame:
    """The dimension exactly as it stood at ``at`` (J5): a version closed later was active and open then."""
    t = lit_ntz(at)
    v = dim_versions(dim, key)
    return (v.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))
            .withColumn("active_flg", F.lit(1))
            .withColumn("effective_end_dt", lit_ntz(OPEN_END))
            .withColumn("update_dt", F.when(F.col("update_dt") > t, F.col("insert_dt")).otherwise(F.col("update_dt")))
            .drop("valid_from", "valid_to"))


def join_as_of(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, ts_col: str,
               columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Each fact row with the dimension version valid at its own timestamp.

    Equi-join on the key plus a range condition: the key drives a hash join,
    the range is a residual filter over the few versions of that key.
    """
    v = dim_versions(dim, dim_key).select(
        F.col(dim_key).alias("_dim_key"), "valid_from", "valid_to", *[c for c in columns if c != dim_key])
    cond = ((F.col(fact_key) == F.col("_dim_key")) & (F.col(ts_col) >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col(ts_col) < F.col("valid_to"))))
    return fact.join(v, cond, how).drop("_dim_key", "valid_from", "valid_to")


DAY_S = 86400
# Kinds of row in the carry-forward union, in the order in which equal times are taken.
_CARRIED, _VERSION, _FACT = 0, 1, 2
#: groups over which reports that can match no version are spread
_SPREAD = 1024


def join_as_of_carried(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, ts_col: str,
                       columns: Sequence[str], how: str = "inner", slice_s: int = DAY_S) -> DataFrame:
    """The rows of ``join_as_of`` by carrying versions forward instead of joining.

    Versions and reports become one table, and ``last(version)`` over (key, time)
    gives each report the version in force: a report is one row throughout,
    however many versions its key has.  Time is cut into slices of ``slice_s``
    seconds and the window runs per (key, slice), so a key with a third of the
    fact is dealt to as many tasks as it has slices.  What a slice inherits is
    found first, in the same way, from the versions and one row per (key,
    slice) that holds reports, and enters the slice as a row before all others.

    Versions of a key that start together: the last one by the hash of
    ``columns`` holds.  With ``how="left"`` reports without key, time or version
    keep NULLs; ``join_as_of`` remains the choice for a dimension that is
    broadcast, as it moves no report.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    cols = [c for c in columns if c != dim_key]
    sliced = lambda c: F.floor(epoch_seconds(c) / slice_s)
    versions = (dim.filter(F.col(dim_key).isNotNull() & F.col("effective_start_dt").isNotNull())
                .select(F.col(dim_key).alias("_key"), sliced("effective_start_dt").alias("_slice"),
                        F.col("effective_start_dt").alias("_at"), F.lit(_VERSION).alias("_kind"), F.struct(*cols).alias("_version"),
                        F.xxhash64(*cols).alias("_tie")))
    known = F.col(fact_key).isNotNull() & F.col(ts_col).isNotNull()
    # a report that can match nothing goes to one of many groups of its own (negative slices hold no version)
    place = F.when(known, sliced(ts_col)).otherwise(F.lit(-(1 << 40)) + F.pmod(F.xxhash64(*fact.columns), F.lit(_SPREAD)))
    reports = (fact if how == "left" else fact.filter(known)).select(
        "*", F.col(fact_key).alias("_key"), place.alias("_slice"), F.col(ts_col).alias("_at"), F.lit(_FACT).alias("_kind"))

    used = (fact.filter(known).select(F.col(fact_key).alias("_key"), sliced(ts_col).alias("_slice")).distinct()
            .withColumn("_kind", F.lit(_CARRIED)))
    history = Window.partitionBy("_key").orderBy("_slice", "_kind", "_at", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    carried = (versions.unionByName(used, allowMissingColumns=True)
               .withColumn("_version", F.last("_version", ignorenulls=True).over(history))
               .filter((F.col("_kind") == _CARRIED) & F.col("_version").isNotNull())
               .select("_key", "_slice", "_kind", "_version"))
    within = (Window.partitionBy("_key", "_slice").orderBy(F.col("_at").asc_nulls_first(), "_kind", "_tie")
              .rowsBetween(Window.unboundedPreceding, 0))
    held = (reports.unionByName(versions, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
            .withColumn("_version", F.last("_version", ignorenulls=True).over(within))
            .filter(F.col("_kind") == _FACT))
    if how == "inner":
        held = held.filter(F.col("_version").isNotNull())
    return held.select(*[F.col(c) for c in fact.columns], *[F.col("_version")[c].alias(c) for c in cols])
