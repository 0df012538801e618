"""Silver-layer operators: dedupe, typing, filters, audit columns."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.exprs import blank_to_null, lit_ntz, parse_utc_ts, safe_cast


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the greatest ``(order..., tiebreak...)``.

    Only the columns a later step uses are shuffled, and a limit of one row per
    key runs before the shuffle as well (``WindowGroupLimit``), so a message
    re-sent a million times leaves a task once.  NULL order values rank lowest.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *tiebreak]])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def type_events(flat: DataFrame, now: str | _dt.datetime) -> DataFrame:
    """Cast the parsed feed: ``tst`` -> UTC ntz, ``oday`` -> date; add ``update_time``.

    ``insert_time`` keeps the landing time (the incremental watermark), and
    malformed values become NULL instead of failing the batch.
    """
    return (flat.withColumn("tst", parse_utc_ts("tst"))
            .withColumn("oday", safe_cast("oday", "date"))
            .withColumn("update_time", lit_ntz(now)))


def reject_reason() -> Column:
    """Why a typed report can't be keyed; NULL for one that can."""
    return (F.when(blank_to_null("vehicle_number").isNull(), "no_vehicle")
            .when(F.col("tst").isNull(), "no_tst"))


def dedupe_events(typed: DataFrame) -> DataFrame:
    """Reports with a key, one per (vehicle_number, tst): later landing wins, offset breaks ties."""
    return dedupe_latest(typed.filter(reject_reason().isNull()), ["vehicle_number", "tst"], ["insert_time"],
                         ["kafka_partition", "kafka_offset"])


def silver_events(flat: DataFrame, now: str | _dt.datetime) -> DataFrame:
    """Type, then dedupe on the typed key; reports without vehicle or time are ``silver_rejects``."""
    return dedupe_events(type_events(flat, now))


def silver_rejects(flat: DataFrame, now: str | _dt.datetime) -> DataFrame:
    """The reports that ``silver_events`` leaves out, with the reason."""
    return type_events(flat, now).withColumn("reject_reason", reject_reason()).filter(F.col("reject_reason").isNotNull())


def filter_delay_outliers(df: DataFrame, col: str = "dl", max_abs: int = 1800) -> DataFrame:
    """Keep rows whose delay is present and within ``±max_abs`` seconds."""
    return df.filter(F.col(col).isNotNull() & (F.abs(F.col(col)) <= max_abs))


def with_audit(df: DataFrame, now: str | _dt.datetime) -> DataFrame:
    """Audit columns ``insert_time`` and ``update_time`` with an injected time."""
    t = lit_ntz(now)
    return df.withColumn("insert_time", t).withColumn("update_time", t)


def all_to_string(df: DataFrame) -> DataFrame:
    """Every column cast to string under its own name."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def clean_dim(df: DataFrame, *, drop: Sequence[str] = (), defaults: dict[str, str] | None = None,
              casts: dict[str, str] | None = None) -> DataFrame:
    """Drop, default and safely cast dimension columns."""
    out = df.drop(*drop)
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    for c, t in (casts or {}).items():
        out = out.withColumn(c, safe_cast(c, t))
    return out


# Cleaning rules of the two dimensions.
ROUTES_CLEAN = dict(drop=("route_desc", "route_url"), defaults={"route_short_name": "NA"},
                    casts={"route_type": "int"})
STOPS_CLEAN = dict(drop=("stop_url", "location_type", "_corrupt_record"),
                   defaults={"parent_station": "N/A", "platform_code": "N/A", "vehicle_type": "N/A"},
                   casts={"stop_lat": "double", "stop_lon": "double", "wheelchair_boarding": "int", "radius": "int"})


def stage_dim(landed: DataFrame, key: str, spec: dict) -> DataFrame:
    """Clean the landed rows, then keep the latest landing per business key; of rows landed at the same
    time, the one with the greatest values, column by column, wins."""
    cleaned = clean_dim(landed, **spec)
    return dedupe_latest(cleaned, [key], ["insert_time"], [c for c in cleaned.columns if c not in (key, "insert_time")])


def incremental(df: DataFrame, last: _dt.datetime | None, ts_col: str = "insert_time",
                day_col: str = "landed") -> DataFrame:
    """Rows newer than the last loaded time.

    ``last`` is a scalar fetched by ``joblog.last_loaded_value``; as a literal it
    is pushed into the Parquet scan and skips old row groups.  A table that is
    partitioned by landing day (``day_col``) is listed from that day on only.
    """
    if last is None:
        return df
    t = lit_ntz(last)
    if day_col in df.columns:
        df = df.filter(F.col(day_col) >= t.cast("date"))
    return df.filter(F.col(ts_col) > t)
