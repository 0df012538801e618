"""Gauge series as a table, and the dashboard's queries over it.

Long format ``(metric, type, route_id, ts, value)``: the five unlabelled KPI
gauges plus the labelled route-extreme gauge.  Each PromQL expression of the
dashboard becomes a DataFrame query over that table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.exprs import epoch_seconds, lit_ntz

# Gauge names and the KPI column behind each.
GAUGES = {
    "total_active_vehicles": "active_vehicles",
    "avg_speed_all": "avg_speed",
    "pct_routes_on_time_1": "on_time_ratio_1",
    "pct_routes_on_time_2": "on_time_ratio_2",
    "pct_routes_on_time_3": "on_time_ratio_3",
}
EXTREME_GAUGE = "route_delay_extreme_seconds"
SERIES = ["metric", "type", "route_id"]


def metrics_to_long(kpis: DataFrame, extremes: DataFrame | None = None) -> DataFrame:
    """KPI rows unpivoted to gauge samples at ``window_end`` (+ labelled extremes)."""
    wide = kpis.select(F.col("window_end").alias("ts"), *[F.col(c).cast("double").alias(g) for g, c in GAUGES.items()])
    long = (wide.unpivot("ts", list(GAUGES), "metric", "value")
            .select("metric", F.lit(None).cast("string").alias("type"),
                    F.lit(None).cast("string").alias("route_id"), "ts", "value"))
    return long if extremes is None else long.unionByName(extremes_to_long(extremes))


def extremes_to_long(extremes: DataFrame) -> DataFrame:
    """Route extremes as samples of the labelled gauge."""
    return extremes.select(F.lit(EXTREME_GAUGE).alias("metric"), "type", "route_id", F.col("window_end").alias("ts"),
                           F.col("avg_delay_sec").cast("double").alias("value"))


def _series(metrics: DataFrame, name: str | None, labels: dict[str, str] | None = None,
            at: str | _dt.datetime | None = None) -> DataFrame:
    """Samples of a gauge whose labels have the given values, up to ``at``."""
    m = metrics if name is None else metrics.filter(F.col("metric") == name)
    for label, value in (labels or {}).items():
        m = m.filter(F.col(label) == value)
    return m if at is None else m.filter(F.col("ts") <= lit_ntz(at))


def _last(m: DataFrame) -> DataFrame:
    return m.groupBy(*SERIES).agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))


def metric_latest(metrics: DataFrame, name: str | None = None, at: str | _dt.datetime | None = None,
                  labels: dict[str, str] | None = None) -> DataFrame:
    """Current value of each series: its newest sample at or before ``at`` (G1)."""
    return _last(_series(metrics, name, labels, at))


def metric_last_over(metrics: DataFrame, name: str, lookback_s: int, at: str | _dt.datetime | None = None,
                     scale: float = 1.0, labels: dict[str, str] | None = None) -> DataFrame:
    """``last_over_time(name{labels}[lookback]) / scale`` evaluated at ``at``.

    ``at=None`` evaluates at the gauge's newest sample ("now" on a live
    dashboard), found by a scalar subquery over the metrics table.
    """
    m = _series(metrics, name, labels, at)
    now = lit_ntz(at) if at is not None else _series(metrics, name).select(F.max("ts")).scalar()
    return (_last(m.filter(F.col("ts") > F.timestamp_add("SECOND", F.lit(-lookback_s), now)))
            .select(*SERIES, "ts", (F.col("value") / scale).alias("value")))


def metric_topk(metrics: DataFrame, name: str, k: int = 1, ascending: bool = False, labels: dict[str, str] | None = None,
                scale: float = 1.0) -> DataFrame:
    """``topk``/``bottomk`` at every sample time (G3); ties go to the smaller labels."""
    order = F.col("value").asc() if ascending else F.col("value").desc()
    w = Window.partitionBy("ts").orderBy(order, "type", "route_id")
    return (_series(metrics, name, labels).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
            .select(*SERIES, "ts", (F.col("value") / scale).alias("value")))


def metric_topk_over(metrics: DataFrame, name: str, k: int, lookback_s: int, at: str | _dt.datetime | None = None,
                     ascending: bool = False, labels: dict[str, str] | None = None, scale: float = 1.0) -> DataFrame:
    """``topk(k, last_over_time(name{labels}[lookback])) / scale`` at ``at``, or ``bottomk``."""
    order = F.col("value").asc() if ascending else F.col("value").desc()
    return metric_last_over(metrics, name, lookback_s, at, scale, labels).orderBy(order, "type", "route_id").limit(k)


def metric_range(metrics: DataFrame, name: str, start: str | _dt.datetime, end: str | _dt.datetime) -> DataFrame:
    """Samples of one gauge over ``[start, end]``, in time order."""
    return (metrics.filter((F.col("metric") == name) & (F.col("ts") >= lit_ntz(start)) & (F.col("ts") <= lit_ntz(end)))
            .orderBy("ts", "type", "route_id"))


DAY_S = 86400


def _floor_div(a, b: int):
    """``floor(a / b)`` of whole numbers, also below zero."""
    return F.expr(f"({a} - pmod({a}, {b}L)) div {b}L")


def metric_range_steps(metrics: DataFrame, name: str, start: str | _dt.datetime, end: str | _dt.datetime, step_s: int,
                       lookback_s: int = 300, scale: float = 1.0, labels: dict[str, str] | None = None,
                       slice_s: int = DAY_S) -> DataFrame:
    """A range query: ``last_over_time(name{labels}[lookback]) / scale`` at ``start``, ``start + step`` ... ``end``.

    A sample holds from its time until the next one of its series, for
    ``lookback`` at most (then the series is stale and has no value); the steps
    inside that interval are counted out from its ends.  So each sample is read
    once and yields the steps it answers: no join with the steps, and a
    lookback of many steps multiplies nothing.  The next sample is looked up
    within time slices of at least the lookback, each ended by a copy of the
    next slice's first sample time, so a series of any length is dealt to many
    tasks.  Samples of a series at one time: the greatest value counts.
    """
    m = _series(metrics, name, labels, end).filter(F.col("ts") > F.timestamp_add("SECOND", F.lit(-lookback_s), lit_ntz(start)))
    width = max(slice_s, lookback_s)
    m = m.select(*SERIES, "ts", "value", F.floor(epoch_seconds("ts") / width).alias("slice"), F.lit(False).alias("mark"))
    marks = m.groupBy(*SERIES, "slice").agg(F.min("ts").alias("ts")).select(
        *SERIES, "ts", F.lit(None).cast("double").alias("value"), (F.col("slice") - 1).alias("slice"), F.lit(True).alias("mark"))
    following = Window.partitionBy(*SERIES, "slice").orderBy("ts", "value", "mark")
    stale = F.timestamp_add("SECOND", F.lit(lookback_s), F.col("ts"))
    held = (m.unionByName(marks).withColumn("until", F.least(stale, F.coalesce(F.lead("ts").over(following), stale)))
            .filter(~F.col("mark")))
    since = lambda c: F.timestamp_diff("MICROSECOND", lit_ntz(start), c)
    step = step_s * 1_000_000
    # first step at or after the sample, and the last one before the end of its interval and of the range
    counted = (held.withColumns({"a": since(F.col("ts")), "b": since(F.col("until"))})
               .withColumns({"lo": F.greatest(F.lit(0).cast("long"), -_floor_div("(-a)", step)),
                             "hi": F.least(_floor_div("(b - 1)", step), F.floor(since(lit_ntz(end)) / step))}))
    return (counted.filter(F.col("lo") <= F.col("hi")).withColumn("k", F.explode(F.sequence("lo", "hi")))
            .select(*SERIES, F.timestamp_add("MICROSECOND", F.col("k") * step, lit_ntz(start)).alias("ts"),
                    (F.col("value") / scale).alias("value")))


def topk_steps(steps: DataFrame, k: int = 1, ascending: bool = False) -> DataFrame:
    """``topk``/``bottomk`` at every step of a range query; ties go to the smaller labels."""
    order = F.col("value").asc() if ascending else F.col("value").desc()
    w = Window.partitionBy("ts").orderBy(order, "type", "route_id")
    return steps.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")
