"""Sliding-window KPIs (A1-A5, T2, T3, X2 batch form).

The same definitions serve batch and streaming:

* ``method="panes"`` (batch default): aggregate once per ``slide`` pane
  (and per vehicle / route), then fan each pane out to the
  ``window/slide`` windows that contain it and merge.  Partial sums and
  counts are exact; the fan-out multiplies the already reduced pane rows,
  not the raw events.  Distinct vehicles are exact (of a vehicle's panes each
  counts it in the windows that hold no earlier one, so vehicles are summed up
  per pane before the fan-out), or approximate with mergeable HLL sketches.
* ``method="window"``: Spark's ``window(ts, window, slide)`` (Expand of every
  row); the only form Structured Streaming accepts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.exprs import epoch_seconds
from fleetlake.operators.silver import filter_delay_outliers

THRESHOLDS = (60, 120, 180)
DAY_S = 86400


def kpi_input(df: DataFrame, max_abs: int = 1800) -> DataFrame:
    """Reports with a usable delay (the reference drops |delay| > 30 min before the KPIs)."""
    return filter_delay_outliers(df, "dl", max_abs).select("tst", "vehicle_number", "route_id", "spd", "dl")


def _panes(df: DataFrame, ts: str, slide_s: int) -> Column:
    return F.window(F.col(ts), f"{slide_s} seconds").start


def _n_panes(window_s: int, slide_s: int) -> int:
    if window_s % slide_s:
        raise ValueError("panes need window a multiple of slide; use method='window'")
    return window_s // slide_s


def _fan_out(panes: DataFrame, window_s: int, slide_s: int) -> DataFrame:
    """Each pane row -> one row per window containing it (``window_start``), the ``_k``-th before the pane's own."""
    n = _n_panes(window_s, slide_s)
    return (panes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .withColumn("window_start", F.timestamp_add("SECOND", -F.col("_k") * slide_s, F.col("pane")))
            .drop("pane"))


def _with_reach(pv: DataFrame, window_s: int, slide_s: int) -> DataFrame:
    """``(pane, _veh)`` rows and ``_reach``: how many of the windows that hold the pane hold no earlier pane of the
    vehicle (those that start last).

    The windows of a vehicle are so counted once each without a row per window
    and vehicle.  The pane before is looked up within time slices of a day (of
    a window, if longer), each begun by copies of the panes before it that share
    a window with it, so a vehicle's history of any length is dealt to many tasks.
    """
    n = _n_panes(window_s, slide_s)
    if n == 1:
        return pv.withColumn("_reach", F.lit(1).cast("long"))
    per = max(n, DAY_S // slide_s)
    at = F.col("_at")
    own = F.floor(at / per)
    earlier = at - F.lag("_at").over(Window.partitionBy("_veh", "_slice").orderBy("_at"))
    return (pv.withColumn("_at", F.floor(epoch_seconds("pane") / slide_s))
            .withColumn("_slice", F.explode(F.when((own + 1) * per - at < n, F.array(own, own + 1)).otherwise(F.array(own))))
            .withColumn("_reach", F.least(F.lit(n).cast("long"), F.coalesce(earlier, F.lit(n).cast("long"))))
            .filter(F.col("_slice") == own).drop("_at", "_slice"))


def _with_end(df: DataFrame, window_s: int) -> DataFrame:
    return df.withColumn("window_end", F.timestamp_add("SECOND", F.lit(window_s), F.col("window_start")))


def _ratios(hits: Sequence[str], n: str) -> list[Column]:
    return [F.try_divide(F.col(h), F.col(n)).alias(f"on_time_ratio_{i}") for i, h in enumerate(hits, 1)]


def kpi_windows(df: DataFrame, *, ts: str = "tst", vehicle: str = "vehicle_number", speed: str = "spd",
                delay: str = "dl", window_s: int = 300, slide_s: int | None = 30,
                thresholds: Sequence[int] = THRESHOLDS, approx: bool = False,
                method: str = "panes") -> DataFrame:
    """Per window: active vehicles, mean speed (m/s and km/h), on-time ratios, event count.  ``slide_s=None``:
    tumbling windows."""
    slide_s = slide_s or window_s
    hit_cols = [F.when(F.abs(F.col(delay)) <= t, 1).otherwise(0) for t in thresholds]
    hits = [f"h{i}" for i in range(1, len(thresholds) + 1)]
    if method == "window":
        w = F.window(F.col(ts), f"{window_s} seconds", f"{slide_s} seconds")
        distinct = F.approx_count_distinct(vehicle) if approx else F.count_distinct(vehicle)
        out = (df.groupBy(w.alias("w"))
               .agg(distinct.alias("active_vehicles"), F.avg(speed).alias("avg_speed"),
                    *[F.avg(h).alias(f"on_time_ratio_{i}") for i, h in enumerate(hit_cols, 1)],
                    F.count(F.lit(1)).alias("events"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "active_vehicles", "avg_speed", *[f"on_time_ratio_{i}" for i in range(1, len(hits) + 1)],
                       "events"))
        return out.withColumn("avg_speed_kmh", F.col("avg_speed") * 3.6)
    sums = [F.sum(F.col(speed)).alias("s_spd"), F.count(F.col(speed)).alias("n_spd"),
            F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(n) for h, n in zip(hit_cols, hits)]]
    merge = [F.sum("s_spd").alias("s_spd"), F.sum("n_spd").alias("n_spd"), F.sum("n").alias("n"),
             *[F.sum(h).alias(h) for h in hits]]
    if approx:
        panes = df.groupBy(_panes(df, ts, slide_s).alias("pane")).agg(F.hll_sketch_agg(vehicle).alias("sk"), *sums)
        win = (_fan_out(panes, window_s, slide_s).groupBy("window_start")
               .agg(F.hll_sketch_estimate(F.hll_union_agg("sk")).alias("active_vehicles"), *merge))
    else:
        # (pane, vehicle) first: a vehicle reporting every second is one row per pane; then, whatever the number
        # of vehicles, at most one row per pane and reach
        pv = df.groupBy(_panes(df, ts, slide_s).alias("pane"), F.col(vehicle).alias("_veh")).agg(*sums)
        panes = _with_reach(pv, window_s, slide_s).groupBy("pane", "_reach").agg(F.count("_veh").alias("_vehicles"), *merge)
        first = F.when(F.col("_k") < F.col("_reach"), F.col("_vehicles")).otherwise(0)
        win = _fan_out(panes, window_s, slide_s).groupBy("window_start").agg(F.sum(first).alias("active_vehicles"), *merge)
    return (_with_end(win, window_s)
            .select("window_start", "window_end", "active_vehicles",
                    F.try_divide(F.col("s_spd"), F.col("n_spd")).alias("avg_speed"),
                    *_ratios(hits, "n"), F.col("n").alias("events"))
            .withColumn("avg_speed_kmh", F.col("avg_speed") * 3.6))


def route_delay_windows(df: DataFrame, *, ts: str = "tst", route: str = "route_id", delay: str = "dl",
                        window_s: int = 300, slide_s: int | None = 30, method: str = "panes") -> DataFrame:
    """Per window and route: mean delay (s) and report count (A4).  ``slide_s=None``: tumbling windows."""
    slide_s = slide_s or window_s
    if method == "window":
        w = F.window(F.col(ts), f"{window_s} seconds", f"{slide_s} seconds")
        return (df.groupBy(w.alias("w"), F.col(route).alias("route_id"))
                .agg(F.avg(F.col(delay).cast("double")).alias("avg_delay_sec"), F.count(F.lit(1)).alias("events_cnt"))
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "route_id", "avg_delay_sec", "events_cnt"))
    panes = (df.groupBy(_panes(df, ts, slide_s).alias("pane"), F.col(route).alias("route_id"))
             .agg(F.sum(F.col(delay).cast("double")).alias("s"), F.count(F.col(delay)).alias("nd"),
                  F.count(F.lit(1)).alias("n")))
    win = (_fan_out(panes, window_s, slide_s).groupBy("window_start", "route_id")
           .agg(F.sum("s").alias("s"), F.sum("nd").alias("nd"), F.sum("n").alias("n")))
    return (_with_end(win, window_s)
            .select("window_start", "window_end", "route_id",
                    F.try_divide(F.col("s"), F.col("nd")).alias("avg_delay_sec"), F.col("n").alias("events_cnt")))


def latest_window(windows: DataFrame, end_col: str = "window_end") -> DataFrame:
    """Rows of the newest window.

    The global max is a one-row aggregate joined back on equality, so nothing
    is collected to the driver; the one-row side is a broadcast of proven size.
    """
    m = windows.agg(F.max(end_col).alias("_latest"))
    return windows.join(F.broadcast(m), F.col(end_col) == F.col("_latest"), "left_semi")


def newest(df: DataFrame, ts: str = "tst", slide_s: int = 30) -> DataFrame:
    """The reports of the last ``slide_s`` seconds: all that the newest window can hold.

    The newest time is a scalar subquery, so ``latest_window`` over the windows
    of this is the newest window of the whole history without its cost.
    """
    last = df.select(F.timestamp_add("SECOND", F.lit(-slide_s), F.max(ts))).scalar()
    return df.filter(F.col(ts) > last)


def route_extremes(route_windows: DataFrame, min_events: int = 5, latest_only: bool = True) -> DataFrame:
    """Worst (highest mean delay) and best route per window among routes with ``min_events`` reports.

    ``latest_only`` takes the newest window first and then the routes with
    enough reports, so it says nothing rather than name an older window.  One
    pass ranks both ways; ties go to the smaller ``route_id``.  The window
    partition holds one row per route of one window, never raw events.
    """
    rw = latest_window(route_windows) if latest_only else route_windows
    rw = rw.filter(F.col("events_cnt") >= min_events)
    by = Window.partitionBy("window_start")
    ranked = (rw.withColumn("_worst", F.row_number().over(by.orderBy(F.col("avg_delay_sec").desc(), "route_id")))
              .withColumn("_best", F.row_number().over(by.orderBy(F.col("avg_delay_sec").asc(), "route_id"))))
    picked = ranked.filter((F.col("_worst") == 1) | (F.col("_best") == 1))
    return picked.select(
        "window_start", "window_end",
        F.explode(F.array_compact(F.array(
            F.when(F.col("_worst") == 1, F.struct(F.lit("worst").alias("type"), F.coalesce("route_id", F.lit("unknown")).alias("route_id"), "avg_delay_sec")),
            F.when(F.col("_best") == 1, F.struct(F.lit("best").alias("type"), F.coalesce("route_id", F.lit("unknown")).alias("route_id"), "avg_delay_sec")),
        ))).alias("x")).select("window_start", "window_end", "x.*")
