"""KPIs of any horizon from stored panes: pane, hour and day rows with sums and vehicle sketches.

A report over a year reads a year of reports each time it is asked.  Here each
load reduces its reports to 30-second panes once; hours are rolled up from
panes and days from hours, each level stored in parts.  Sums and counts add up
exactly; distinct vehicles are HLL sketches, which merge.  A load redoes only the
hours that it touches (and their days): panes of those hours are made anew from
the fact, so a late or repeated report never counts twice, and the other rows of
a part (a day of panes, a month of hours, a year of days) are carried over.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.exprs import lit_ntz
from fleetlake.operators import kpi as K
from fleetlake.sinks import TableStore

PANE_S = 30
# Each level: the part that holds its rows, as a prefix of their time.
PART_CHARS = {"panes": len("2024-01-08"), "hours": len("2024-01"), "days": len("2024")}
_HITS = [f"h{i}" for i in range(1, len(K.THRESHOLDS) + 1)]
_SUMS = ["events", "n_spd", "s_spd", "n_dl", "s_dl", *_HITS]


def panes_of(reports: DataFrame, pane_s: int = PANE_S) -> DataFrame:
    """``(at, sums, vehicles)`` per pane of ``reports(tst, vehicle_number, spd, dl)``."""
    hits = [F.count_if(F.abs(F.col("dl")) <= t).alias(h) for t, h in zip(K.THRESHOLDS, _HITS, strict=True)]
    return (reports.groupBy(F.window("tst", f"{pane_s} seconds").start.alias("at"))
            .agg(F.count(F.lit(1)).alias("events"), F.count("spd").alias("n_spd"), F.sum("spd").alias("s_spd"),
                 F.count("dl").alias("n_dl"), F.sum(F.col("dl").cast("double")).alias("s_dl"), *hits,
                 F.hll_sketch_agg("vehicle_number").alias("vehicles")))


def _merge() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in _SUMS], F.hll_union_agg("vehicles").alias("vehicles")]


def rolled(rows: DataFrame, unit: str) -> DataFrame:
    """Rows of a finer level merged per ``unit`` (hour, day)."""
    return rows.groupBy(F.date_trunc(unit, "at").cast("timestamp_ntz").alias("at")).agg(*_merge())


def _hour(column: str = "at") -> Column:
    return F.date_format(column, "yyyy-MM-dd-HH")


def _replace(store: TableStore, name: str, level: str, fresh: DataFrame, units: Sequence[str]) -> list[str]:
    """Put ``fresh``, all rows of the touched ``units`` (hours or days, as text), in place of the stored ones."""
    chars = PART_CHARS[level]
    parts = sorted({u[:chars] for u in units})
    stored = store.read_parts(f"{name}_{level}", parts)
    if stored is not None:
        fresh = fresh.unionByName(stored.filter(~F.substring(_hour(), 1, len(units[0])).isin(list(units))))
    return store.replace_parts(f"{name}_{level}", fresh, F.substring(_hour(), 1, chars), parts)


def _stored(store: TableStore, name: str, level: str, units: Sequence[str]) -> DataFrame:
    own = store.read_parts(f"{name}_{level}", sorted({u[:PART_CHARS[level]] for u in units}))
    return own.filter(F.substring(_hour(), 1, len(units[0])).isin(list(units)))


def refresh(store: TableStore, name: str, fact: DataFrame, load: DataFrame | None = None) -> list[str]:
    """Bring the stored levels up to date with ``load``, rows just added to ``fact`` (all of it if None).

    Returns the hours redone; they and their days are all that the driver sees.
    ``tst`` decides the hour; the fact is read for those hours, its operating
    days pruned to theirs and their neighbours.
    """
    own = (load if load is not None else fact).filter(F.col("tst").isNotNull())
    hours = sorted(r[0] for r in own.select(_hour("tst")).distinct().collect())
    if not hours:
        return []
    days = sorted({h[:10] for h in hours})
    source = own
    if load is not None:
        source = fact.filter(_hour("tst").isin(hours))
        if "oday" in fact.columns:
            near = {str(_dt.date.fromisoformat(d) + _dt.timedelta(days=k)) for d in days for k in (-1, 0, 1)}
            source = source.filter(F.col("oday").isin(sorted(near)))
    _replace(store, name, "panes", panes_of(source), hours)
    _replace(store, name, "hours", rolled(_stored(store, name, "panes", hours), "hour"), hours)
    _replace(store, name, "days", rolled(_stored(store, name, "hours", days), "day"), days)
    return hours


def _kpis(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    merged = rows.groupBy(*keys).agg(*_merge()) if keys else rows.agg(*_merge())
    return merged.select(
        *keys, F.hll_sketch_estimate("vehicles").alias("active_vehicles"), F.try_divide("s_spd", "n_spd").alias("avg_speed"),
        *[F.try_divide(F.col(h), F.col("events")).alias(f"on_time_ratio_{i}") for i, h in enumerate(_HITS, 1)],
        "events", F.try_divide("s_dl", "n_dl").alias("avg_delay_sec"))


def windows(panes: DataFrame, window_s: int = 300, slide_s: int = PANE_S) -> DataFrame:
    """The sliding KPIs of ``kpi.kpi_windows`` from stored panes: each pane goes to the windows that hold it."""
    fanned = K._fan_out(panes.withColumnRenamed("at", "pane"), window_s, slide_s)
    return K._with_end(_kpis(fanned, ["window_start"]), window_s).drop("avg_delay_sec")


def _cuts(start: _dt.datetime, end: _dt.datetime) -> dict[str, list[tuple[_dt.datetime, _dt.datetime]]]:
    """``[start, end)`` in whole days, whole hours at both ends of them, and panes at both ends of these."""
    out: dict[str, list] = {"panes": [], "hours": [], "days": []}

    def cut(level: str, lo: _dt.datetime, hi: _dt.datetime) -> None:
        if lo >= hi:
            return
        if level == "days":
            out["days"].append((lo, hi))
            return
        floor = ((lambda t: t.replace(minute=0, second=0, microsecond=0)) if level == "panes"
                 else (lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0)))
        unit = _dt.timedelta(hours=1) if level == "panes" else _dt.timedelta(days=1)
        a = floor(lo) if floor(lo) == lo else floor(lo) + unit
        b = floor(hi)
        if a >= b:
            out[level].append((lo, hi))
            return
        out[level] += [p for p in ((lo, a), (b, hi)) if p[0] < p[1]]
        cut("hours" if level == "panes" else "days", a, b)

    cut("panes", start, end)
    return out


def _parts_between(level: str, names: Sequence[str], lo: _dt.datetime, hi: _dt.datetime) -> list[str]:
    first, last = (t.isoformat()[:PART_CHARS[level]] for t in (lo, hi - _dt.timedelta(microseconds=1)))
    return [n for n in names if first <= n <= last]


def horizon(store: TableStore, name: str, start: str, end: str) -> DataFrame:
    """KPIs of ``[start, end)`` as one row, both at pane edges: whole days come from day rows, the rest of
    whole hours from hour rows, and only the two ends from panes."""
    lo, hi = _dt.datetime.fromisoformat(start), _dt.datetime.fromisoformat(end)
    if any((t - _dt.datetime(1970, 1, 1)) % _dt.timedelta(seconds=PANE_S) for t in (lo, hi)):
        raise ValueError(f"{start} and {end} must be multiples of {PANE_S} s")
    rows = store.read_parts(f"{name}_panes", ())
    if rows is None:
        raise ValueError(f"no panes are stored as {name}")
    for level, spans in _cuts(lo, hi).items():
        names = sorted(store.parts(f"{name}_{level}")) if spans else []
        for a, b in spans:
            own = store.read_parts(f"{name}_{level}", _parts_between(level, names, a, b))
            if own is not None:
                rows = rows.unionByName(own.filter((F.col("at") >= lit_ntz(a)) & (F.col("at") < lit_ntz(b))))
    return _kpis(rows, [])


def peak_hours(store: TableStore, name: str) -> DataFrame:
    """A18 from the stored hours: load and delay by hour of day over the whole history."""
    hours = store.read_parts(f"{name}_hours").withColumn("hour_of_day", F.hour("at"))
    return (_kpis(hours, ["hour_of_day"])
            .select("hour_of_day", "events", F.col("active_vehicles").alias("vehicles"), "avg_delay_sec").orderBy("hour_of_day"))
