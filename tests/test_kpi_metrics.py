"""KPI windows: pane pre-aggregation equals Spark's sliding window; gauges and extremes."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetlake.operators import kpi as K
from fleetlake.operators import metrics as M

T = dt.datetime


def _positions(spark):
    rows = []
    for i in range(400):
        rows.append((T(2024, 1, 1, 8, 0) + dt.timedelta(seconds=7 * i), f"V{i % 9}", f"R{i % 4}", (i % 17) / 8, (i * 37) % 500 - 250))
    return spark.createDataFrame(rows, "tst timestamp_ntz, vehicle_number string, route_id string, spd double, dl int")


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_panes_equal_sliding_window(spark):
    df = _positions(spark)
    assert _rows(K.kpi_windows(df)) == _rows(K.kpi_windows(df, method="window"))
    assert _rows(K.route_delay_windows(df)) == _rows(K.route_delay_windows(df, method="window"))


def test_distinct_vehicles_without_a_row_per_window_and_vehicle(spark):
    """Gaps of every length, panes at both sides of midnight, repeated reports, unnamed vehicles and reports without time."""
    rng, rows = random.Random(4), []
    for v in ("a", "b", "c", None):
        t = T(2024, 1, 1, 22, 0)
        while t < T(2024, 1, 3, 1, 0):
            t += dt.timedelta(seconds=rng.choice([1, 15, 60, 250, 299, 300, 301, 4000]))
            rows += [(t, v, "R", rng.randrange(80) / 8, rng.randrange(-300, 300))] * rng.choice([1, 1, 2])
    rows += [(T(2024, 1, 1, 23, 59, 59), "d", "R", 1.0, 5), (T(2024, 1, 2), "d", "R", 2.0, 5), (None, "e", "R", 1.0, 0)]
    df = spark.createDataFrame(rows, "tst timestamp_ntz, vehicle_number string, route_id string, spd double, dl int").repartition(3)
    for slide in (30, 100, None):
        got = K.kpi_windows(df, slide_s=slide)
        assert _rows(got) == _rows(K.kpi_windows(df, slide_s=slide, method="window"))
    lines = K.kpi_windows(df)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = [line for line in lines if "Aggregate [window_start" in line]
    assert grouped and not any("_veh#" in line.split("]")[0] for line in grouped)


def test_approx_distinct_close_to_exact(spark):
    df = _positions(spark)
    ex = {r["window_start"]: r["active_vehicles"] for r in K.kpi_windows(df).collect()}
    ap = {r["window_start"]: r["active_vehicles"] for r in K.kpi_windows(df, approx=True).collect()}
    assert ex.keys() == ap.keys()
    assert all(abs(ap[k] - ex[k]) <= max(1, 0.05 * ex[k]) for k in ex)


def test_latest_window_and_extremes(spark):
    rw = spark.createDataFrame(
        [(T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "A", 10.0, 5), (T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "B", -3.0, 9),
         (T(2024, 1, 1, 0, 1), T(2024, 1, 1, 0, 6), "A", 4.0, 5), (T(2024, 1, 1, 0, 1), T(2024, 1, 1, 0, 6), "C", 4.0, 6),
         (T(2024, 1, 1, 0, 1), T(2024, 1, 1, 0, 6), "D", 99.0, 1)],
        "window_start timestamp_ntz, window_end timestamp_ntz, route_id string, avg_delay_sec double, events_cnt long")
    got = {r["type"]: (r["route_id"], r["avg_delay_sec"]) for r in K.route_extremes(rw, min_events=5).collect()}
    assert got == {"worst": ("A", 4.0), "best": ("A", 4.0)}     # D has too few events; tie -> smaller id
    allw = K.route_extremes(rw, min_events=5, latest_only=False).count()
    assert allw == 4
    assert K.latest_window(rw).count() == 3


def test_metric_queries(spark):
    kpis = K.kpi_windows(_positions(spark))
    long = M.metrics_to_long(kpis).cache()
    n = kpis.count()
    assert long.count() == 5 * n
    latest = {r["metric"]: r["ts"] for r in M.metric_latest(long).collect()}
    assert len(latest) == 5 and len(set(latest.values())) == 1
    rng = M.metric_range(long, "avg_speed_all", "2024-01-01 08:10:00", "2024-01-01 08:20:00")
    assert rng.count() == 21
    at = "2024-01-01 08:20:00"
    lo = M.metric_last_over(long, "avg_speed_all", 120, at, scale=2.0).first()
    ref = long.filter((F.col("metric") == "avg_speed_all") & (F.col("ts") == T(2024, 1, 1, 8, 20))).first()
    assert lo["value"] == ref["value"] / 2.0
    top = M.metric_topk(long.filter(F.col("metric") == "avg_speed_all"), "avg_speed_all", k=1)
    assert top.count() == n


def test_hot_route_gives_the_same_windows(spark):
    # one route carries a third of all reports; both window forms agree and the plan stays partial+final
    rows = []
    for i in range(600):
        route = "HOT" if i % 3 == 0 else f"R{i % 7}"
        rows.append((T(2024, 1, 1, 8, 0) + dt.timedelta(seconds=3 * i), f"V{i % 11}", route, (i % 9) / 8, (i * 13) % 400 - 200))
    df = spark.createDataFrame(rows, "tst timestamp_ntz, vehicle_number string, route_id string, spd double, dl int")
    panes = K.route_delay_windows(df)
    assert _rows(panes) == _rows(K.route_delay_windows(df, method="window"))
    plan = panes._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_extremes_name_no_older_window(spark):
    rw = spark.createDataFrame(
        [(T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "A", 10.0, 9), (T(2024, 1, 1, 0, 1), T(2024, 1, 1, 0, 6), "B", 4.0, 4)],
        "window_start timestamp_ntz, window_end timestamp_ntz, route_id string, avg_delay_sec double, events_cnt long")
    assert K.route_extremes(rw, min_events=5).count() == 0
    assert K.route_extremes(rw, min_events=4).count() == 2


def test_newest_window_needs_only_the_newest_reports(spark):
    df = _positions(spark)
    assert _rows(K.latest_window(K.kpi_windows(K.newest(df)))) == _rows(K.latest_window(K.kpi_windows(df)))
    assert K.newest(df).count() < 10


def test_gauge_queries_with_labels(spark):
    rows = [("g", "worst", "A", T(2024, 1, 1, 0, 1), 60.0), ("g", "worst", "A", T(2024, 1, 1, 0, 2), 120.0),
            ("g", "worst", "B", T(2024, 1, 1, 0, 2), 180.0), ("g", "best", "C", T(2024, 1, 1, 0, 2), -60.0),
            ("g", "worst", "D", T(2024, 1, 1, 0, 0), 900.0)]
    m = spark.createDataFrame(rows, "metric string, type string, route_id string, ts timestamp_ntz, value double")
    one = lambda df: [(r["route_id"], r["value"]) for r in df.collect()]
    assert one(M.metric_topk_over(m, "g", 1, 90, labels={"type": "worst"}, scale=60.0)) == [("B", 3.0)]
    assert one(M.metric_topk_over(m, "g", 1, 90, ascending=True, labels={"type": "worst"}, scale=60.0)) == [("A", 2.0)]
    assert one(M.metric_topk_over(m, "g", 1, 90, "2024-01-01 00:01:00", labels={"type": "worst"})) == [("D", 900.0)]
    assert sorted(one(M.metric_last_over(m, "g", 90, labels={"type": "best"}))) == [("C", -60.0)]
    assert one(M.metric_latest(m, "g", labels={"type": "best"})) == [("C", -60.0)]


def test_batch_width_follows_the_input(spark, tmp_path):
    from fleetlake.session import size_batch
    spark.range(100000).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        small = size_batch(spark, str(tmp_path / "t"))
        assert small == 2 * spark.sparkContext.defaultParallelism
        wide = size_batch(spark, str(tmp_path / "t"), target_bytes=1000)
        assert wide > 100 and spark.conf.get("spark.sql.shuffle.partitions") == str(wide)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
