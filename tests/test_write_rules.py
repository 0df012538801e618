"""Rules judged inside the write, adaptive cells, tumbling windows, compacted landing days: against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import analytics as A
from fleetlake.operators import dq
from fleetlake.operators import kpi as K
from fleetlake.plans import queries as Q
from fleetlake.sinks import TableStore
from fleetlake.streaming.landing import append_batch, compact_days, read_landed

SF = "/root/testdata/sf0.001"


def test_the_write_counts_what_the_report_counts(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "", None, f"k{i}"]), rng.choice([0, 1, 5, None]), rng.choice([1.5, None]), rng.choice([0, 1])) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, code int, lat double, active_flg int").repartition(4)
    rules = [dq.not_empty(), dq.no_nulls("id"), dq.no_nulls("lat"), dq.values_in_set("code", [0, 1]), dq.no_duplicates(["id"]),
             dq.active_unique(["id"]), dq.columns_exist(["id", "gone"]), dq.no_nulls("gone")]
    store = TableStore(spark, str(tmp_path))
    key = lambda r: (r["rule"], r["target"])
    got = sorted((r.asDict() for r in dq.write_checked(store, "t", df, rules, "1").collect()), key=key)
    assert got == sorted((r.asDict() for r in dq.dq_report(df, rules, "t").collect()), key=key)
    broken = lambda r: [n for n, bad in (("no_nulls:id", r[0] in (None, "")), ("no_nulls:lat", r[2] is None),
                                         ("values_in_set:code", r[1] == 5)) if bad]
    bad = dq.checked_rows(store, "t", "1", quarantined=True)
    assert sorted(map(repr, ((*r[:4], list(r["violations"])) for r in bad.collect()))) == sorted(repr((*r, broken(r))) for r in rows if broken(r))
    good = dq.checked_rows(store, "t", "1")
    n_good = sum(not broken(r) for r in rows)
    assert good.columns == df.columns and good.count() == n_good
    # the same load again replaces itself; an empty one is reported
    dq.write_checked(store, "t", df, rules, "1")
    assert dq.checked_rows(store, "t", "1").count() == n_good
    none = {key(r): r for r in dq.write_checked(store, "t", df.limit(0), rules, "2").collect()}
    assert not none["not_empty", ""]["passed"] and none["no_duplicates", "id"]["passed"]


def test_the_write_reads_its_input_once(spark, tmp_path):
    store, path = TableStore(spark, str(tmp_path / "s")), str(tmp_path / "in")
    spark.range(1000).withColumn("c", F.col("id") % 7).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(path)
    report = dq.write_checked(store, "t", df.mapInArrow(counted, df.schema), [dq.no_nulls("c"), dq.values_in_set("c", [1, 2, 3])], "1")
    assert report.filter("rule = 'values_in_set'").first()["violations"] == sum(i % 7 not in (1, 2, 3) for i in range(1000))
    assert seen.value == 1000


@pytest.mark.parametrize("split_over,levels", [(1, 16), (10, 16), (25, 5), (10_000, 16), (0, 0)])
def test_cells_equal_a_quadtree(spark, split_over, levels):
    rng = random.Random(split_over)
    at = [(60 + rng.gauss(0, 0.02), 24 + rng.gauss(0, 0.02)) for _ in range(300)]
    at += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(100)] + [(60.17, 24.94)] * 60 + [(90.0, 180.0), (-90.0, -180.0)]

    def split(points, level, lat, lon):
        if not points:
            return []
        if len(points) <= split_over or level == levels:
            return [(level, lat, lon, len(points))]
        h, w = 180 / 2 ** (level + 1), 360 / 2 ** (level + 1)
        out = []
        for i in (0, 1):
            for j in (0, 1):
                own = [p for p in points if min(int((p[0] - lat) // h), 1) == i and min(int((p[1] - lon) // w), 1) == j]
                out += split(own, level + 1, lat + i * h, lon + j * w)
        return out

    df = spark.createDataFrame([*at, (None, 1.0), (1.0, None)], "lat double, long double")
    got = sorted(map(tuple, A.adaptive_hot_spots(df, split_over, levels).collect()))
    assert got == sorted(split(at, 0, -90.0, -180.0)) and sum(r[3] for r in got) == len(at)
    assert sum(4.0 ** -r[0] for r in got) <= 1 + 1e-9   # cells do not overlap
    assert all(math.isfinite(r[1]) for r in got)


def test_tumbling_windows_hold_each_report_once(spark):
    f = K.kpi_input(Q.fact(spark, SF))
    for method in ("panes", "window"):
        w = K.kpi_windows(f, slide_s=None, method=method)
        assert w.agg(F.sum("events")).first()[0] == f.count()
        assert w.filter("unix_seconds(cast(window_start as timestamp)) % 300 <> 0").isEmpty()
    assert K.route_delay_windows(f, slide_s=None).agg(F.sum("events_cnt")).first()[0] == f.count()


def test_compacted_days_are_read_once(spark, tmp_path):
    store, b = TableStore(spark, str(tmp_path)), Q.bronze(spark, SF)
    raw = store.path("raw")
    for i in range(4):
        append_batch(b.filter(F.col("partition") % 4 == i), i, raw)
    want = sorted(map(tuple, b.select("partition", "offset", "insert_time").collect()))
    rows = lambda: sorted(map(tuple, read_landed(store, "days", raw).select("partition", "offset", "insert_time").collect()))
    assert rows() == want
    days = compact_days(store, "days", raw, "2024-01-10")
    assert days and max(days) == "2024-01-09" and compact_days(store, "days", raw, "2024-01-10") == []
    assert rows() == want
    more = compact_days(store, "days", raw, "2024-01-12")
    assert more == ["2024-01-10", "2024-01-11"] and rows() == want
    day = read_landed(store, "days", raw).filter(F.col("landed") == dt.date(2024, 1, 9))
    assert day.count() == b.filter(F.col("insert_time").cast("date") == dt.date(2024, 1, 9)).count()
