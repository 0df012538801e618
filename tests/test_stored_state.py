"""Carried as-of join, step evaluation, tables in parts, bucketed dimension, bitmaps, intervals, zone map, panes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import analytics as A
from fleetlake.operators import bitmaps as B
from fleetlake.operators import coverage as V
from fleetlake.operators import kpi as K
from fleetlake.operators import metrics as M
from fleetlake.operators import panes as N
from fleetlake.operators.gold import join_as_of, join_as_of_carried
from fleetlake.operators.scd2 import ROUTE_ATTRS, scd2_apply, scd2_dimension, scd2_load
from fleetlake.plans import queries as Q
from fleetlake.sinks import TableStore
from fleetlake.sources import replay_index as R
from fleetlake.sources.kafka import replay
from fleetlake.streaming.kpi_stream import publish_latest, read_current

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)
_PIT_FACT = "k string, t timestamp_ntz, n long"
_PIT_DIM = "k string, effective_start_dt timestamp_ntz, v string, w int"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- J5
@pytest.fixture(scope="module")
def point_in_time(spark):
    rng = random.Random(3)
    at = lambda: T0 + dt.timedelta(seconds=rng.randrange(-86400 * 3, 86400 * 20))
    keys = [f"k{i}" for i in range(12)]
    # a third of the reports have one key; versions before, inside, at and after the reports' times
    fact = [("hot" if rng.random() < 0.4 else rng.choice(keys), at(), i) for i in range(1500)]
    dim = [(k, at(), f"{k}-{i}", i) for k in [*keys[:10], "hot", "unused"] for i in range(rng.randrange(1, 40))]
    fact += [(k, t, 5000 + i) for i, (k, t, _, _) in enumerate(dim[:40])]
    fact += [(None, at(), 9001), ("hot", None, 9002), (None, None, 9003)]
    dim += [(None, at(), "no key", 1), ("hot", None, "no time", 1), ("k1", T0 + dt.timedelta(days=2), None, None)]
    return (spark.createDataFrame(fact, _PIT_FACT).repartition(5), spark.createDataFrame(dim, _PIT_DIM).repartition(3), fact, dim)


@pytest.mark.parametrize("slice_s", [3600, 86400, 86400 * 365])
def test_carried_versions_equal_the_brute_force(point_in_time, slice_s):
    fact_df, dim_df, fact, dim = point_in_time
    want = []
    for k, t, n in fact:
        own = [d for d in dim if k is not None and t is not None and d[0] == k and d[1] is not None and d[1] <= t]
        best = max(own, key=lambda d: d[1], default=None)
        want.append((k, t, n, *(best[2:] if best else (None, None)), best is not None))
    left = join_as_of_carried(fact_df, dim_df, "k", "k", "t", ["v", "w"], how="left", slice_s=slice_s)
    assert _rows(left) == sorted((r[:5] for r in want), key=repr)
    inner = join_as_of_carried(fact_df, dim_df, "k", "k", "t", ["k", "v", "w"], slice_s=slice_s)
    assert _rows(inner) == sorted((r[:5] for r in want if r[5]), key=repr)


def test_carried_join_of_empty_sides(spark, point_in_time):
    fact_df, dim_df, fact, _ = point_in_time
    assert join_as_of_carried(fact_df, dim_df.limit(0), "k", "k", "t", ["v"]).isEmpty()
    assert join_as_of_carried(fact_df, dim_df.limit(0), "k", "k", "t", ["v"], how="left").count() == len(fact)
    assert join_as_of_carried(fact_df.limit(0), dim_df, "k", "k", "t", ["v"], how="left").isEmpty()
    with pytest.raises(ValueError, match="outer"):
        join_as_of_carried(fact_df, dim_df, "k", "k", "t", ["v"], how="outer")


def test_carried_join_deals_a_hot_key_out_and_multiplies_nothing(spark, point_in_time):
    fact_df, dim_df, _, _ = point_in_time
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = join_as_of_carried(fact_df, dim_df, "k", "k", "t", ["v"])
        tasks = out.filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 4
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    # the plain form meets every version of the key before its range filter
    assert "Join" in join_as_of(fact_df, dim_df, "k", "k", "t", ["v"])._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- G4
@pytest.mark.parametrize("step,lookback,slice_s", [(30, 120, 3600), (45, 7200, 60), (7, 5, 86400)])
def test_steps_equal_the_brute_force(spark, step, lookback, slice_s):
    rng = random.Random(step)
    rows = []
    for label in ("a", "b", None):
        t = T0 - dt.timedelta(hours=3)
        while t < T0 + dt.timedelta(hours=3):
            t += dt.timedelta(microseconds=rng.choice([250_000, 30_000_000, 400_000_000, 3_000_000_000]) + rng.randrange(2))
            rows.append(("g", "worst", label, t, rng.random()))
    rows += [("g", "best", "a", T0, 1.0), ("other", "worst", "a", T0, 1.0), ("g", "worst", "a", T0 + dt.timedelta(seconds=step * 4), 7.0)]
    df = spark.createDataFrame(rows, "metric string, type string, route_id string, ts timestamp_ntz, value double").repartition(4)
    end = T0 + dt.timedelta(hours=2, seconds=11)
    want, t = [], T0
    while t <= end:
        for label in ("a", "b", None):
            own = [r for r in rows if r[:3] == ("g", "worst", label) and t - dt.timedelta(seconds=lookback) < r[3] <= t]
            if own:
                want.append(("g", "worst", label, t, max(own, key=lambda r: (r[3], r[4]))[4] / 2.0))
        t += dt.timedelta(seconds=step)
    got = M.metric_range_steps(df, "g", str(T0), str(end), step, lookback, 2.0, {"type": "worst"}, slice_s)
    assert _rows(got) == sorted(want, key=repr)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    top = {r["ts"]: r["value"] for r in M.topk_steps(got).collect()}
    assert top == {t: max(w[4] for w in want if w[3] == t) for t in {w[3] for w in want}}


# ---------------------------------------------------------------- parts, J4
def test_parts_are_replaced_alone_and_published_last(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.read_parts("t") is None and store.parts("t") == {}
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "x int, p string")
    assert store.replace_parts("t", df, F.col("p")) == ["a", "b", "none"]
    assert store.replace_parts("t", spark.createDataFrame([(9, "b")], "x int, p string"), F.col("p"), ["b", "c"]) == ["b", "c"]
    assert _rows(store.read_parts("t").select("x")) == [(1,), (2,), (4,), (9,)]
    assert store.parts("t") == {"a": (1, 2), "none": (1, 1), "b": (2, 1), "c": (2, 0)}
    assert store.read_parts("t", ["c", "nothing"]).isEmpty() and _rows(store.read_parts("t", ["a"]).select("x")) == [(1,), (2,)]
    # a load that fails while its files are written is not seen, and the next one stands
    bad = df.withColumn("x", F.raise_error(F.lit("planned")).cast("int"))
    with pytest.raises(Exception, match="planned"):
        store.replace_parts("t", bad, F.col("p"))
    assert store.read_parts("t").count() == 4
    assert store.replace_parts("t", df.limit(0), F.col("p"), ["a"]) == ["a"] and store.read_parts("t").count() == 2


def test_a_load_rewrites_the_buckets_it_changes(spark, tmp_path):
    store, stg1, stg2 = TableStore(spark, str(tmp_path)), Q.routes_staged(spark, SF, 1), Q.routes_staged(spark, SF, 2)
    assert scd2_load(store, "d", stg1, "route_id", ROUTE_ATTRS, Q.LOAD1, buckets=16) == list(range(16))
    scd2_load(store, "d", stg2, "route_id", ROUTE_ATTRS, Q.LOAD2)
    want = scd2_apply(scd2_apply(None, stg1, "route_id", ROUTE_ATTRS, Q.LOAD1), stg2, "route_id", ROUTE_ATTRS, Q.LOAD2)
    assert _rows(scd2_dimension(store, "d").select(want.columns)) == _rows(want)
    assert scd2_load(store, "d", stg2, "route_id", ROUTE_ATTRS, Q.FACT_NOW) == []
    # one changed key, one new key
    before = store.parts("d")
    one = F.col("route_id") == "R7"
    changed = stg2.withColumn("route_type", F.when(one, 99).otherwise(F.col("route_type")))
    touched = scd2_load(store, "d", changed, "route_id", ROUTE_ATTRS, Q.FACT_NOW)
    assert len(touched) == 1
    after = store.parts("d")
    assert [p for p in after if after[p] != before[p]] == [str(touched[0])]
    want = scd2_apply(want, changed, "route_id", ROUTE_ATTRS, Q.FACT_NOW)
    assert _rows(scd2_dimension(store, "d").select(want.columns)) == _rows(want)
    fresh = changed.filter(one).withColumn("route_id", F.lit("R-new"))
    assert len(scd2_load(store, "d", fresh, "route_id", ROUTE_ATTRS, Q.FACT_NOW)) == 1
    assert scd2_dimension(store, "d").filter("route_id = 'R-new' and active_flg = 1").count() == 1
    # comparing reads keys and attributes, not the whole dimension
    scan = _plan(store.read_parts("d").filter("active_flg = 1").select("route_id", *ROUTE_ATTRS))
    assert "insert_dt" not in scan and "PushedFilters: [IsNotNull(active_flg), EqualTo(active_flg,1)]" in scan


# ---------------------------------------------------------------- A7, A12, A13
def test_ids_are_dense_and_stay(spark):
    first = B.dense_ids(spark.createDataFrame([(f"v{i % 300}",) for i in range(900)] + [(None,)], "x string"), "x")
    assert sorted(r["id"] for r in first.collect()) == list(range(1, 301))
    known = spark.createDataFrame(first.collect(), first.schema)
    more = B.dense_ids(spark.createDataFrame([(f"v{i}",) for i in range(250, 340)], "x string"), "x", known)
    assert sorted(r["id"] for r in more.collect()) == list(range(301, 341))
    assert {r["value"] for r in more.collect()} == {f"v{i}" for i in range(300, 340)}


def test_bitmaps_count_beyond_one_bucket_and_after_a_reload(spark, tmp_path):
    rng = random.Random(8)
    rows = [(dt.date(2024, 1, 1 + i % 3), "hot" if i % 3 else f"R{i % 7}", "r", f"v{rng.randrange(50_000)}", rng.choice([None, "s1", "s2"]), "1")
            for i in range(60_000)]
    schema = "oday date, route_id string, route string, vehicle_number string, stop string, direction_id string"
    store, fact = TableStore(spark, str(tmp_path)), spark.createDataFrame(rows, schema)
    B.refresh_bitmaps(store, fact.limit(0).unionByName(fact.filter("oday < '2024-01-03'")), [dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    assert B.refresh_bitmaps(store, fact, [dt.date(2024, 1, 3)]) == ["2024-01-03"]
    B.refresh_bitmaps(store, fact, [dt.date(2024, 1, 2)])   # once more: the same rows
    got = B.distinct_counts(B.day_bitmaps(store), ["route_id"], {"vehicle": "v", "stop": "s", "direction": "d"})
    want = fact.groupBy("route_id").agg(F.count_distinct("vehicle_number").alias("v"), F.count_distinct("stop").alias("s"),
                                        F.count_distinct("direction_id").alias("d"))
    assert _rows(got) == _rows(want)
    assert B.day_bitmaps(store).select("bucket").distinct().count() == 2
    assert _rows(B.route_bus_count(B.day_bitmaps(store))) == _rows(A.route_bus_count(fact))
    day = B.day_bitmaps(store, ["2024-01-02"])
    assert all("part=2024-01-02" in f for f in day.inputFiles()) and "Expand" not in _plan(B.route_stop_coverage(day))


# ---------------------------------------------------------------- W3
def test_intervals_after_any_order_of_loads(spark, tmp_path):
    rng = random.Random(4)
    rows = [(t, p, o) for t in ("a", "b") for p in range(2) for o in range(400) if rng.random() < 0.8]
    rows += rows[:50] + [("a", 7, 5), ("b", 7, None)]
    rng.shuffle(rows)
    store = TableStore(spark, str(tmp_path))
    schema = "topic string, partition int, offset long"
    for lo in range(0, len(rows), 300):
        found = V.audit_load(store, spark.createDataFrame(rows[lo:lo + 300], schema), bucket_size=16)
    whole = spark.createDataFrame(rows, schema).filter("offset is not null")
    assert _rows(found) == _rows(A.offset_gaps(whole)) != []
    # the stored table is as small as its holes
    n = store.read(V.COVERED).count()
    assert n == found.count() + whole.select("topic", "partition").distinct().count()
    again = V.audit_load(store, spark.createDataFrame(rows[:100], schema))
    assert _rows(again) == _rows(found)
    assert V.audit_load(store, spark.createDataFrame([], schema)).count() == found.count()


# ---------------------------------------------------------------- S8
def test_replay_opens_only_files_that_overlap(spark, tmp_path):
    store, b = TableStore(spark, str(tmp_path)), Q.bronze(spark, SF).drop("insert_time")
    raw = store.path("raw")
    b.filter("offset % 2 = 0").repartitionByRange(6, "timestamp").write.parquet(raw)
    assert R.index_landed(store, raw) == 6 and R.index_landed(store, raw) == 0
    b.filter("offset % 2 = 1").repartitionByRange(6, "timestamp").write.mode("append").parquet(raw)
    assert R.index_landed(store, raw) == 6
    assert store.read(R.INDEX).agg(F.sum("records")).first()[0] == b.count()
    got = R.replay_between(store, *Q.REPLAY)
    assert _rows(got.drop("insert_time")) == _rows(replay(spark, raw, *Q.REPLAY).drop("insert_time"))
    assert 0 < len(got.inputFiles()) < 12
    assert R.replay_between(store, "2030-01-01").isEmpty()
    ranges = spark.createDataFrame([("vehicle_positions", 1, 10, 40), ("vehicle_positions", 1, 30, 50), ("other", 1, 0, 99)],
                                   "topic string, partition int, from_offset long, to_offset long")
    want = b.filter("partition = 1 and offset between 10 and 50")
    assert _rows(R.replay_offsets(store, ranges).select("partition", "offset", "key")) == _rows(want.select("partition", "offset", "key"))


# ---------------------------------------------------------------- panes
def test_only_touched_hours_are_redone(spark, tmp_path):
    store, f = TableStore(spark, str(tmp_path)), K.kpi_input(Q.fact(spark, SF)).withColumn("oday", F.col("tst").cast("date"))
    late = (F.col("tst") >= F.lit("2024-01-09 05:00:00").cast("timestamp_ntz")) & (F.col("tst") < F.lit("2024-01-10 20:00:00").cast("timestamp_ntz"))
    assert N.refresh(store, "k", f.filter(late).limit(0)) == []
    N.refresh(store, "k", f.filter(~late))
    hours = N.refresh(store, "k", f, f.filter(late))
    assert hours[0] >= "2024-01-09-05" and hours[-1] <= "2024-01-10-19"
    N.refresh(store, "k", f, f.filter(late))   # the same load again counts nothing twice
    sums = ["events", "n_spd", "s_spd", "n_dl", "s_dl", "h1", "h2", "h3"]
    for level, unit in (("panes", None), ("hours", "hour"), ("days", "day")):
        rows = N.panes_of(f) if unit is None else N.rolled(N.panes_of(f), unit)
        assert _rows(store.read_parts(f"k_{level}").select("at", *sums)) == _rows(rows.select("at", *sums))
    direct = K.kpi_windows(f)
    got = N.windows(store.read_parts("k_panes"))
    assert _rows(got.select("window_start", "events", "avg_speed")) == _rows(direct.select("window_start", "events", "avg_speed"))
    for lo, hi in (("2024-01-09 05:00:30", "2024-01-09 05:59:30"), ("2024-01-08 23:10:00", "2024-01-09 00:00:00"),
                   ("2024-01-05 00:00:00", "2024-01-20 00:00:00"), ("2024-01-05 03:00:00", "2024-01-06 02:00:00"),
                   ("2024-01-02 13:20:30", "2024-02-20 01:00:00")):
        own = f.filter((F.col("tst") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("tst") < F.lit(hi).cast("timestamp_ntz")))
        want = own.agg(F.count("*"), F.avg("spd"), F.avg("dl")).first()
        row = N.horizon(store, "k", lo, hi).first()
        assert (row["events"] or 0, row["avg_speed"], row["avg_delay_sec"]) == tuple(want)
    with pytest.raises(ValueError, match="multiples"):
        N.horizon(store, "k", "2024-01-02 00:00:07", "2024-01-03 00:00:00")


# ---------------------------------------------------------------- one parse, snapshots
@pytest.mark.parametrize("name", ["fact_select", "dedupe_events", "journey_filter", "journey_rejects", "envelope_flatten"])
def test_the_envelope_is_parsed_once(spark, name):
    assert Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_superseded_snapshots_go_and_kept_ones_stay(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.vacuum("t") == []
    for i in range(6):
        store.write_refresh("t", spark.createDataFrame([(i,)], "x int"))
        old = store.read("t")
    assert store.vacuum("t", keep=2) == [0, 1, 2, 3]
    assert old.collect()[0]["x"] == 5 and store.read("t").collect()[0]["x"] == 5 and store.vacuum("t", keep=2) == []


def test_a_reader_never_misses_the_published_table(spark, tmp_path):
    import threading

    target, seen, stop = str(tmp_path / "now"), [], threading.Event()
    rows = lambda i: spark.createDataFrame([(T0 + dt.timedelta(minutes=i), float(i))], "window_end timestamp_ntz, avg_speed double")
    publish_latest(rows(0), 0, target)

    def reader():
        while not stop.is_set():
            seen.append([r["batch_id"] for r in read_current(spark, target).collect()])

    t = threading.Thread(target=reader)
    t.start()
    try:
        for i in range(1, 11):
            publish_latest(rows(i), i, target)
    finally:
        stop.set()
        t.join()
    assert all(len(s) == 1 for s in seen) and [s[0] for s in seen] == sorted(s[0] for s in seen)
    assert read_current(spark, target).first()["batch_id"] == 10


def test_a_repeated_batch_finds_its_own_watermark(spark, tmp_path):
    from fleetlake.streaming.kpi_stream import read_metrics
    from fleetlake.streaming.late import keep_late, late_counts
    schema, at = "event_time timestamp, vehicle_number string", lambda s: dt.datetime(2024, 1, 1, 0, 10) + dt.timedelta(seconds=s)
    batch = lambda *s: spark.createDataFrame([(at(x), "v") for x in s] + [(None, "v")], schema)
    out = str(tmp_path)
    keep_late(batch(0, -5000), 0, out)          # the first batch has no watermark
    keep_late(batch(1000, -61, -30), 1, out)    # behind it: -61 s, whose newest window is still open
    keep_late(batch(939, 500, 2000), 2, out)    # behind 940 s: 939 (open), 500 (closed at 800)
    keep_late(batch(939, 500, 2000), 2, out)    # once more
    late = {(r["event_time"], r["lost"]) for r in spark.read.parquet(f"{out}/late").collect()}
    assert late == {(at(-61), False), (at(939), False), (at(500), True)}
    assert tuple(late_counts(read_metrics(spark, out)).first()) == (3, 1)
    keep_late(batch(), 3, out)
    assert tuple(late_counts(read_metrics(spark, out)).first()) == (3, 1)
