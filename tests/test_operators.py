"""Unit tests per operator on tiny literal DataFrames: NULL, empty, malformed, tie, duplicate cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.exprs import parse_utc_ts, safe_cast
from fleetlake.operators import analytics as A
from fleetlake.operators import dq
from fleetlake.operators.envelope import filter_journey, journey_rejects, parse_topic_path, record_key, to_envelope
from fleetlake.operators.gold import dim_as_of, fact_new_rows, join_as_of
from fleetlake.operators.joblog import (
    DEFAULT_LOW, delete_job_log, last_loaded_value, latest_job_log, log_row, normalize_rundate, truncate_job_log,
)
from fleetlake.operators.scd2 import new_or_changed_keys, scd2_apply
from fleetlake.operators.silver import all_to_string, clean_dim, dedupe_latest, filter_delay_outliers

T = dt.datetime


def test_dedupe_latest_later_copy_wins_and_ties_break_on_offset(spark):
    df = spark.createDataFrame(
        [("v1", "t1", T(2024, 1, 1, 0, 0, 2), 0, 5, 10), ("v1", "t1", T(2024, 1, 1, 0, 0, 3), 0, 6, 11),
         ("v2", "t1", T(2024, 1, 1, 0, 0, 2), 1, 7, 20), ("v2", "t1", T(2024, 1, 1, 0, 0, 2), 1, 9, 21),
         ("v3", "t1", None, 0, 1, 30), ("v3", "t1", T(2024, 1, 1), 0, 0, 31)],
        "vehicle_number string, tst string, insert_time timestamp_ntz, p int, o long, dl int")
    out = {r["vehicle_number"]: r["dl"] for r in dedupe_latest(df, ["vehicle_number", "tst"], ["insert_time"], ["p", "o"]).collect()}
    assert out == {"v1": 11, "v2": 21, "v3": 31}  # NULL order value ranks lowest


def test_dedupe_hot_key_reduces_to_one_row(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("ord"))
    rows = dedupe_latest(df, ["k"], ["ord"]).collect()
    assert len(rows) == 1 and rows[0]["ord"] == 4999


def test_dedupe_is_idempotent(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("ord"))
    once = dedupe_latest(df, ["k"], ["ord"])
    assert sorted(once.collect()) == sorted(dedupe_latest(once, ["k"], ["ord"]).collect())


def test_safe_casts_null_bad_values_under_ansi(spark):
    df = spark.createDataFrame([("12", "2024-01-01T10:00:00.5Z"), ("x", "garbage"), (None, "2024-01-01T12:00:00+02:00")],
                               "a string, t string")
    rows = df.select(safe_cast("a", "int").alias("a"), parse_utc_ts("t").alias("t")).collect()
    assert [r["a"] for r in rows] == [12, None, None]
    assert rows[0]["t"] == T(2024, 1, 1, 10, 0, 0, 500000)
    assert rows[1]["t"] is None
    assert rows[2]["t"] == T(2024, 1, 1, 10, 0, 0)  # offset converted to UTC wall clock


def test_parse_topic_path_short_and_blank(spark):
    df = spark.createDataFrame([("/hfp/v2/journey/ongoing/vp/bus/0022/00123/R1/1/Terminal/10:00/S1/4/60;24/",),
                                ("/hfp/v2/journey/ongoing/vp/bus/0022/",), ("/hfp/v2/journey/ongoing/vp/bus/0022//R9",)],
                               "topic_path string")
    rows = parse_topic_path(df).select("vehicle_number", "route_id", "sid", record_key().alias("k")).collect()
    assert rows[0]["vehicle_number"] == "00123" and rows[0]["sid"] == ""
    assert rows[1]["route_id"] is None and rows[1]["k"] == "unknown"
    assert rows[2]["k"] == "R9"


def test_to_envelope_round_trip(spark):
    from fleetlake.operators.envelope import flatten_envelope
    from fleetlake.sources.fixtures import bronze_events
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    b = bronze_events(ev, resend_every=None)
    flat = flatten_envelope(b)
    back = to_envelope(flat).select("key", "json_str")
    assert sorted(back.collect()) == sorted(b.select("key", "json_str").collect())


def test_journey_filter_and_rejects_partition_rows(spark):
    df = spark.createDataFrame(
        [("journey", "ongoing", "bus", "1", "R", T(2024, 1, 1)), ("deadrun", "ongoing", "bus", "1", "R", T(2024, 1, 1)),
         ("journey", "ongoing", "tram", "1", "R", T(2024, 1, 1)), ("journey", "ongoing", "bus", "", "R", T(2024, 1, 1)),
         ("journey", "ongoing", None, "1", "R", T(2024, 1, 1)), ("journey", "ongoing", "bus", "1", "R", None)],
        "journey_type string, temporal_type string, transport_mode string, vehicle_number string, route_id string, tst timestamp_ntz")
    assert filter_journey(df).count() == 1
    reasons = sorted(r[0] for r in journey_rejects(df).select("reject_reason").collect())
    assert reasons == ["mode", "mode", "no_tst", "no_vehicle", "not_journey"]


def test_delay_outlier_bounds(spark):
    df = spark.createDataFrame([(1800,), (-1800,), (1801,), (None,), (0,)], "dl int")
    assert sorted(r[0] for r in filter_delay_outliers(df).collect()) == [-1800, 0, 1800]


def test_all_to_string_and_clean_dim(spark):
    df = spark.createDataFrame([(1, None, "7", "drop")], "a int, b string, c string, d string")
    out = clean_dim(all_to_string(df), drop=["d"], defaults={"b": "NA"}, casts={"c": "int"})
    assert out.columns == ["a", "b", "c"] and out.first().asDict() == {"a": "1", "b": "NA", "c": 7}


def test_dq_rules_null_semantics(spark):
    df = spark.createDataFrame([("a", 0, 1), ("", 3, 1), (None, None, 1), ("a", 1, 1)], "k string, w int, active_flg int")
    rep = {(r["rule"], r["target"]): r["violations"] for r in dq.dq_report(df, [
        dq.not_empty(), dq.columns_exist(["k", "zz", "yy"]), dq.no_nulls("k"), dq.no_nulls("w"),
        dq.no_duplicates(["k"]), dq.values_in_set("w", [0, 1, 2]), dq.active_unique(["k"])], "t").collect()}
    assert rep[("not_empty", "")] == 0
    assert rep[("columns_exist", "k,zz,yy")] == 2
    assert rep[("no_nulls", "k")] == 2          # NULL and '' on a string column
    assert rep[("no_nulls", "w")] == 1          # only NULL on an int column
    assert rep[("no_duplicates", "k")] == 1
    assert rep[("values_in_set", "w")] == 1     # NULL passes, 3 fails
    assert rep[("active_unique", "k")] == 1
    with pytest.raises(ValueError, match="QC FAILED"):
        dq.check(df, [dq.no_nulls("k")], "t")
    with pytest.raises(ValueError, match="QC FAILED"):
        dq.check(df.limit(0), [dq.not_empty()], "t")
    dq.check(df, [dq.values_in_set("w", [0, 1, 3])], "t")


def _dim_rows(spark, rows):
    return spark.createDataFrame(rows, "route_id string, name string, rtype int, insert_time timestamp_ntz")


def test_scd2_properties(spark):
    load1 = _dim_rows(spark, [("A", "a", 1, T(2024, 1, 1)), ("B", "b", 1, T(2024, 1, 1)), ("C", None, 1, T(2024, 1, 1))])
    load2 = _dim_rows(spark, [("A", "a", 2, T(2024, 2, 1)), ("C", "c", 1, T(2024, 2, 1)), ("D", "d", 1, T(2024, 2, 1))])
    d1 = scd2_apply(None, load1, "route_id", ["name", "rtype"], "2024-01-01 00:00:00")
    d2 = scd2_apply(d1, load2, "route_id", ["name", "rtype"], "2024-02-01 00:00:00")
    rows = d2.collect()
    active = [r for r in rows if r["active_flg"] == 1]
    assert sorted(r["route_id"] for r in active) == ["A", "B", "C", "D"]      # B missing from load2 stays active
    assert len(rows) == 6                                                       # A and C closed + reopened
    closed = {r["route_id"]: r for r in rows if r["active_flg"] == 0}
    assert closed["A"]["effective_end_dt"] == T(2024, 1, 31, 23, 59, 59)
    # plain <> misses the NULL -> 'c' change
    d2p = scd2_apply(d1, load2, "route_id", ["name", "rtype"], "2024-02-01 00:00:00", null_safe=False)
    assert sorted(r["route_id"] for r in d2p.collect() if r["active_flg"] == 0) == ["A"]
    # applying the same load twice changes nothing
    d3 = scd2_apply(d2, load2, "route_id", ["name", "rtype"], "2024-02-01 00:00:00")
    assert sorted(map(repr, d3.collect())) == sorted(map(repr, rows))
    # intervals of a key do not overlap; one active row per key
    rep = dq.dq_report(d2, [dq.active_unique(["route_id"])]).first()
    assert rep["passed"]
    # point-in-time state and as-of join
    jan = {r["route_id"]: r["rtype"] for r in dim_as_of(d2, "route_id", "2024-01-15 00:00:00").collect()}
    assert jan == {"A": 1, "B": 1, "C": 1}
    fact = spark.createDataFrame([("A", T(2024, 1, 20)), ("A", T(2024, 2, 2)), ("D", T(2024, 1, 20))],
                                 "route_id string, tst timestamp_ntz")
    j = sorted((r["tst"], r["rtype"]) for r in join_as_of(fact, d2, "route_id", "route_id", "tst", ["rtype"]).collect())
    assert j == [(T(2024, 1, 20), 1), (T(2024, 2, 2), 2)]


def test_fact_new_rows_is_idempotent(spark):
    old = spark.createDataFrame([(dt.date(2024, 1, 1), "v", T(2024, 1, 1, 1))], "oday date, vehicle_number string, tst timestamp_ntz")
    batch = spark.createDataFrame([(dt.date(2024, 1, 1), "v", T(2024, 1, 1, 1)), (dt.date(2024, 1, 2), "v", T(2024, 1, 2, 1))],
                                  "oday date, vehicle_number string, tst timestamp_ntz")
    new = fact_new_rows(batch, old)
    assert [r["oday"] for r in new.collect()] == [dt.date(2024, 1, 2)]
    assert fact_new_rows(new, old.unionByName(new)).count() == 0


def test_offset_gaps_bucket_edges_match_plain_lead(spark):
    offs = [0, 1, 2, 5, 6, 7, 8, 9, 15, 16, 16, 17, 31, 32]
    # topic b fills the gaps of topic a, and the other way round
    df = spark.createDataFrame([("a", 0, o) for o in offs] + [("a", 1, o) for o in (3, 4, 9)]
                               + [("b", 0, o) for o in range(33) if o not in offs], "topic string, partition int, offset long")
    expect = sorted([("a", 0, 3, 4, 2), ("a", 0, 10, 14, 5), ("a", 0, 18, 30, 13), ("a", 1, 5, 8, 4),
                     ("b", 0, 5, 9, 5), ("b", 0, 15, 17, 3)])
    for b in (1, 2, 4, 1 << 20):
        got = sorted(tuple(r) for r in A.offset_gaps(df, bucket_size=b).collect())
        assert got == expect, b


def test_job_log_helpers(spark):
    assert normalize_rundate("20240105") == dt.date(2024, 1, 5)
    assert normalize_rundate("2024-01-05") == dt.date(2024, 1, 5)
    assert normalize_rundate(None) == dt.date(1900, 1, 1)
    log = (log_row(spark, "s", "t", T(2024, 1, 1), "2024-01-01", T(2024, 1, 1, 1))
           .unionByName(log_row(spark, "s", "t", T(2024, 1, 2), "20240102", T(2024, 1, 2, 1)))
           .unionByName(log_row(spark, "s", "u", T(2024, 1, 3), None, T(2024, 1, 3, 1))))
    assert last_loaded_value(log, "s", "t") == T(2024, 1, 2)
    assert last_loaded_value(log, "x", "y") == DEFAULT_LOW
    assert {r["table_name"]: r["rundate"] for r in latest_job_log(log).collect()} == {"t": "2024-01-02", "u": "1900-01-01"}
    assert delete_job_log(log, "s", "t").count() == 1
    assert truncate_job_log(log).count() == 0


def test_dim_as_of_shows_the_state_of_that_day(spark):
    d = scd2_apply(None, _dim_rows(spark, [("A", "a", 1, T(2024, 1, 1))]), "route_id", ["rtype"], "2024-01-01 00:00:00")
    d = scd2_apply(d, _dim_rows(spark, [("A", "a", 2, T(2024, 2, 1))]), "route_id", ["rtype"], "2024-02-01 00:00:00")
    r = dim_as_of(d, "route_id", "2024-01-15 00:00:00").first()
    assert (r["rtype"], r["active_flg"], r["effective_end_dt"], r["update_dt"]) == (1, 1, T(9999, 12, 31), T(2024, 1, 1))


def test_keys_to_open_are_new_or_just_closed(spark):
    d = scd2_apply(None, _dim_rows(spark, [("A", "a", 1, T(2024, 1, 1)), ("B", "b", 1, T(2024, 1, 1))]), "route_id", ["rtype"],
                   "2024-01-01 00:00:00")
    stg = _dim_rows(spark, [("A", "a", 2, T(2024, 2, 1)), ("B", "b", 1, T(2024, 2, 1)), ("C", "c", 1, T(2024, 2, 1))])
    keys = new_or_changed_keys(stg, d, "route_id", ["rtype"], "2024-02-01 00:00:00")
    assert sorted(r["route_id"] for r in keys.collect()) == ["A", "C"]


def test_fact_keys_match_null_safely(spark):
    schema = "oday date, vehicle_number string, tst timestamp_ntz"
    rows = spark.createDataFrame([(None, "v", T(2024, 1, 1)), (dt.date(2024, 1, 1), None, None)], schema)
    assert fact_new_rows(rows, rows).count() == 0


def test_malformed_times_are_typed_before_dedupe(spark):
    from fleetlake.operators.silver import silver_events, silver_rejects
    flat = spark.createDataFrame(
        [("v", "bad", "x"), ("v", "worse", "x"), ("v", "2024-01-01T00:00:00Z", "2024-01-01"),
         ("v", "2024-01-01T02:00:00+02:00", "2024-01-01"), ("", "2024-01-01T00:00:00Z", "2024-01-01"), ("w", None, None)],
        "vehicle_number string, tst string, oday string").withColumns({
            "insert_time": F.lit("2024-01-01").cast("timestamp_ntz"), "kafka_partition": F.lit(0), "kafka_offset": F.lit(1)})
    assert silver_events(flat, "2024-01-01 00:00:00").count() == 1
    assert sorted(r["reject_reason"] for r in silver_rejects(flat, "2024-01-01 00:00:00").collect()) == ["no_tst"] * 3 + ["no_vehicle"]


def test_dimension_ties_are_decided_by_value(spark):
    from fleetlake.operators.silver import stage_dim
    rows = [("A", "x", 1, T(2024, 1, 1)), ("A", "y", 0, T(2024, 1, 1)), ("A", None, 9, T(2024, 1, 1))]
    for order in (rows, rows[::-1]):
        assert stage_dim(_dim_rows(spark, order), "route_id", {}).first()["name"] == "y"


def test_a_cluster_without_a_shared_folder_is_an_error():
    from fleetlake.session import shared_dir

    class Fake:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:1"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Fake())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
