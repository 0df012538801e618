"""Layer chains: empty-table init, DQ gates, rerun idempotence, SQL surface plans."""

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import queries as Q
from fleetlake.plans.chains import delete_logged, job_log, run_events, run_routes, run_stops, truncate_logged
from fleetlake.sinks import TableStore, init_tables
from fleetlake.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def test_init_tables_then_full_load_is_the_same_path(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    assert init_tables(store) == ["job_control", "dim_routes", "dim_stops"]
    assert init_tables(store) == []
    assert store.read("dim_routes").count() == 0
    part = X.table(spark, SF, "part")
    run_routes(spark, store, X.landed(X.routes_file(part, 1), Q.LOAD1, Q.LOAD1[:10]), now=Q.LOAD1, rundate="20240101")
    d = store.read("dim_routes")
    assert d.count() == X.routes_file(part, 1).count()
    assert d.filter("active_flg = 1").count() == d.count()
    logged = {(r["schema_name"], r["table_name"]) for r in job_log(store).collect()}
    assert ("hdw", "dim_routes") in logged and ("hdw_stg", "routes_stg") in logged
    # second file: write history counts opened and closed versions without rescanning
    stats = run_routes(spark, store, X.landed(X.routes_file(part, 2), Q.LOAD2, Q.LOAD2[:10]), now=Q.LOAD2, rundate="20240115")
    d2 = store.read("dim_routes")
    assert stats["dim"]["rows_updated"] == d2.filter("active_flg = 0").count() > 0
    assert stats["dim"]["rows_inserted"] == d2.filter(f"effective_start_dt = timestamp_ntz'{Q.LOAD2}'").count() > 0
    hist = {r["table_name"]: r for r in store.read("job_metrics").filter(f"run_at = timestamp_ntz'{Q.LOAD2}'").collect()}
    assert hist["dim_routes"]["rows_written"] == d2.count()


def test_stops_chain_enforces_wheelchair_codes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    part = X.table(spark, SF, "part")
    bad = X.landed(X.stops_file(part), Q.LOAD1, Q.LOAD1[:10])
    with pytest.raises(ValueError, match="QC FAILED.*wheelchair_boarding"):
        run_stops(spark, store, bad, now=Q.LOAD1, rundate=Q.LOAD1[:10])
    good = bad.withColumn("wheelchair_boarding", (F.col("wheelchair_boarding").cast("int") % 3).cast("string"))
    store2 = TableStore(spark, str(tmp_path / "lake2"))
    run_stops(spark, store2, good, now=Q.LOAD1, rundate=Q.LOAD1[:10])
    assert store2.read("dim_stops").count() == part.count()


def test_events_chain_rerun_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    b = Q.bronze(spark, SF)
    run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    n = store.read("fact_vehicle_position").count()
    stats = run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    assert stats == {"silver_rows": 0, "fact_rows": 0}
    assert store.read("fact_vehicle_position").count() == n == Q.fact(spark, SF).count()
    # even with the log cleared, the anti-join keeps the fact free of duplicates
    truncate_logged(store)
    assert job_log(store).count() == 0
    run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    f = store.read("fact_vehicle_position")
    assert f.count() == n and f.select("vehicle_number", "tst").distinct().count() == n


def test_sql_surface_plans_like_dataframe(spark):
    df = Q.q_sql_route_delay_top(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, Q.q_route_delay_top(spark, SF).collect()))


@pytest.mark.parametrize("step", ["events_stg", "fact_vehicle_position", "events_rejects", "job_control"])
def test_events_chain_recovers_from_a_failure_of_any_step(spark, tmp_path, monkeypatch, step):
    b = Q.bronze(spark, SF).withColumn("json_str", F.when(F.col("offset") == 3, F.lit("{}")).otherwise(F.col("json_str")))
    want = TableStore(spark, str(tmp_path / "want"))
    run_events(spark, want, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    store, failed = TableStore(spark, str(tmp_path / "lake")), []

    def once(write):
        def go(name, *a, **k):
            if name == step and not failed:
                failed.append(name)
                raise OSError("planned")
            return write(name, *a, **k)
        return go

    for method in ("write_append", "write_refresh"):
        monkeypatch.setattr(store, method, once(getattr(store, method)))
    with pytest.raises(OSError, match="planned"):
        run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    for table in ("fact_vehicle_position", "events_rejects"):
        assert store.read(table).count() == want.read(table).count() > 0
    assert run_events(spark, store, b, now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10]) == {"silver_rows": 0, "fact_rows": 0}


def test_deleting_from_the_log_keeps_the_rest(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    run_events(spark, store, Q.bronze(spark, SF), now=Q.FACT_NOW, rundate=Q.FACT_NOW[:10])
    before = job_log(store).count()
    delete_logged(store, "hdw_stg", "events_stg")
    left = job_log(store).collect()
    assert len(left) == before - 1 and all(r["table_name"] != "events_stg" for r in left)


def test_landing_log_holds_the_time_that_was_written(spark, tmp_path):
    from fleetlake.functions.exprs import utc_ntz
    store = TableStore(spark, str(tmp_path / "lake"))
    raw = X.routes_file(X.table(spark, SF, "part"), 1)
    landed = raw.withColumn("insert_time", utc_ntz(F.current_timestamp())).withColumn("rundate", F.lit("2024-01-01").cast("date"))
    run_routes(spark, store, landed, now=Q.LOAD1, rundate="20240101")
    logged = job_log(store).filter("table_name = 'routes_ld'").first()["max_timestamp"]
    assert logged == store.read("routes_ld").agg(F.max("insert_time")).first()[0]


def test_missing_column_is_named(spark):
    from fleetlake.operators import dq
    df = spark.createDataFrame([("a", 1)], "k string, active_flg int")
    with pytest.raises(ValueError, match="QC FAILED.*columns_exist.*missing: gone"):
        dq.check(df, [dq.columns_exist(["k", "gone"]), dq.no_nulls("gone"), dq.no_duplicates(["gone"])], "t")
