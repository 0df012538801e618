"""Plan tests: partition pruning, pushed filters, broadcast joins, no Python evaluation."""

import pytest

from fleetlake.operators import analytics as A
from fleetlake.operators.silver import incremental
from fleetlake.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    Q.computed_fact(spark, SF).write.partitionBy("oday").parquet(path)
    return path


@pytest.mark.parametrize("name", ["route_delay_top", "route_density", "stop_bottlenecks", "sql_route_delay_top", "sql_route_density"])
def test_registered_day_reports_prune_the_stored_fact(spark, name):
    df = Q.QUERIES[name](spark, SF)
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(oday" in plan and "= 2024-01-08" in plan
    assert "TakeOrderedAndProject" in plan
    df.collect()
    assert "BroadcastHashJoin" in _plan(df)   # chosen from measured bytes, no hint


def test_day_report_reads_two_columns(spark, fact_table):
    plan = _plan(A.route_delay_top(spark.read.parquet(fact_table), Q.dim_routes(spark, SF), Q.DAY))
    assert "ReadSchema: struct<route_id:string,dl:int>" in plan   # 2 of 22 columns read


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    import datetime as dt
    b = Q.bronze(spark, SF)
    b.write.parquet(str(tmp_path / "b"))
    df = incremental(spark.read.parquet(str(tmp_path / "b")), dt.datetime(2024, 1, 15))
    assert "PushedFilters: [IsNotNull(insert_time), GreaterThan(insert_time,2024-01-15" in _plan(df)


def test_no_python_evaluation_in_any_registered_query(spark):
    for name, q in Q.QUERIES.items():
        if "chain" in name or "stream" in name:   # these run their jobs when called
            continue
        plan = _plan(q(spark, SF))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_dedupe_shuffles_only_what_is_used(spark):
    plan = _plan(Q.silver(spark, SF).groupBy("route_id").agg({"dl": "avg"}))
    assert plan.count("WindowGroupLimit") == 2     # before and after the shuffle
    shuffled = next(ln for ln in plan.split("\n") if "Exchange hashpartitioning(vehicle_number" in ln)
    assert shuffled
    below = plan.split("Exchange hashpartitioning(vehicle_number")[1]
    project = next(ln for ln in below.split("\n") if "Project [" in ln)
    assert project.count(",") < 10, project


def test_landing_day_prunes_the_listing(spark, tmp_path):
    import datetime as dt

    from fleetlake.streaming.landing import append_batch
    b = Q.bronze(spark, SF)
    append_batch(b, 0, str(tmp_path / "b"))
    plan = _plan(incremental(spark.read.parquet(str(tmp_path / "b")), dt.datetime(2024, 1, 15)))
    assert "PartitionFilters: [isnotnull(landed" in plan and "(landed" in plan.split("PartitionFilters")[1]


def test_fact_append_reads_only_touched_days(spark, fact_table):
    from pyspark.sql import functions as F

    from fleetlake.operators.gold import fact_new_rows
    existing = spark.read.parquet(fact_table)
    batch = Q.computed_fact(spark, SF).filter(F.col("insert_time").isNotNull())   # days not known statically
    days = sorted(r[0] for r in batch.select("oday").distinct().collect())
    one_day = batch.filter(F.col("tst") < F.lit(str(days[1])).cast("timestamp_ntz"))
    plan = _plan(fact_new_rows(one_day, existing))
    filters = [ln.split("PartitionFilters: [")[1].split("]")[0] for ln in plan.split("\n")
               if "FileScan" in ln and "PartitionFilters: [" in ln]
    assert any("oday" in f for f in filters)


def test_reports_write_only_the_gold_tables_they_read(spark, tmp_path):
    """A report on the fact alone writes no dimension; the dimensions are written whole once a report reads them."""
    import datetime as dt
    import math
    import os

    import pyarrow.parquet as pq

    start, sf = dt.datetime(2024, 1, 8, 6), str(tmp_path)
    events = [(i, start + dt.timedelta(seconds=37 * i), i % 7, "view", (i * 13 % 80) + 0.5, '{"k": %d}' % (i % 9)) for i in range(1, 120)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{sf}/events.parquet")
    spark.createDataFrame([(i, f"name {i}", "b", "t", i % 5) for i in range(20)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{sf}/part.parquet")
    base = f"{spark.conf.get('spark.checkpoint.dir')}/fleetlake-runs"
    before = set(os.listdir(base)) if os.path.exists(base) else set()

    def written():
        return sorted(t for run in set(os.listdir(base)) - before for t in os.listdir(f"{base}/{run}"))

    want = {}
    for i, _, user, _, value, _ in events:
        if i % 50:
            want.setdefault(f"R{user}", []).append(abs(math.floor(value * 5) - 200 + (i % 20 == 0)))
    got = {r["route_id"]: r for r in Q.QUERIES["route_on_time"](spark, sf).collect()}
    assert got.keys() == want.keys()
    for route, delays in want.items():
        assert got[route]["events"] == len(delays)
        assert got[route]["on_time_ratio_2"] == pytest.approx(sum(d <= 120 for d in delays) / len(delays))
    assert written() == ["bronze", "fact_vehicle_position"]
    run = next(r for r in set(os.listdir(base)) - before if os.path.exists(f"{base}/{r}/bronze"))
    raw = next(f for f in os.listdir(f"{base}/{run}/bronze") if f.endswith(".parquet"))
    assert pq.ParquetFile(f"{base}/{run}/bronze/{raw}").metadata.row_group(0).column(0).compression == "ZSTD"

    assert Q.dim_stops(spark, sf).count() == 20 and Q.dim_routes(spark, sf).count() > 0
    Q.QUERIES["route_on_time"](spark, sf).collect()
    assert written() == ["bronze", "dim_routes", "dim_stops", "fact_vehicle_position"]
