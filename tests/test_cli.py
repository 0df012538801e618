"""The job entry points run the whole chain on files: land (stream), events, routes, metrics."""

from fleetlake.__main__ import main
from fleetlake.plans import queries as Q
from fleetlake.sinks import TableStore
from fleetlake.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_path):
    root, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    Q.bronze(spark, SF).drop("insert_time").write.parquet(raw)
    X.routes_file(X.table(spark, SF, "part"), 1).write.option("header", True).csv(str(tmp_path / "routes"))
    main(["init", "--root", root])
    main(["land", "--root", root, "--raw", raw, "--available-now"])
    main(["events", "--root", root, "--rundate", "20240201"])
    main(["routes", "--root", root, "--file", str(tmp_path / "routes")])
    main(["metrics", "--root", root, "--raw", raw, "--available-now"])
    store = TableStore(spark, root)
    assert store.read("fact_vehicle_position").count() == Q.fact(spark, SF).count()
    assert store.read("dim_routes").filter("active_flg = 1").count() == X.routes_file(X.table(spark, SF, "part"), 1).count()
    assert spark.read.parquet(f"{root}/metrics/kpi").count() > 0
