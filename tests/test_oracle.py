"""Every registered query against its DuckDB oracle on the smallest driver tables (the driver's gate)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from fleetlake.plans.oracle import ORACLE_SQL as SQL  # noqa: E402
from fleetlake.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["oday", "route_short_name", "route_long_name", "avg_delay_min"]
    assert len(df.collect()) >= 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]
