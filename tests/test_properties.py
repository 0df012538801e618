"""Property tests against brute force on small random inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlake.operators import analytics as A
from fleetlake.operators.scd2 import scd2_apply
from fleetlake.operators.silver import dedupe_latest

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 50)), min_size=1, max_size=40))
def test_dedupe_equals_python_max(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, t int")
    best = {}
    for k, o, t in rows:
        best[k] = max(best.get(k, (o, t)), (o, t))
    got = {r["k"]: (r["o"], r["t"]) for r in dedupe_latest(df, ["k"], ["o"], ["t"]).collect()}
    assert got == best


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), min_size=1, max_size=60), st.sampled_from([1, 3, 8, 64]))
def test_offset_gaps_equal_brute_force(spark, rows, bucket):
    by = defaultdict(list)
    for p, o in rows:
        by[p].append(o)
    expect = []
    for p, offs in by.items():
        offs.sort()
        for a, b in zip(offs, offs[1:]):
            if b > a + 1:
                expect.append((p, a + 1, b - 1, b - a - 1))
    df = spark.createDataFrame([("t", *r) for r in rows], "topic string, partition int, offset long")
    got = sorted(tuple(r)[1:] for r in A.offset_gaps(df, bucket_size=bucket).collect())
    assert got == sorted(expect)


LOAD = st.dictionaries(st.sampled_from("ABCDE"), st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)),
                       min_size=1, max_size=5)


@SETTINGS
@given(st.lists(LOAD, min_size=1, max_size=3))
def test_scd2_invariants(spark, loads):
    dim = None
    for i, load in enumerate(loads):
        now = dt.datetime(2024, 1, 1 + 7 * i)
        stg = spark.createDataFrame([(k, a, b) for k, (a, b) in load.items()], "k string, a string, b int")
        nxt = scd2_apply(dim, stg, "k", ["a", "b"], now)
        dim = spark.createDataFrame(nxt.collect(), nxt.schema)   # tiny test table: keep plans shallow
    rows = dim.collect()
    versions = defaultdict(list)
    for r in rows:
        versions[r["k"]].append(r)
    seen = set().union(*[set(ld) for ld in loads])
    assert set(versions) == seen
    last_values = {}
    for ld in loads:
        last_values.update(ld)
    for k, vs in versions.items():
        vs.sort(key=lambda r: r["effective_start_dt"])
        assert sum(r["active_flg"] for r in vs) == 1                       # one active version per key
        assert vs[-1]["active_flg"] == 1
        for a, b in zip(vs, vs[1:]):                                         # closed intervals do not overlap
            assert a["effective_end_dt"] < b["effective_start_dt"] and a["active_flg"] == 0
        assert (vs[-1]["a"], vs[-1]["b"]) == last_values[k]                  # current version = last seen values
    again = scd2_apply(dim, spark.createDataFrame([(k, a, b) for k, (a, b) in loads[-1].items()], "k string, a string, b int"),
                       "k", ["a", "b"], dt.datetime(2024, 3, 1))
    assert again.count() == len(rows)                                        # re-applying the last load changes nothing
