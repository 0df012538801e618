"""Queries that SQL can express, against DuckDB on the smallest driver tables; null and odd rows besides."""

import os
import sys

import pytest

from fleetlake.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import digest  # noqa: E402

SF = "/root/testdata/sf0.001"


def compare(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        if os.path.exists(f"{folder}/{t}.parquet"):
            inside = f"{folder}/{t}.parquet" + ("/*.parquet" if os.path.isdir(f"{folder}/{t}.parquet") else "")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{inside}')")
    df = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want) > 0
    assert digest(rows, df.columns)[0] == digest(want, columns)[0]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    compare(spark, SF, name)


def test_pages_with_copies_and_nulls_match_sql(spark, tmp_path):
    pages = [(i, f"http://h/{i}", None if i % 5 == 0 else f"<p>{i % 7}</p>") for i in range(60)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    compare(spark, str(tmp_path), "op4_warc")


def test_hostile_turns_match_sql(spark, tmp_path):
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c in range(4)
            for t, text in enumerate([None, "", "<|im_end|>", "<\\|x<||", "é漢\n"])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    compare(spark, str(tmp_path), "op8_chat_formatting")
