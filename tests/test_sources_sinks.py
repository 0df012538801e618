"""CSV sources (messy lines), Kafka decode, replay, table store and observed writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.schemas import STOPS_RAW_SCHEMA
from fleetlake.sinks import TableStore, observed_write
from fleetlake.sources import decode_kafka, read_csv_typed, read_delimited, replay

MESSY = [
    "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon,zone_id,stop_url,location_type,parent_station,"
    "wheelchair_boarding,platform_code,vehicle_type,radius",
    'S1,1,"Main St, North",desc,60.1,24.9,A,u,0,,1,,3,20',
    'S2,2,"The ""Big"" Stop",desc,60.2,24.8,A,u,0,P1,0,2,,30',
    "S3,3,Short,desc,60.3",
    "S4,4,Extra,desc,60.4,24.7,A,u,0,,2,,3,40,EXTRA",
    "S5,5,BadLat,desc,north,24.6,B,u,0,,9,,3,50",
    ",6,NoKey,desc,60.6,24.5,B,u,0,,1,,3,60",
]


def _write(tmp_path, lines):
    p = tmp_path / "stops.txt"
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_read_delimited_keeps_quoted_commas(spark, tmp_path):
    df = read_delimited(spark, _write(tmp_path, MESSY))
    rows = {r["stop_id"]: r for r in df.collect()}
    assert rows["S1"]["stop_name"] == "Main St, North"
    assert rows["S2"]["stop_name"] == 'The "Big" Stop'
    assert rows["S3"]["stop_lon"] is None          # short row -> missing fields NULL
    assert df.columns[0] == "stop_id"               # header is the first line, not the max string


def test_read_csv_typed_flags_corrupt_rows(spark, tmp_path):
    df = read_csv_typed(spark, _write(tmp_path, MESSY), STOPS_RAW_SCHEMA).cache()
    bad = {r["stop_code"] for r in df.filter(F.col("_corrupt_record").isNotNull()).collect()}
    assert "3" in bad and "4" in bad                  # short and extra-column rows
    clean = df.filter(F.col("stop_code") == "5").first()
    assert clean["stop_lat"] == "north"               # strings stay strings; typing happens in staging


def test_decode_kafka_and_replay(spark, tmp_path):
    rec = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b'{"a":1}'), "t", 0, 5, dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    out = decode_kafka(rec).first()
    assert out["json_str"] == '{"a":1}' and out["timestamp"] == dt.datetime(2024, 1, 1, 12, 0)
    decode_kafka(rec).write.parquet(str(tmp_path / "raw"))
    assert replay(spark, str(tmp_path / "raw"), "2024-01-01 11:00:00", "2024-01-01 13:00:00").count() == 1
    assert replay(spark, str(tmp_path / "raw"), "2024-01-01 12:00:01").count() == 0


def test_table_store_snapshots_and_partitions(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "lake"))
    st.write_refresh("dim", spark.range(3))
    assert st.read("dim").count() == 3
    # rebuild from the table itself: the new snapshot never overwrites what it reads
    st.write_refresh("dim", st.read("dim").filter("id > 0"))
    assert st.current_snapshot("dim") == 1 and st.read("dim").count() == 2
    stats = observed_write(spark.range(7), lambda d: st.write_append("log", d))
    assert stats["rows_written"] == 7


def test_a_listing_error_is_not_a_missing_table(spark, tmp_path, monkeypatch):
    import fleetlake.sinks as sinks
    st = TableStore(spark, str(tmp_path / "lake"))
    st.write_refresh("dim", spark.range(3))

    def broken(*a):
        raise OSError("listing failed")

    monkeypatch.setattr(sinks, "hadoop_path", broken)
    with pytest.raises(OSError, match="listing failed"):
        st.write_refresh("dim", spark.range(1))
    monkeypatch.undo()
    assert st.read("dim").count() == 3 and not st.exists("other")
    assert TableStore(spark, f"file://{tmp_path}/lake").read("dim").count() == 3
