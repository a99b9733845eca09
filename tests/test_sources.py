from __future__ import annotations

import io
import json
import zipfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from punctua.contract import AIRCRAFT_FIELDS, FLIGHT_COLUMNS, FLIGHT_TYPES, WEATHER_VARS
from punctua.sources import airports, documents, flight_files, kafka, maintain, tables


def raw_month(**over):
    row = {c: 1 for c in FLIGHT_COLUMNS}
    row |= {"FlightDate": "2024-01-10", "Reporting_Airline": "DL", "Origin": "ATL", "Dest": "JFK",
            "CRSElapsedTime": "120.0", "DepDelayMinutes": "7.5", "DepDel15": "0.00",
            "DepDelay": 7, "WheelsOff": 830, "Unnamed: 109": ""}
    return {**row, **over}


@pytest.fixture
def csv_text():
    frame = pd.DataFrame([raw_month(), raw_month(Origin="SEA", CarrierDelay="", Distance="n/a")])
    return frame.to_csv(index=False)


def check_month(df):
    assert df.columns == list(FLIGHT_COLUMNS.values())
    assert dict(df.dtypes) == FLIGHT_TYPES
    rows = {r.origin: r for r in df.collect()}
    assert len(rows) == 2
    assert (rows["ATL"].crs_elapsed_time, rows["ATL"].dep_delay_minutes) == (120, 7.5)
    assert rows["SEA"].distance is None and rows["SEA"].carrier_delay is None


def test_csv(spark, tmp_path, csv_text):
    (tmp_path / "m.csv").write_bytes(csv_text.encode("latin-1"))
    check_month(flight_files.read_flights_csv(spark, str(tmp_path / "m.csv")))


def test_zip(spark, tmp_path, csv_text):
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("readme.html", "<html/>")
            z.writestr("On Time (x).csv", csv_text.encode("latin-1"))
    both = flight_files.read_flights_zip(spark, str(tmp_path / "*.zip"), chunk_rows=1)
    assert both.count() == 4
    check_month(flight_files.read_flights_zip(spark, str(tmp_path / "a.zip")))


def test_csv_with_missing_column(spark, tmp_path, caplog):
    frame = pd.DataFrame([raw_month()]).drop(columns=["Diverted"])
    frame.to_csv(tmp_path / "m.csv", index=False)
    df = flight_files.read_flights_csv(spark, str(tmp_path / "m.csv"))
    assert "diverted" not in df.columns and "Diverted" in caplog.text
    pd.DataFrame([raw_month(Origin="SEA")]).to_csv(tmp_path / "n.csv", index=False)
    both = flight_files.read_flight_months(spark, [str(tmp_path / "m.csv"), str(tmp_path / "n.csv")])
    assert {(r.origin, r.diverted) for r in both.collect()} == {("ATL", None), ("SEA", 1)}


def test_airports_file(spark, tmp_path):
    lines = [
        '1,"Hartsfield, Jackson","Atlanta","United States","ATL","KATL",33.6367,-84.4281,1026,"-5","A","America/New_York","airport","x"',
        '2,"Kennedy","New York","United States","JFK","KJFK",40.6398,-73.7789,13,\\N,"A","America/New_York","airport","x"',
        '9,"Second Kennedy","New York","United States","JFK","KJFK",1.0,1.0,13,"-5","A","America/New_York","airport","x"',
        '3,"Heathrow","London","United Kingdom","LHR","EGLL",51.47,-0.45,83,"0","E","Europe/London","airport","x"',
        '4,"Nameless","Nowhere","United States",\\N,"KXXX",1.0,2.0,0,"-5","A","America/New_York","airport","x"',
        '5,"Long code","Nowhere","United States","ABCD","KXXX",1.0,2.0,0,"-5","A","America/New_York","airport","x"',
        '6,"No place","Nowhere","United States","NOP","KNOP",\\N,2.0,0,"-5","A","America/New_York","airport","x"',
    ]
    path = tmp_path / "airports.dat"
    path.write_text("\n".join(lines))
    rows = {r.iata: r for r in airports.airports_table(spark, str(path)).collect()}
    assert set(rows) == {"ATL", "JFK", "XWA"}
    assert rows["ATL"].name == "Hartsfield, Jackson" and rows["ATL"].tz == "-5"
    assert rows["JFK"].name == "Kennedy" and rows["JFK"].tz is None
    assert rows["XWA"].lat == 48.2594 and rows["XWA"].zone == "America/Chicago"


def test_hourly_weather_document(spark):
    doc = {"hourly": {"time": ["2022-01-01T00:00", "2022-01-01T01:00"],
                      "temperature_2m": [1.0, 2.0], "precipitation": [0.5, None]}}
    docs = spark.createDataFrame(
        [("ATL", json.dumps(doc)), ("BAD", "{not json"), ("EMP", "{}")], "iata string, doc string")
    rows = documents.parse_hourly_weather(docs).orderBy("time").collect()
    assert [(r.iata, r.time.hour, r.temperature_2m, r.precipitation) for r in rows] == [
        ("ATL", 0, 1.0, 0.5), ("ATL", 1, 2.0, None)]
    assert all(r[v] is None for r in rows for v in WEATHER_VARS[2:])


def test_state_vectors(spark):
    states = [
        ["ab1644", "UAL1091 ", "US", 1, 2, -96.42, 29.33, 6000.0, False, 230.1, 88.0, 0, None, 6606.5, "7", False, 0],
        ["c0ffee", None, "US", 1, 2, -80.0, 30.0, None, True, None, None, 0, None, 12.0],
        ["d00d00", "  ", "US", 1, 2, -81.0, 31.0, 6500.0, None, 1.0, 2.0],
        ["nopos", "X", "US", 1, 2, None, None, 1.0, False],
    ]
    doc = json.dumps({"time": 1781639300, "states": states})
    docs = spark.createDataFrame([(doc,), ('{"time": 1, "states": null}',)], "doc string")
    rows = {r.icao24: r for r in documents.parse_state_vectors(docs).collect()}
    assert set(rows) == {"ab1644", "c0ffee", "d00d00"}
    assert (rows["ab1644"].callsign, rows["ab1644"].altitude, rows["ab1644"].on_ground) == (
        "UAL1091", 6606.5, False)
    assert (rows["c0ffee"].callsign, rows["c0ffee"].altitude, rows["c0ffee"].on_ground) == (None, 12.0, True)
    assert (rows["d00d00"].altitude, rows["d00d00"].on_ground) == (6500.0, False)


def test_snapshot_and_messages(spark):
    doc = json.dumps({"time": 1781639300, "states": [
        ["a", "A ", "US", 1, 2, -90.0, 40.0, 1.0, False, 2.0, 3.0],
        ["b", "B", "US", 1, 2, -91.0, 41.0, 1.0, True, 2.0, 3.0]]})
    rows = documents.parse_state_vectors(spark.createDataFrame([(doc,)], "doc string"))
    snap = rows.groupBy(F.col("snapshot_time").alias("as_of")).agg(
        F.collect_list(F.struct(*AIRCRAFT_FIELDS)).alias("aircraft"))
    out = documents.snapshot_payload(snap, F.lit(1781639312)).first()
    assert (out.as_of, out.stale_seconds, out["count"], out.source) == (1781639300, 12, 2, "live")
    assert set(out.aircraft[0].asDict()) == set(AIRCRAFT_FIELDS)
    timed = rows.withColumn("event_ts", F.col("snapshot_time")).unionByName(
        rows.limit(1).withColumns({"event_ts": F.lit(5).cast("bigint"), "icao24": F.lit(None).cast("string")}))
    sent = documents.event_messages(timed).collect()
    assert sorted(r.key for r in sent) == ["a", "b"]
    body = json.loads(sent[0].value)
    assert set(body) == set(AIRCRAFT_FIELDS) | {"event_ts"}


def test_forecast_reach(spark):
    df = spark.sql("SELECT DATE'2024-01-10' AS today, explode(array(-1, 0, 16, 17)) AS k")
    ok = documents.forecast_in_reach(F.expr("date_add(today, k)"), F.col("today"), 16)
    assert [r.ok for r in df.select(ok.alias("ok")).collect()] == [False, True, True, False]


def test_tables_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("year"))
    tables.write_table(df, path, partition_by=["year"])
    tables.write_table(df.where("year = 1").limit(1), path, partition_by=["year"])
    back = tables.read_table(spark, path)
    assert {(r.year, r.n) for r in back.groupBy("year").agg(F.count("*").alias("n")).collect()} == {(0, 5), (1, 1)}
    with pytest.raises(ValueError):
        tables.read_table(spark, path, "orc")
    with pytest.raises(ValueError, match="lacks"):
        tables.require_columns(back, ["id", "nope"])
    assert tables.require_columns(back, ["id", "id"]).columns == ["id"]


def test_saved_tables_and_comments(spark):
    tables.create_schema(spark, "marts", "what's in it")
    tables.save_table(spark.range(3), "marts.three", comment="it's three")
    tables.save_table(spark.range(2).withColumn("x", F.lit(1)), "marts.three", comment="it's two")
    assert spark.table("marts.three").columns == ["id", "x"]
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED marts.three").collect()}
    assert info["Comment"] == "it's two"


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    got = {(r.id, r.a, r.b) for r in tables.union_by_name([a, b]).collect()}
    assert got == {(1, "x", None), (2, None, "y")}


def test_pending_partitions(spark):
    wanted = maintain.month_grid(spark, [2023, 2024], [1, 2])
    have = spark.createDataFrame([(2023, 1), (2024, 2), (2024, 2)], "year int, month int")
    left = maintain.pending_partitions(wanted, have, ["year", "month"])
    assert {(r.year, r.month) for r in left.collect()} == {(2023, 2), (2024, 1)}
    assert maintain.pending_partitions(wanted, have, ["year", "month"], overwrite=True).count() == 4


def _month(folder, values, kind):
    folder.mkdir(parents=True)
    table = pa.table({"origin": ["A"] * len(values), "crs_elapsed_time": pa.array(values, kind)})
    pq.write_table(table, folder / "data.parquet")


def test_type_repair(spark, tmp_path):
    src = tmp_path / "bronze"
    _month(src / "year=2024" / "month=1", [90, 100, 150], pa.int64())
    _month(src / "year=2024" / "month=2", [90.0, None, 150.0], pa.float64())
    _month(src / "year=2024" / "month=3", ["90.0", "x", "7"], pa.string())
    bad = src / "year=2024" / "month=4"
    bad.mkdir()
    (bad / "data.parquet").write_bytes(b"not parquet")
    n, unreadable = maintain.repair_types(spark, str(src), str(tmp_path / "fixed"), ["year", "month"])
    assert n == 3 and len(unreadable) == 1 and unreadable[0].endswith("month=4")
    def content(path):
        df = spark.read.parquet(path)
        assert dict(df.dtypes)["crs_elapsed_time"] == "bigint"
        return sorted((r.month, r.crs_elapsed_time or -1) for r in df.collect())
    once = content(str(tmp_path / "fixed"))
    assert once == [(1, 90), (1, 100), (1, 150), (2, -1), (2, 90), (2, 150), (3, -1), (3, 7), (3, 90)]
    assert maintain.repair_types(
        spark, str(tmp_path / "fixed"), str(tmp_path / "again"), ["year", "month"])[0] == 3
    assert content(str(tmp_path / "again")) == once


def test_timestamp_repair(spark, tmp_path):
    src = tmp_path / "weather"
    for iata, unit in (("AAA", "ns"), ("BBB", "us"), ("007", "us")):
        folder = src / f"iata={iata}"
        folder.mkdir(parents=True)
        stamps = np.array(["2024-01-12T14:00:00.123456"], dtype=f"datetime64[{unit}]")
        pq.write_table(pa.table({"time": pa.array(stamps, pa.timestamp(unit, "UTC")), "x": [1.0]}),
                       folder / "data.parquet")
    out = str(tmp_path / "fixed")
    assert maintain.repair_timestamps(spark, str(src), out, ["iata"])[0] == 3
    assert (tmp_path / "fixed" / "iata=007").is_dir()
    rows = spark.read.parquet(out).select("iata", F.unix_micros("time").alias("t")).collect()
    assert {r.iata for r in rows} == {"AAA", "BBB", "007"}
    assert {r.t for r in rows} == {1705068000123456}
    assert maintain.repair_timestamps(spark, out, str(tmp_path / "again"), ["iata"])[0] == 3


def test_seed_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "flight_date,year,dep_hour,carrier,origin,dest,dep_del15,cancelled,distance\n"
        "2024-01-10,2024,8,DL,ATL,JFK,1,0,760\n")
    row = flight_files.read_seed_flights(spark, str(tmp_path / "f.csv")).first()
    assert (row.flight_date.isoformat(), row.dep_hour, row.distance) == ("2024-01-10", 8, 760.0)
    (tmp_path / "a.csv").write_text("iata,name,lat,lon\nATL,Atlanta,33.6,-84.4\n")
    assert flight_files.read_seed_airports(spark, str(tmp_path / "a.csv")).first().lat == 33.6


def test_kafka_options():
    opts = kafka.kafka_options("host:9092", "positions")
    assert opts == {"kafka.bootstrap.servers": "host:9092", "subscribe": "positions",
                    "startingOffsets": "latest", "failOnDataLoss": "false"}
