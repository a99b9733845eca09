from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from punctua.session import STREAMING
from punctua.streaming.congestion import (
    Windows, as_messages, congestion, parse_messages, positions_of, rejected,
)
from punctua.streaming import latest, sinks

T0 = 1_700_000_040  # a whole number of two-minute windows


def message(icao, ts, lat=40.2, lon=-100.2, alt=100.0, ground=False):
    return (icao, json.dumps({"icao24": icao, "callsign": None, "lat": lat, "lon": lon,
                              "altitude": alt, "velocity": 1.0, "heading": 2.0,
                              "on_ground": ground, "event_ts": ts}))


def put(spark, folder, rows):
    """One file per call, so that each call is one micro-batch."""
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").json(str(folder))


def stream_of(spark, folder):
    return (spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1)
            .json(str(folder)))


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


FIRST = [message("a", T0), message("b", T0 + 10, ground=True), message("a", T0 + 20, alt=300.0),
         message("c", T0 + 30, lat=60.0), message("d", T0 + 130), ("x", "{broken"),
         message("n", T0, lat=None)]


def test_parse_and_reject(spark):
    parsed = parse_messages(spark.createDataFrame(FIRST, "key string, value string"))
    assert sorted(r.icao24 for r in positions_of(parsed).collect()) == ["a", "a", "b", "c", "d"]
    assert sorted(r.message_key for r in rejected(parsed).collect()) == ["n", "x"]


def test_batch_windows(spark):
    rows = positions_of(parse_messages(spark.createDataFrame(FIRST, "key string, value string")))
    got = congestion(rows, Windows(exact=True)).orderBy("window_start").collect()
    assert [(r.aircraft_count, r.on_ground_count, r.avg_altitude_m) for r in got] == [(2, 1, 167.0), (1, 0, 100.0)]
    assert (got[0].cell_lat, got[0].cell_lon) == (40.0, -100.5)
    assert congestion(rows, Windows(exact=True, min_count=2)).count() == 1
    sliding = congestion(rows, Windows(slide="1 minute", exact=True))
    assert sliding.count() == 4


def test_stream_equals_batch_and_late_rows_drop(spark, tmp_path):
    src = tmp_path / "in"
    put(spark, src, FIRST)
    put(spark, src, [message("e", T0 + 600)])  # moves the watermark to T0+540 ...
    put(spark, src, [message("g", T0 + 610)])  # ... which drops rows one batch later
    put(spark, src, [message("f", T0 + 560), message("late", T0 + 50)])
    put(spark, src, [message("z", T0 + 2000)])  # closes the windows above
    rows = congestion(positions_of(parse_messages(stream_of(spark, src))))
    sinks.to_memory(rows, "cong").awaitTermination(120)
    on_time = [m for m in FIRST] + [
        message(*m) for m in (("e", T0 + 600), ("g", T0 + 610), ("f", T0 + 560))
    ]
    batch = congestion(positions_of(parse_messages(
        spark.createDataFrame(on_time, "key string, value string"))), Windows(exact=True))
    assert rows_of(spark.table("cong")) == rows_of(batch)


def test_complete_mode_is_sorted_and_keeps_open_windows(spark, tmp_path):
    src = tmp_path / "in"
    put(spark, src, FIRST)
    rows = congestion(positions_of(parse_messages(stream_of(spark, src)))).orderBy(F.col("aircraft_count").desc())
    sinks.to_memory(rows, "cong_all", mode="complete").awaitTermination(120)
    assert [r.aircraft_count for r in spark.table("cong_all").collect()] == [2, 1]


def test_parquet_sink_restarts_exactly_once(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(spark, src, FIRST)
    rows = lambda: congestion(positions_of(parse_messages(stream_of(spark, src))))
    sinks.to_parquet(rows(), out, cp, "p1", available_now=True).awaitTermination(120)
    put(spark, src, [message("z", T0 + 2000)])
    sinks.to_parquet(rows(), out, cp, "p2", available_now=True).awaitTermination(120)
    sinks.to_parquet(rows(), out, cp, "p3", available_now=True).awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.aircraft_count for r in got.collect()) == [1, 2]


def test_keyed_messages(spark):
    rows = positions_of(parse_messages(spark.createDataFrame(FIRST, "key string, value string")))
    sent = {r.key: json.loads(r.value) for r in as_messages(congestion(rows)).collect()}
    assert set(sent) == {"40.0:-100.5"}
    assert set(sent["40.0:-100.5"]) == {"window_start", "window_end", "cell_lat", "cell_lon",
                                        "aircraft_count", "on_ground_count", "avg_altitude_m"}


def test_latest_table(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "latest"), str(tmp_path / "cp")
    put(spark, src, [message("a", T0), message("b", T0)])
    put(spark, src, [message("a", T0 + 50), message("a", T0 + 20), ("x", "{broken")])
    put(spark, src, [message("a", T0 + 30)])
    rows = positions_of(parse_messages(stream_of(spark, src))).drop("message_key")
    order = ["event_ts"]
    latest.maintain_latest(rows, out, cp, "icao24", order, available_now=True).awaitTermination(120)
    now = latest.read_latest(spark, out, "icao24", order)
    assert {(r.icao24, r.event_ts) for r in now.collect()} == {("a", T0 + 50), ("b", T0)}
    want = rows_of(now)
    # A batch that is stored again changes nothing, before or after a compaction took it in.
    run = latest.run_id(spark, f"{cp}-run")
    stored = spark.read.parquet(f"{out}/data/{run}-{0:012d}")
    batch = spark.createDataFrame(stored.collect(), stored.schema)
    for _ in range(2):
        latest.store_batch(batch, 0, out, "icao24", order, run)
        now = latest.read_latest(spark, out, "icao24", order)
        assert rows_of(now) == want
        latest.compact(spark, out, "icao24", order)
        assert rows_of(latest.read_latest(spark, out, "icao24", order)) == want
    now = latest.read_latest(spark, out, "icao24", order)
    live = latest.served(now, F.lit(T0 + 320))
    assert [(r.icao24, r.source, r.expires_at) for r in live.collect()] == [("a", "live", T0 + 350)]
    cached = latest.served(now, F.lit(T0 + 320), cached=True)
    assert {(r.icao24, r.source) for r in cached.collect()} == {("a", "cached"), ("b", "cached")}


ORDER = ["event_ts"]


def latest_of(spark, out):
    return {(r.icao24, r.event_ts) for r in latest.read_latest(spark, out, "icao24", ORDER).collect()}


def follow(spark, src, out, cp):
    rows = positions_of(parse_messages(stream_of(spark, src))).drop("message_key")
    latest.maintain_latest(rows, out, str(cp), "icao24", ORDER, available_now=True).awaitTermination(120)


def test_a_fresh_checkpoint_keeps_what_an_old_one_stored(spark, tmp_path):
    out, first, second = str(tmp_path / "latest"), tmp_path / "one", tmp_path / "two"
    put(spark, first, [message("a", T0), message("b", T0 + 5)])
    follow(spark, first, out, tmp_path / "cp1")
    put(spark, second, [message("a", T0 + 9)])
    follow(spark, second, out, tmp_path / "cp2")  # its batch 0 is another than that of cp1
    assert latest_of(spark, out) == {("a", T0 + 9), ("b", T0 + 5)}


def test_a_batch_committed_during_a_compaction_stays(spark, tmp_path, monkeypatch):
    src, out, cp = tmp_path / "in", str(tmp_path / "latest"), tmp_path / "cp"
    put(spark, src, [message("a", T0), message("b", T0)])
    follow(spark, src, out, cp)
    keep = latest.commit

    def slow(rows, path, name, replaces=()):
        if name.startswith(latest.FOLD):
            put(spark, src, [message("a", T0 + 70)])
            follow(spark, src, out, cp)  # commits between the compaction's reading and its own commit
        keep(rows, path, name, replaces)

    monkeypatch.setattr(latest, "commit", slow)
    latest.compact(spark, out, "icao24", ORDER)
    monkeypatch.setattr(latest, "commit", keep)
    assert latest_of(spark, out) == {("a", T0 + 70), ("b", T0)}
    latest.compact(spark, out, "icao24", ORDER, keep=F.col("event_ts") > T0)
    assert latest_of(spark, out) == {("a", T0 + 70)}


def test_purge_removes_only_what_was_replaced(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "latest"), tmp_path / "cp"
    for n in range(3):
        put(spark, src, [message("a", T0 + n), message(f"k{n}", T0)])
        follow(spark, src, out, cp)
    want = latest_of(spark, out)
    latest.compact(spark, out, "icao24", ORDER)
    assert latest.purge(spark, out) == 3 and latest_of(spark, out) == want
    store = latest.Store(spark, out)
    assert len(store.names(latest.DATA)) == 1 and len(store.names(latest.MANIFEST)) == 2
    # The last batch, repeated after the purge, is known to be in.
    again = spark.createDataFrame([("a", T0 - 5)], "icao24 string, event_ts bigint")
    latest.store_batch(again, 2, out, "icao24", ORDER, latest.run_id(spark, f"{cp}-run"))
    assert latest_of(spark, out) == want
    latest.compact(spark, out, "icao24", ORDER)
    latest.purge(spark, out)
    put(spark, src, [message("a", T0 + 50)])
    follow(spark, src, out, cp)
    assert latest_of(spark, out) == {r for r in want if r[0] != "a"} | {("a", T0 + 50)}


def test_nothing_committed_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        latest.read_latest(spark, str(tmp_path / "none"), "icao24", ORDER)


def test_keys_leave_the_state_when_they_expire(spark, tmp_path):
    src = tmp_path / "in"
    put(spark, src, [message("a", T0), message("b", T0 + 200), message("a", T0 - 30)])
    put(spark, src, [message("b", T0 + 250, alt=7.0)])
    put(spark, src, [message("z", T0 + 480)])   # the watermark reaches T0 + 420: a expires
    put(spark, src, [message("z", T0 + 490)])
    put(spark, src, [message("a", T0 + 500)])   # and is new again
    rows = positions_of(parse_messages(stream_of(spark, src))).drop("message_key")
    timed = latest.latest_with_timeout(rows, "icao24", "event_ts", ttl=300)
    query = sinks.to_memory(timed, "timed", mode="update")
    query.awaitTermination(180)
    got = spark.table("timed").collect()
    told = lambda k: [(r.event_ts - T0, r.expired) for r in got if r.icao24 == k]
    assert told("a") == [(0, False), (0, True), (500, False)]
    assert told("b") == [(200, False), (250, False)] and told("z") == [(480, False), (490, False)]
    assert {r.altitude for r in got if r.icao24 == "b"} == {100.0, 7.0}


def test_the_congestion_job_resumes_without_loss_or_repeat(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def send(messages, checkpoint):
        return sinks.to_parquet(messages, f"{out}/sent", checkpoint, "sent", available_now=True)

    def go():
        for q in sinks.start_congestion(stream_of(spark, src), out, cp, send=send, available_now=True):
            assert q.awaitTermination(120)

    put(spark, src, FIRST)
    go()
    put(spark, src, [message("e", T0 + 240), ("y", "no json")])
    put(spark, src, [message("z", T0 + 2000)])
    go()
    go()  # nothing new
    put(spark, src, [message("z", T0 + 4000)])
    go()
    cells = spark.read.parquet(f"{out}/congestion").collect()
    begins = sorted(int(r.window_start.timestamp()) - T0 for r in cells)
    assert begins == [0, 120, 240, 1920] and sum(r.aircraft_count for r in cells) == 5
    assert sorted(r.message_key for r in spark.read.parquet(f"{out}/rejected").collect()) == ["n", "x", "y"]
    sent = spark.read.parquet(f"{out}/sent").collect()
    assert len(sent) == 4 and all(json.loads(r.value)["cell_lat"] == 40.0 for r in sent)


def test_latest_in_state(spark, tmp_path):
    src = tmp_path / "in"
    put(spark, src, [message("a", T0), message("b", T0)])
    put(spark, src, [message("a", T0 + 50)])
    rows = positions_of(parse_messages(stream_of(spark, src))).drop("message_key", "event_time")
    sinks.to_memory(latest.latest_state(rows, "icao24", ["event_ts"]), "st", mode="complete").awaitTermination(120)
    assert {(r.icao24, r.event_ts) for r in spark.table("st").collect()} == {("a", T0 + 50), ("b", T0)}


def test_state_on_disk_gives_the_same_windows(spark, tmp_path):
    src = tmp_path / "in"
    put(spark, src, FIRST)
    put(spark, src, [message("z", T0 + 2000)])
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    try:
        rows = congestion(positions_of(parse_messages(stream_of(spark, src))))
        sinks.to_memory(rows, "rocks").awaitTermination(120)
    finally:
        for key in STREAMING:
            spark.conf.unset(key)
    assert sorted(r.aircraft_count for r in spark.table("rocks").collect()) == [1, 2]
