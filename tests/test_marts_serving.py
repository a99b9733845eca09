from __future__ import annotations

import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import BRONZE, flight
from punctua.operators import quality
from punctua.operators.history import fit_base_rates, mean_label
from punctua.operators.joins import nearby_counts
from punctua.operators.medians import exact_medians
from punctua.plans import marts, serving
from punctua.plans.silver import silver_airports, silver_flights, silver_weather, staged_flights


@pytest.fixture(scope="module")
def seed():
    rng = random.Random(96)
    out = []
    for i in range(96):
        o, d = rng.sample(["AAA", "BBB", "CCC"], 2)
        out.append(flight(f"2024-03-{1 + i % 8:02d}", rng.randrange(24) * 100, int(rng.random() < 0.3), o, d,
                          rng.choice(["AA", "DL", "WN"]), i, 1.0 if i % 48 == 7 else 0.0))
    return out


@pytest.fixture(scope="module")
def staged(spark, seed, three_airports):
    return staged_flights(silver_flights(spark.createDataFrame(seed, BRONZE), three_airports)).cache()


def test_marts_equal_brute_force(staged, seed):
    groups = defaultdict(list)
    for f in seed:
        if f[15] == 0.0:
            groups[f[7], f[8]].append(f)
    got = {(r.origin, r.dest): r for r in marts.route_reliability(staged).collect()}
    assert set(got) == set(groups) and sum(r.flights for r in got.values()) == 94
    for key, rows in groups.items():
        assert got[key].flights == len(rows)
        assert got[key].delay_rate == pytest.approx(sum(r[13] for r in rows) / len(rows))
        assert got[key].avg_delay_min == pytest.approx(sum(r[14] for r in rows) / len(rows))


def test_worst_routes_rank(staged):
    by_origin = defaultdict(list)
    for r in marts.airport_worst_routes(staged).collect():
        by_origin[r.origin].append(r)
    for rows in by_origin.values():
        want = sorted(rows, key=lambda r: (-r.delay_rate, -r.flights, r.dest))
        assert [r.rnk for r in want] == list(range(1, len(rows) + 1))
    assert marts.airport_worst_routes(staged, 1).count() == len(by_origin)


def test_hour_rollup_is_weighted(staged):
    rolled = {r.dep_hour: r for r in marts.hourly_rollup(marts.hourly_patterns(staged)).collect()}
    direct = {r.dep_hour: r for r in staged.groupBy("dep_hour").agg(
        F.count("*").alias("n"), F.avg("dep_del15").alias("rate")).collect()}
    assert {h: (r.flights, round(r.delay_rate, 9)) for h, r in rolled.items()} == {
        h: (r.n, round(r.rate, 9)) for h, r in direct.items()}


def test_data_tests_pass_on_marts(staged, three_airports):
    dim = marts.dim_airports(silver_airports(three_airports))
    suites = [
        (staged, quality.Suite("stg_flights", not_null=["flight_date", "dep_hour", "carrier", "origin", "dest", "dep_del15"],
                               accepted_values={"dep_del15": [0, 1]}, accepted_range={"dep_hour": (0, 23)})),
        (dim, quality.Suite("dim_airports", not_null=["iata", "name", "lat", "lon"], unique=["iata"])),
        (marts.route_reliability(staged), quality.Suite(
            "routes", not_null=["flights", "delay_rate", "avg_delay_min"], unique_combinations=[["origin", "dest"]],
            accepted_range={"delay_rate": (0, 1)}, relationships={"origin": (dim, "iata"), "dest": (dim, "iata")})),
        (marts.airport_hourly(staged), quality.Suite(
            "hours", unique_combinations=[["origin", "hour"]], accepted_range={"hour": (0, 23), "delay_rate": (0, 1)})),
        (marts.hourly_patterns(staged), quality.Suite(
            "patterns", unique_combinations=[["dep_hour", "day_of_week"]], accepted_range={"day_of_week": (1, 7)})),
        (marts.carrier_reliability(staged), quality.Suite("carriers", unique=["carrier"], not_null=["flights"])),
    ]
    for df, suite in suites:
        assert quality.run_suite(df, suite).where("violations > 0").collect() == []


def test_marts_as_tables(spark, staged, three_airports):
    spark.sql("CREATE SCHEMA IF NOT EXISTS gold")
    dim = silver_airports(three_airports)
    names = marts.build_marts(spark, staged, dim, "gold")
    again = marts.build_marts(spark, staged, dim, "gold")
    assert names == again and len(names) == 8
    assert spark.table("gold.agg_carrier_reliability").count() == 3
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED gold.agg_route_reliability").collect()}
    assert info["Comment"] == "Delay rate and mean delay per route"


def test_options_presets_and_documents(spark, staged, three_airports):
    routes, by_carrier = marts.route_reliability(staged), marts.route_carrier_reliability(staged)
    names = serving.carrier_names(spark).where("code != 'AA' AND code != 'WN'")
    options = {r.code: r.name for r in serving.carrier_options(marts.carrier_reliability(staged), names).collect()}
    assert options == {"AA": "AA", "DL": "Delta Air Lines", "WN": "WN"}
    presets = serving.example_presets(routes, by_carrier, 2).collect()
    busiest = sorted(routes.collect(), key=lambda r: (-r.flights, r.origin, r.dest))[:2]
    assert {(p.origin, p.dest) for p in presets} == {(r.origin, r.dest) for r in busiest}
    lone = serving.example_presets(routes, by_carrier.where("false"), 1).first()
    assert (lone.carrier, lone.day_of_week, lone.dep_hour) == ("DL", 5, 17)
    doc = serving.lookup(serving.route_documents(routes, by_carrier), origin="aaa", dest="bbb").first()
    want = sorted(by_carrier.where("origin = 'AAA' AND dest = 'BBB'").collect(), key=lambda r: (-r.flights, r.carrier))
    assert [c.carrier for c in doc.by_carrier] == [r.carrier for r in want]
    assert serving.airport_options(marts.dim_airports(silver_airports(three_airports))).first().iata == "AAA"


def test_airport_documents(spark, staged, three_airports):
    dim = marts.dim_airports(silver_airports(three_airports)).unionByName(
        spark.createDataFrame([("NEW", "New", "N", 30.0, -90.0)], "iata string, name string, city string, lat double, lon double"))
    points = spark.createDataFrame([(40.0, -100.0)] * 10 + [(30.0, -90.0)], "lat double, lon double")
    docs = {r.iata: r for r in serving.airport_documents(
        dim, marts.airport_reliability(staged), marts.airport_hourly(staged),
        marts.airport_worst_routes(staged), nearby_counts(dim, points)).collect()}
    assert docs["AAA"].live_congestion.asDict() == {"aircraft_nearby": 10, "level": "moderate"}
    hours = [h.hour for h in docs["AAA"].historical.by_hour]
    assert hours == sorted(hours) and hours
    rates = [w.delay_rate for w in docs["AAA"].historical.worst_routes]
    assert rates == sorted(rates, reverse=True)
    assert docs["NEW"].historical.overall_delay_rate is None and docs["NEW"].historical.by_hour == []


def test_request_features_fallbacks(spark, staged, three_airports, one_reading):
    dim = silver_airports(three_airports)
    requests = spark.createDataFrame(
        [(1, "aaa", "bbb", "dl", "2024-01-12", 14), (2, "AAA", "CCC", "QQ", "2024-01-13", 3),
         (3, "XXX", "YYY", "AA", "2024-01-14", 23)],
        "request_id int, origin string, dest string, carrier string, flight_date string, dep_hour int",
    ).withColumn("flight_date", F.to_date("flight_date"))
    history = staged.where("NOT (origin = 'AAA' AND dest = 'CCC')")
    rows = {r.request_id: r for r in serving.request_features(
        requests, dim, exact_medians(history, ["origin", "dest"], ["distance", "crs_elapsed_time"]),
        marts.route_reliability(history), marts.airport_reliability(history), marts.carrier_reliability(history),
        fit_base_rates(history, min_count=1000), mean_label(history), silver_weather(one_reading)).collect()}
    prior = history.agg(F.avg("dep_del15")).first()[0]
    assert (rows[1].distance, rows[1].crs_elapsed_time, rows[1].is_holiday_window) == (500.0, 90.0, 0.0)
    assert (rows[1].origin_temp_2m, rows[1].dest_wind_speed, rows[1].day_of_week) == (5.5, 8.0, 5)
    assert rows[2].distance == 173.0 and rows[2].crs_elapsed_time == round(173 / 7 + 40)
    assert rows[2].route_hist_delay_rate == pytest.approx(prior) and rows[2].is_holiday_window == 1.0
    assert rows[2].carrier_hist_delay_rate == pytest.approx(prior)
    assert rows[3].distance == 800.0 and rows[3].time_of_day_bucket == "evening"
    summary = serving.weather_summary(spark.createDataFrame(
        [(1.26, 0.126, 3.3, 2.0, 0.0, 1.0)],
        "origin_temp_2m double, origin_precip double, origin_wind_gusts double, "
        "dest_temp_2m double, dest_precip double, dest_wind_gusts double")).first().weather_summary
    assert (summary.origin.temp_c, summary.origin.precip_mm) == (1.3, 0.13)


def test_choose_snapshot(spark):
    df = spark.createDataFrame(
        [("a", 1, 1000, 1), ("a", 2, 900, 5), ("b", 1, 1000, 0), ("b", 2, 100, 3), ("c", 3, 0, 9), ("c", 1, 999, 0),
         ("d", 1, None, 2), ("e", 1, 0, 2)],
        "feed string, tier int, as_of bigint, count bigint")
    got = {r.feed: (r.source, r.stale_seconds, r["count"]) for r in serving.choose_snapshot(df, F.lit(1100)).collect()}
    assert got == {"a": ("live", 100, 1), "b": ("cached", 1000, 3), "c": ("sample", 0, 9), "d": ("live", 0, 2), "e": ("cached", 0, 2)}


def test_forecast_of_many_requests_and_hours(spark):
    """A request meets its own hour only: neither the hours of a document nor their order matter."""
    first = datetime(2024, 1, 1)
    stamps = [f"{first + timedelta(hours=k):%Y-%m-%dT%H:%M}" for k in range(20_000)]
    times = stamps + stamps[216:240] + [None]  # a day listed again: its first place holds
    series = [float(k) for k in range(len(times) - 1000)]  # too short for the last of them
    docs = [("AAA", (times, series)), ("BBB", (times[::-1], series)), ("CCC", None), ("CCC", (times[:300], series))]
    forecasts = spark.createDataFrame(docs, "iata string, forecast struct<time:array<string>,temperature_2m:array<double>>")
    empty = ("precipitation", "wind_speed_10m", "wind_gusts_10m", "snowfall")
    forecasts = forecasts.withColumn("forecast", F.when(F.col("forecast").isNotNull(), F.struct(
        "forecast.*", *[F.array().cast("array<double>").alias(v) for v in empty])))
    ends = F.array(*[F.lit(x) for x in ("AAA", "BBB", "CCC", "nowhere")])
    rows = spark.range(20_000).select(
        F.col("id").alias("request_id"), F.expr("date_add(DATE'2024-01-08', CAST(id % 24 AS INT))").alias("flight_date"),
        F.get(ends, (F.col("id") % 4).cast("int")).alias("origin"), F.lit("AAA").alias("dest"),
        F.when(F.col("id") % 7 != 3, (F.col("id") % 23).cast("int")).alias("dep_hour"))
    began = time.perf_counter()
    found = serving.forecast_features(rows, forecasts, F.to_date(F.lit("2024-01-10")))
    got = found.select("request_id", "origin_temp_2m", "dest_temp_2m", "weather_ok").collect()
    assert time.perf_counter() - began < 40
    place = [{}, {}, {}]
    for known, listed in zip(place, (times, times[::-1], times[:300])):
        for k, stamp in enumerate(listed):
            known.setdefault(stamp, series[k] if k < len(series) else None)
    want, fill = [], serving.REQUEST_WEATHER_FILL["temp_2m"]
    for n in range(20_000):
        day, hour = datetime(2024, 1, 8) + timedelta(days=n % 24), None if n % 7 == 3 else n % 23
        stamp = f"{day:%Y-%m-%d}T{hour:02d}:00" if hour is not None and 0 <= (day - datetime(2024, 1, 10)).days <= 16 else None
        here = {0: [place[0]], 1: [place[1]], 2: [{}, place[2]], 3: [{}]}[n % 4]
        for own in here:
            a, b = own.get(stamp) if stamp else None, place[0].get(stamp) if stamp else None
            want.append((n, fill if a is None else a, fill if b is None else b, a is not None or b is not None))
    assert sorted(tuple(r) for r in got) == sorted(want)
