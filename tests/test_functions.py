from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from punctua.functions import geo, scores, text
from punctua.functions.holidays import federal_holidays, holiday_flag, holiday_window_dates
from punctua.functions.timeparts import clock_hour, day_part, iso_weekday


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r.y for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_clock_hour_clamps(spark):
    got = column(spark, [0, 5, 800, 1705, 2359, 2400, 2500, -10, None], "int", clock_hour)
    assert got == [0, 0, 8, 17, 23, 0, 0, 0, None]


def test_day_part_borders(spark):
    got = column(spark, [0, 5, 6, 11, 12, 17, 18, 23], "int", day_part)
    assert got == ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2


def test_iso_weekday(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS x")
    assert [r.y for r in df.select(iso_weekday(F.col("x")).alias("y")).collect()] == list(range(1, 8))


def test_holidays_by_rule():
    assert federal_holidays(2015, 2015) == [
        date(2015, m, d)
        for m, d in ((1, 1), (1, 19), (2, 16), (5, 25), (7, 3), (9, 7), (10, 12), (11, 11),
                     (11, 26), (12, 25))
    ]
    days = set(federal_holidays(2021, 2022))
    assert {date(2021, 6, 18), date(2021, 12, 24), date(2021, 12, 31), date(2022, 1, 1),
            date(2022, 6, 20), date(2022, 12, 26)} <= days
    assert date(2020, 6, 19) not in federal_holidays(2020, 2020)
    assert date(2025, 12, 27) == max(holiday_window_dates())


def test_holiday_flag(spark):
    df = spark.createDataFrame([("2024-01-12",), ("2024-01-13",), ("2024-01-17",), ("2024-01-18",),
                                ("2022-01-03",)], "s string").select(F.to_date("s").alias("d"))
    assert [r.f for r in df.select(holiday_flag("d").alias("f")).collect()] == [0, 1, 1, 0, 1]


def test_cells_and_box(spark):
    df = spark.createDataFrame(
        [(41.97, -87.9), (24.0, -125.0), (50.0, -66.0), (51.0, -100.0), (40.0, -130.0)],
        "lat double, lon double",
    )
    rows = df.select(
        geo.cell(F.col("lat"), 0.5).alias("a"),
        geo.cell(F.col("lon"), 0.5).alias("b"),
        geo.in_box(F.col("lat"), F.col("lon")).alias("inside"),
    ).collect()
    assert (rows[0].a, rows[0].b) == (41.5, -88.0)
    assert [r.inside for r in rows] == [True, True, True, False, False]


def test_haversine(spark):
    df = spark.createDataFrame([(33.64, -84.43, 40.64, -73.78)], "a double, b double, c double, d double")
    got = df.select(geo.haversine_miles(*[F.col(c) for c in "abcd"]).alias("m")).first().m
    p1, p2 = math.radians(33.64), math.radians(40.64)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        math.radians(-73.78 + 84.43) / 2) ** 2
    assert got == pytest.approx(2 * 3958.8 * math.asin(math.sqrt(a)), rel=1e-12)


def test_risk_bands(spark):
    got = column(spark, [0.1999, 0.2, 0.4499, 0.45, None], "double", scores.risk_band)
    assert got == ["low", "moderate", "moderate", "high", None]


def test_bin_edges_are_float_edges(spark):
    got = column(spark, [0.0, 0.1, 0.3, 0.30000000000000004, 1.0, -0.2, 1.7], "double",
                 lambda c: scores.bin_index(c, 10))
    assert got == [0, 1, 2, 3, 9, 0, 9]


def test_top_factors(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x")], "a double, b double, c string")
    entries = [("a", F.col("a"), F.lit(0.1)), ("b", F.col("b"), F.lit(-0.5)),
               ("c", F.col("c"), F.lit(0.1))]
    got = df.select(scores.top_factors(entries, 2).alias("f")).first().f
    assert [(x.feature, x.value, x.contribution, x.direction) for x in got] == [
        ("b", "2.0", -0.5, "decreases"), ("a", "1.0", 0.1, "increases")]


def test_only_picked_factors_are_written_out(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    entries = [("a", F.col("a"), F.col("a")), ("b", F.raise_error(F.lit("written out")), F.col("a") / 2),
               ("c", F.col("a"), F.col("a") * -3)]
    got = df.select(scores.top_factors(entries, 2).alias("f")).first().f
    assert [(x.feature, x.contribution, x.direction) for x in got] == [("c", -3.0, "decreases"), ("a", 1.0, "increases")]


@pytest.mark.parametrize("raw,snake", [
    ("DepDel15", "dep_del15"), ("Reporting_Airline", "reporting_airline"),
    ("CRSElapsedTime", "crs_elapsed_time"), ("NASDelay", "nas_delay"),
    ("Flight_Number_Reporting_Airline", "flight_number_reporting_airline"),
    ("DivAirportLandings", "div_airport_landings"), ("already_snake_2m", "already_snake_2m"),
])
def test_snake_name(raw, snake):
    assert text.snake_name(raw) == snake


def test_keys_and_callsigns(spark):
    assert column(spark, ["UAL1091 ", "   ", None], "string", text.clean_callsign) == ["UAL1091", None, None]
    df = spark.createDataFrame([("ATL", "JFK", 41.5, -88.0)], "o string, d string, a double, b double")
    row = df.select(text.route_key(F.col("o"), F.col("d")).alias("r"),
                    text.cell_key(F.col("a"), F.col("b")).alias("c")).first()
    assert (row.r, row.c) == ("ATL|JFK", "41.5:-88.0")
