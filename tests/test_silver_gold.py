from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import BRONZE, flight
from punctua.contract import GOLD_COLUMNS, SILVER_FLIGHT_COLUMNS, WEATHER_FILL
from punctua.functions.timeparts import hour_key_utc
from punctua.operators.history import daily_totals, overall_rate, prior_rate, with_history
from punctua.plans.gold import assert_contract, gold_features
from punctua.plans.lake import Lake, build_gold, build_silver
from punctua.plans.silver import silver_airports, silver_flights, silver_weather, staged_flights
from punctua.sources.tables import read_table


@pytest.fixture(scope="module")
def silver(four_flights, three_airports):
    return silver_flights(four_flights, silver_airports(three_airports))


@pytest.fixture(scope="module")
def gold(silver, one_reading):
    rows = gold_features(silver, silver_weather(one_reading)).collect()
    return {(r.flight_date.isoformat(), r.dep_hour): r for r in rows}


def test_silver_columns_and_derivations(silver):
    assert tuple(silver.columns) == SILVER_FLIGHT_COLUMNS
    rows = {(r.flight_date.isoformat(), r.dep_hour): r for r in silver.collect()}
    assert {k: r.time_of_day_bucket for k, r in rows.items()} == {
        ("2024-01-10", 8): "morning",
        ("2024-01-10", 17): "afternoon",
        ("2024-01-11", 9): "morning",
        ("2024-01-12", 14): "afternoon",
    }
    assert all(r.is_holiday_window == 0 and r.carrier == "ZZ" for r in rows.values())
    assert all(r.diverted is None and r.nas_delay is None for r in rows.values())
    assert rows["2024-01-12", 14].flight_ts.isoformat() == "2024-01-12T14:00:00"


def test_airports_keep_one_row_per_code(three_airports):
    rows = {r.iata: r.name for r in silver_airports(three_airports).collect()}
    assert rows == {"AAA": "Alpha", "BBB": "Beta", "CCC": "Gamma"}


def test_silver_edge_rows(spark, three_airports):
    bronze = spark.createDataFrame(
        [
            flight("2024-01-13", 2400, 0),
            flight("2024-01-12", 100, None),
            flight("2024-01-12", 100, 1, dest="XXX"),
            flight("2024-01-12", 1200, 0, cancelled=1.0),
        ],
        BRONZE,
    )
    silver = silver_flights(bronze, three_airports)
    got = {(r.flight_date.isoformat(), r.dep_hour, r.is_holiday_window) for r in silver.collect()}
    assert got == {("2024-01-13", 0, 1), ("2024-01-12", 12, 0)}
    staged = staged_flights(silver)
    assert [r.dep_hour for r in staged.collect()] == [0]
    assert "flight_number" in staged.columns


def test_gold_contract_and_history(gold):
    assert set(GOLD_COLUMNS) == set(next(iter(gold.values())).asDict())
    assert gold["2024-01-10", 8].origin_hist_delay_rate == pytest.approx(0.5)
    assert gold["2024-01-10", 17].route_hist_delay_rate == pytest.approx(0.5)
    assert gold["2024-01-11", 9].origin_hist_delay_rate == pytest.approx(1.0)
    assert gold["2024-01-12", 14].origin_hist_delay_rate == pytest.approx(2 / 3)
    assert gold["2024-01-12", 14].carrier_hist_delay_rate == pytest.approx(2 / 3)


def test_gold_weather_match_and_fill(gold):
    probe = gold["2024-01-12", 14]
    assert (probe.origin_temp_2m, probe.origin_precip, probe.origin_wind_speed) == (5.5, 1.2, 22.0)
    assert (probe.origin_wind_gusts, probe.origin_snowfall) == (33.0, 0.4)
    assert probe.dest_precip == WEATHER_FILL["precip"]
    other = gold["2024-01-11", 9]
    assert [other[f"origin_{s}"] for s in WEATHER_FILL] == [15.0, 0.0, 10.0, 15.0, 0.0]


def test_contract_rejects_other_and_banned_columns(spark):
    df = spark.range(1).select(F.lit(1).alias("origin"), F.lit(1).alias("taxi_out"))
    with pytest.raises(AssertionError, match="missing"):
        assert_contract(df, ["origin", "dest"])
    with pytest.raises(AssertionError, match="after departure"):
        assert_contract(df, ["origin", "taxi_out"])


def test_future_days_do_not_change_earlier_rates(spark, silver):
    later = silver.withColumns(
        {"flight_date": F.date_add("flight_date", 30), "dep_del15": F.lit(1)}
    )
    def rates(df):
        daily = daily_totals(df, ["origin", "dest"])
        return {
            (r.origin, r.dest, r.day_num): r.p
            for r in prior_rate(daily, ["origin", "dest"], "p", F.lit(0.25)).collect()
        }
    before, after = rates(silver), rates(silver.unionByName(later))
    assert {k: after[k] for k in before} == before


def test_unknown_codes_get_the_overall_rate(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", "A", "B", None, 1), ("2024-01-02", "A", "B", None, 0),
         ("2024-01-02", "A", "B", "C", 0), ("2024-01-03", "A", "B", "C", 1)],
        "flight_date string, origin string, dest string, carrier string, dep_del15 int",
    ).withColumn("flight_date", F.to_date("flight_date"))
    got = with_history(rows).orderBy("flight_date", "carrier").collect()
    assert len(got) == 4
    assert [r.carrier_hist_delay_rate for r in got] == [0.5, 0.5, 0.5, 0.0]
    assert [r.origin_hist_delay_rate for r in got] == [0.5, 1.0, 1.0, pytest.approx(1 / 3)]


def test_overall_rate_of_nothing_is_zero(spark, silver):
    daily = daily_totals(silver.where("false"), ["origin"])
    assert spark.range(1).select(overall_rate(daily).alias("x")).first().x == 0.0


def test_hour_key_in_utc(spark):
    df = spark.createDataFrame(
        [("2024-01-10", 20, "America/Denver"), ("2024-07-10", 20, "America/Denver")],
        "d string, h int, z string",
    ).withColumn("d", F.to_date("d"))
    key = hour_key_utc(F.col("d"), F.col("h"), F.col("z"))
    assert [r.k for r in df.select(key.alias("k")).collect()] == [2024011103, 2024071102]


def test_lake_on_disk(spark, four_flights, three_airports, one_reading, tmp_path):
    lake = Lake(str(tmp_path))
    four_flights.write.partitionBy("year", "month").parquet(lake.path("bronze", "bts_ontime"))
    three_airports.write.parquet(lake.path("bronze", "airports"))
    one_reading.write.partitionBy("iata").parquet(lake.path("bronze", "weather_hourly"))
    build_silver(spark, lake)
    build_gold(spark, lake)
    build_gold(spark, lake)
    table = read_table(spark, lake.path("gold", "fct_flight_features"))
    assert table.count() == 4
    assert (tmp_path / "gold" / "fct_flight_features" / "year=2024").is_dir()
    pruned = table.where("year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned
