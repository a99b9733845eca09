from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from punctua.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("session")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BRONZE = (
    "flight_date string, year int, month int, day_of_month int, day_of_week int, "
    "reporting_airline string, flight_number_reporting_airline bigint, origin string, "
    "dest string, distance double, crs_dep_time int, crs_arr_time int, crs_elapsed_time double, "
    "dep_del15 double, dep_delay_minutes double, cancelled double"
)


def flight(day, dep, label, origin="AAA", dest="BBB", carrier="ZZ", number=1, cancelled=0.0):
    y, m, d = (int(x) for x in day.split("-"))
    return (
        day, y, m, d, 3, carrier, number, origin, dest, 500.0, dep, dep + 100, 90.0,
        None if label is None else float(label), 20.0 if label else 0.0, cancelled,
    )


@pytest.fixture(scope="session")
def four_flights(spark):
    """Four flights out of AAA with known history and weather."""
    return spark.createDataFrame(
        [
            flight("2024-01-10", 800, 1),
            flight("2024-01-10", 1700, 1, dest="CCC"),
            flight("2024-01-11", 900, 0),
            flight("2024-01-12", 1430, 0),
        ],
        BRONZE,
    )


@pytest.fixture(scope="session")
def three_airports(spark):
    return spark.createDataFrame(
        [
            ("AAA", "Alpha", "A City", 40.0, -100.0, "-6"),
            ("BBB", "Beta", "B City", 41.0, -101.0, "-6"),
            ("CCC", "Gamma", "C City", 42.0, -102.0, "-7"),
            ("AAA", "Alpha again", "A City", 40.0, -100.0, "-6"),
            (None, "Nowhere", None, 0.0, 0.0, None),
        ],
        "iata string, name string, city string, lat double, lon double, tz string",
    )


@pytest.fixture(scope="session")
def one_reading(spark):
    return spark.createDataFrame(
        [("AAA", "2024-01-12T14:00", 5.5, 1.2, 22.0, 33.0, 0.4)],
        "iata string, time string, temperature_2m double, precipitation double, "
        "wind_speed_10m double, wind_gusts_10m double, snowfall double",
    )
