"""The batch job: bronze tables on disk to silver, gold and marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from punctua.plans.gold import gold_features
from punctua.plans.marts import build_marts
from punctua.plans.silver import silver_airports, silver_flights, silver_weather, staged_flights
from punctua.sources.tables import read_table, write_table


@dataclass(frozen=True)
class Lake:
    """Folder layout below one root."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def build_silver(spark: SparkSession, lake: Lake) -> None:
    """Write the silver tables; flights are checked against the written airports."""
    def bronze(table: str):
        return read_table(spark, lake.path("bronze", table))

    write_table(silver_airports(bronze("airports")), lake.path("silver", "airports"), lake.fmt)
    write_table(silver_weather(bronze("weather_hourly")), lake.path("silver", "weather"), lake.fmt)
    airports = read_table(spark, lake.path("silver", "airports"), lake.fmt)
    write_table(
        silver_flights(bronze("bts_ontime"), airports),
        lake.path("silver", "flights"),
        lake.fmt,
        partition_by=["year"],
    )


def build_gold(spark: SparkSession, lake: Lake) -> None:
    flights = read_table(spark, lake.path("silver", "flights"), lake.fmt)
    weather = read_table(spark, lake.path("silver", "weather"), lake.fmt)
    write_table(
        gold_features(flights, weather),
        lake.path("gold", "fct_flight_features"),
        lake.fmt,
        partition_by=["year"],
    )


def build_reports(spark: SparkSession, lake: Lake, schema: str) -> list[str]:
    """The reliability marts as tables of ``schema``."""
    flights = read_table(spark, lake.path("silver", "flights"), lake.fmt)
    airports = read_table(spark, lake.path("silver", "airports"), lake.fmt)
    return build_marts(spark, staged_flights(flights), airports, schema, lake.fmt)
