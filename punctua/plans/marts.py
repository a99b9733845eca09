"""Reliability marts over the staged (operated) flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.contract import LABEL
from punctua.operators.ranking import rank_within, top_rows
from punctua.session import stored
from punctua.sources.tables import save_table

DIM_AIRPORT_COLUMNS = ("iata", "name", "city", "lat", "lon")


# The finest grain any mart needs.
GRAIN = ("origin", "dest", "carrier", "dep_hour", "day_of_week")
COUNTS = ("flights", "labelled", "late", "timed", "minutes")


def counted(staged: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Every flight as a row of counts, so that marts only ever add up."""
    minutes = F.col("dep_delay_minutes")
    return staged.select(
        *keys,
        F.lit(1).cast("bigint").alias("flights"),
        F.col(LABEL).isNotNull().cast("bigint").alias("labelled"),
        F.coalesce(F.col(LABEL).cast("bigint"), F.lit(0)).alias("late"),
        minutes.isNotNull().cast("bigint").alias("timed"),
        F.coalesce(minutes, F.lit(0.0)).alias("minutes"),
    )


def mart_totals(staged: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Counts per combination of the mart keys: what all marts together need to know.

    One pass over the flights.  Its size depends on routes, carriers and hours, not on
    the number of flights, and every mart can be added up from it.
    """
    sums = [F.sum(c).alias(c) for c in COUNTS]
    return counted(staged, keys).groupBy(*keys).agg(*sums)


def _rows(flights: DataFrame) -> DataFrame:
    """Marts accept staged flights as well as totals of them."""
    return flights if "labelled" in flights.columns else counted(flights)


def _mean(total: str, n: str) -> Column:
    return F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0))


def _by(flights: DataFrame, *keys, rate: str = "delay_rate") -> DataFrame:
    return (
        _rows(flights)
        .groupBy(*keys)
        .agg(F.sum("flights").alias("flights"), _mean("late", "labelled").alias(rate))
    )


def dim_airports(airports: DataFrame) -> DataFrame:
    return airports.where(F.col("iata").isNotNull()).select(*DIM_AIRPORT_COLUMNS)


def route_reliability(staged: DataFrame) -> DataFrame:
    return (
        _rows(staged)
        .groupBy("origin", "dest")
        .agg(
            F.sum("flights").alias("flights"),
            _mean("late", "labelled").alias("delay_rate"),
            _mean("minutes", "timed").alias("avg_delay_min"),
        )
    )


def route_carrier_reliability(staged: DataFrame) -> DataFrame:
    return _by(staged, "origin", "dest", "carrier")


def airport_reliability(staged: DataFrame) -> DataFrame:
    return _by(staged, "origin", rate="overall_delay_rate")


def airport_hourly(staged: DataFrame) -> DataFrame:
    return _by(staged, "origin", F.col("dep_hour").alias("hour"))


def carrier_reliability(staged: DataFrame) -> DataFrame:
    return _by(staged, "carrier")


def hourly_patterns(staged: DataFrame) -> DataFrame:
    return _by(staged, "dep_hour", "day_of_week")


def hourly_rollup(patterns: DataFrame) -> DataFrame:
    """Hour-only rates from the hour-by-weekday mart, weighted by flights."""
    return patterns.groupBy("dep_hour").agg(
        F.sum("flights").alias("flights"),
        (F.sum(F.col("delay_rate") * F.col("flights")) / F.sum("flights")).alias("delay_rate"),
    )


def airport_worst_routes(staged: DataFrame, n: int | None = None) -> DataFrame:
    """Destinations of each origin ranked worst first; equal rates by flights, then code."""
    ranked = rank_within(
        _by(staged, "origin", "dest"),
        ["origin"],
        [F.col("delay_rate").desc(), F.col("flights").desc(), F.col("dest")],
    )
    return ranked if n is None else ranked.where(F.col("rnk") <= n)


def top_delayed_routes(routes: DataFrame, min_flights: int = 50, n: int = 10) -> DataFrame:
    busy = routes.where(F.col("flights") >= min_flights)
    return top_rows(busy, [F.col("delay_rate").desc(), F.col("origin"), F.col("dest")], n)


# table name -> (builder, comment)
MARTS = {
    "agg_route_reliability": (route_reliability, "Delay rate and mean delay per route"),
    "agg_route_carrier_reliability": (
        route_carrier_reliability,
        "Delay rate per route and carrier",
    ),
    "agg_airport_reliability": (airport_reliability, "Delay rate per origin airport"),
    "agg_airport_hourly": (airport_hourly, "Delay rate per origin airport and hour"),
    "agg_airport_worst_routes": (airport_worst_routes, "Routes per origin, worst first"),
    "agg_carrier_reliability": (carrier_reliability, "Delay rate per carrier"),
    "agg_hourly_patterns": (hourly_patterns, "Delay rate per departure hour and weekday"),
}


def build_marts(
    spark: SparkSession, staged: DataFrame, airports: DataFrame, schema: str, fmt: str = "parquet"
) -> list[str]:
    """Materialise every mart as a commented table, from one pass over the flights."""
    staged.createOrReplaceTempView("stg_flights")
    totals = stored(mart_totals(spark.table("stg_flights")))
    save_table(dim_airports(airports), f"{schema}.dim_airports", fmt, comment="Airport dimension")
    for name, (build, comment) in MARTS.items():
        save_table(build(totals), f"{schema}.{name}", fmt, comment=comment)
    return [f"{schema}.{name}" for name in ("dim_airports", *MARTS)]
