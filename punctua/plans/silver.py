"""Bronze to silver: typed, filtered and enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctua.contract import (
    AFTER_THE_FACT,
    HOLIDAY_YEARS,
    LABEL,
    SILVER_FLIGHT_COLUMNS,
    STAGED_TYPES,
    WEATHER_VARS,
)
from punctua.functions.holidays import holiday_flag
from punctua.functions.timeparts import clock_hour, day_part, hour_key_of, hour_ts
from punctua.operators.joins import keep_known
from punctua.operators.keyed import first_by_key
from punctua.sources.tables import fill_missing

AIRPORT_TYPES = {
    "iata": "string",
    "name": "string",
    "city": "string",
    "lat": "double",
    "lon": "double",
    "tz": "string",
}


def silver_airports(bronze: DataFrame) -> DataFrame:
    """One row per airport code; of several the one that sorts first is kept."""
    typed = fill_missing(bronze, AIRPORT_TYPES).select(*AIRPORT_TYPES)
    return first_by_key(typed.where(F.col("iata").isNotNull()), ["iata"], ["name", "city"])


def silver_weather(bronze: DataFrame, order: tuple[str, ...] = ("weather_ts",)) -> DataFrame:
    """One row per airport and hour, with the hour key used in joins.

    ``order`` decides between several rows of one hour (the earliest by default) and
    may name extra columns of ``bronze``.
    """
    kind = dict(bronze.dtypes)["time"]
    ts = (
        F.col("time").cast("timestamp")
        if kind.startswith("timestamp")
        else F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm"))
    )
    extra = [c for c in order if c != "weather_ts"]
    rows = bronze.select(
        F.col("iata").cast("string").alias("iata"),
        ts.alias("weather_ts"),
        *[F.col(v).cast("double").alias(v) for v in WEATHER_VARS],
        *extra,
    ).where(F.col("iata").isNotNull() & F.col("weather_ts").isNotNull())
    keyed = rows.withColumn("weather_hour_key", hour_key_of(F.col("weather_ts")))
    return first_by_key(keyed, ["iata", "weather_hour_key"], order).select(
        "iata", "weather_ts", *WEATHER_VARS, "weather_hour_key"
    )


def silver_flights(
    bronze: DataFrame, airports: DataFrame, holiday_years: tuple[int, int] = HOLIDAY_YEARS
) -> DataFrame:
    """Scheduled, labelled flights between known airports, with derived columns.

    Cancelled flights stay; only the reporting views leave them out.
    """
    scheduled = bronze.where(
        F.col("crs_dep_time").isNotNull()
        & F.col(LABEL).isNotNull()
        & F.col("origin").isNotNull()
        & F.col("dest").isNotNull()
    )
    known = keep_known(scheduled, airports, ["origin", "dest"], "iata")
    typed = fill_missing(known, {c: "double" for c in AFTER_THE_FACT}).withColumns(
        {
            "carrier": F.col("reporting_airline").cast("string"),
            "flight_number_reporting_airline": F.col("flight_number_reporting_airline").cast(
                "string"
            ),
            "flight_date": F.to_date("flight_date"),
            "dep_hour": clock_hour(F.col("crs_dep_time")),
            **{c: F.col(c).cast("string") for c in ("origin", "dest")},
            **{
                c: F.col(c).cast("int")
                for c in ("year", "month", "day_of_week", "crs_dep_time", "crs_arr_time", LABEL)
            },
            **{c: F.col(c).cast("double") for c in ("distance", "crs_elapsed_time")},
        }
    )
    return typed.withColumns(
        {
            "flight_ts": hour_ts(F.col("flight_date"), F.col("dep_hour")),
            "time_of_day_bucket": day_part(F.col("dep_hour")),
            "is_holiday_window": holiday_flag("flight_date", *holiday_years),
        }
    ).select(*SILVER_FLIGHT_COLUMNS)


def staged_flights(silver: DataFrame, *columns: str) -> DataFrame:
    """Typed reporting view: operated flights only, so that a cancellation never
    counts as an on-time departure.  All its columns, or those named."""
    source = {"flight_number": "flight_number_reporting_airline"}
    return silver.where(F.coalesce(F.col("cancelled").cast("int"), F.lit(0)) == 0).select(
        *[F.col(source.get(c, c)).cast(STAGED_TYPES[c]).alias(c) for c in columns or STAGED_TYPES]
    )


def staged_airports(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("iata").isNotNull()).select(
        *[F.col(c).cast(t).alias(c) for c, t in AIRPORT_TYPES.items()]
    )
