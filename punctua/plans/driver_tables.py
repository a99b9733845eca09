"""Flights, airports, weather and positions seen in the generic test tables.

The test tables are a trade schema plus an event log.  Line items play flights,
nations play airports, events play weather readings and aircraft positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctua.contract import LABEL
from punctua.functions.timeparts import hour_key, iso_weekday
from punctua.session import stored
from punctua.plans.silver import silver_airports, silver_flights, silver_weather, staged_flights

HOLIDAYS = (1994, 2002)
TRAIN = (1995, 1996, 1997, 1998, 1999)
TEST = (2000, 2001)
FIRST_DAY = "1995-01-01"
# The day on which the forecasts of the tests are made.
FORECAST_DAY = "2024-01-10"
WEATHER_START = "2024-01-01"
WEATHER_DAYS = 30


# Column types of the tables in use: reading with a schema skips a job per table.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item; supplier and customer nations are its ends.

    ``cancelled``, the ends and the carrier come from joins on keys; the columns
    that line items cannot provide are left out and become null in silver.
    """
    nation = table(spark, sf_dir, "nation")
    start = nation.select(F.col("n_nationkey").alias("_sk"), F.col("n_name").alias("origin"))
    end = nation.select(F.col("n_nationkey").alias("_ek"), F.col("n_name").alias("dest"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Plain tables on the right, one after the other: the planner knows their sizes,
    # which it would have to guess for a join of two of them.
    orders = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(end, F.col("c_nationkey") == F.col("_ek"))
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "dest")
    )
    line = (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(start, F.col("s_nationkey") == F.col("_sk"))
    )
    day = F.to_date("l_shipdate")
    late = F.col("l_returnflag") == "R"
    slot = F.pmod(F.col("l_partkey") * 7 + F.col("l_linenumber"), F.lit(25))
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            day.alias("flight_date"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day_of_month"),
            iso_weekday(day).alias("day_of_week"),
            F.col("o_orderpriority").alias("reporting_airline"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "flight_number_reporting_airline"
            ),
            "origin",
            "dest",
            F.col("l_extendedprice").alias("distance"),
            (slot * 100 + F.col("l_suppkey") % 60).cast("int").alias("crs_dep_time"),
            (F.col("l_partkey") % 2400).cast("int").alias("crs_arr_time"),
            (F.col("l_quantity") * 5).alias("crs_elapsed_time"),
            late.cast("int").alias(LABEL),
            F.when(late, F.col("l_quantity")).otherwise(0.0).alias("dep_delay_minutes"),
            (F.col("o_orderstatus") == "P").cast("double").alias("cancelled"),
        )
    )


def bronze_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("iata"),
            F.concat(F.lit("Airport "), F.col("n_name")).alias("name"),
            F.col("r_name").alias("city"),
            (F.lit(24.0) + F.col("n_nationkey")).alias("lat"),
            (F.lit(-125.0) + F.col("n_nationkey") * F.lit(2.3)).alias("lon"),
            F.lit(None).cast("string").alias("tz"),
        )
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several readings per airport and hour; the lowest event id comes first."""
    k = F.get_json_object("props", "$.k").cast("double")
    events = table(spark, sf_dir, "events").withColumn("_n", F.col("user_id") % 25)
    nation = table(spark, sf_dir, "nation")
    return events.join(nation, F.col("_n") == F.col("n_nationkey")).select(
        F.col("n_name").alias("iata"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time"),
        F.col("value").alias("temperature_2m"),
        (k / 10).alias("precipitation"),
        (F.col("value") / 2).alias("wind_speed_10m"),
        (k + 1).alias("wind_gusts_10m"),
        F.when(k < 10, k).alias("snowfall"),
        "event_id",
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_airports(bronze_airports(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_weather(bronze_weather(spark, sf_dir), order=("event_id",))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver flights.  A semi join needs no unique airports, so bronze ones will do."""
    return silver_flights(bronze_flights(spark, sf_dir), bronze_airports(spark, sf_dir), HOLIDAYS)


def stored_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Silver flights as a written table, for plans that read them several times.

    That is how silver exists in a lake; here it saves repeating the joins above.
    """
    rows = flights(spark, sf_dir)
    return stored(rows.select(*columns) if columns else rows)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_flights(flights(spark, sf_dir))


def folded_day(day: str = "flight_date"):
    """Flights span years and readings one month: days are folded onto that month."""
    return F.date_add(
        F.to_date(F.lit(WEATHER_START)),
        F.pmod(F.datediff(F.col(day), F.to_date(F.lit(FIRST_DAY))), F.lit(WEATHER_DAYS)),
    )


def weather_hour(day: str = "flight_date", hour: str = "dep_hour"):
    return hour_key(folded_day(day), F.col(hour))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position report per event.  Whole metres, so that means do not depend on
    the order in which engines add them up."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("icao24"),
        F.concat(F.lit(" FL"), F.col("user_id"), F.lit(" ")).alias("callsign"),
        (F.lit(20.0) + F.pmod(e * 37, F.lit(3500)) / F.lit(100)).alias("lat"),
        (F.lit(-130.0) + F.pmod(e * 53, F.lit(7000)) / F.lit(100)).alias("lon"),
        F.round(F.col("value") * 20, 0).alias("altitude"),
        F.col("value").alias("velocity"),
        F.pmod(e, F.lit(360)).cast("double").alias("heading"),
        (F.col("event_type") == "error").alias("on_ground"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_ts"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a made-up probability that has many ties."""
    return table(spark, sf_dir, "lineitem").select(
        F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), F.col("l_discount") * 5 + F.col("l_tax") * 2)
        ).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias(LABEL),
        F.year("l_shipdate").alias("year"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One requested flight per order, with codes in lower case.

    Every twenty-seventh of the origins has no airport, so the fallbacks are reached.
    """
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("_ok"), F.lower("n_name").alias("_on"))
    customers = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.join(
        origin, F.pmod(F.col("o_orderkey"), F.lit(27)) == F.col("_ok"), "left"
    ).select(
        F.col("o_orderkey").alias("request_id"),
        F.coalesce("_on", F.lit("nowhere")).alias("origin"),
        F.lower("n_name").alias("dest"),
        F.lower("o_orderpriority").alias("carrier"),
        F.to_date("o_orderdate").alias("flight_date"),
        F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int").alias("dep_hour"),
    )
