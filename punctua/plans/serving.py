"""Documents, presets, option lists and request features built from the marts.

All inputs but the requests are aggregates: one row per route, airport or carrier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.contract import (
    CARRIER_NAMES,
    DEFAULT_DISTANCE_MILES,
    FEATURES,
    FORECAST_HORIZON_DAYS,
    FRESH_SECONDS,
    HOLIDAY_YEARS,
    PRESET_CARRIER,
    PRESET_HOUR,
    PRESET_WEEKDAY,
    REQUEST_WEATHER_FILL,
    WEATHER,
)
from punctua.functions.geo import haversine_miles
from punctua.functions.holidays import holiday_flag
from punctua.functions.scores import elapsed_estimate, round6
from punctua.functions.text import request_code
from punctua.functions.timeparts import day_part, hour_key, iso_weekday
from punctua.operators.history import rates_as_of
from punctua.operators.joins import named, readings_at_ends
from punctua.operators.keyed import first_by_key
from punctua.operators.ranking import top_rows
from punctua.sources.documents import forecast_at, forecast_in_reach


def carrier_names(spark: SparkSession) -> DataFrame:
    """Display names the contract knows."""
    return spark.createDataFrame(list(CARRIER_NAMES.items()), "code string, name string")


def carrier_options(carriers: DataFrame, names: DataFrame) -> DataFrame:
    """Carriers in use with a display name."""
    codes = carriers.select(F.col("carrier").alias("code")).distinct()
    return named(codes, names, "code")


def airport_options(dim: DataFrame) -> DataFrame:
    return dim.select("iata", "name", "lat", "lon").orderBy("iata")


def example_presets(routes: DataFrame, route_carriers: DataFrame, n: int = 4) -> DataFrame:
    """The busiest routes, each with its busiest carrier."""
    best = first_by_key(
        route_carriers.select("origin", "dest", "carrier", (-F.col("flights")).alias("_rank")),
        ["origin", "dest"],
        ["_rank", "carrier"],
    ).select("origin", "dest", "carrier")
    busiest = top_rows(routes, [F.col("flights").desc(), F.col("origin"), F.col("dest")], n)
    return busiest.join(best, ["origin", "dest"], "left").select(
        "origin",
        "dest",
        F.coalesce("carrier", F.lit(PRESET_CARRIER)).alias("carrier"),
        F.lit(PRESET_WEEKDAY).alias("day_of_week"),
        F.lit(PRESET_HOUR).alias("dep_hour"),
        "flights",
    )


def _listed(rows: DataFrame, keys: list[str], order: list[Column], entry: Column, out: str):
    """``entry`` structs per key in order; a key has at most a dimension's worth."""
    sortable = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], entry.alias("entry"))
    items = F.array_sort(F.collect_list(sortable))
    return rows.groupBy(*keys).agg(F.transform(items, lambda x: x["entry"]).alias(out))


def route_documents(routes: DataFrame, route_carriers: DataFrame) -> DataFrame:
    """One document per route: its rate, delay and the rates of its carriers."""
    by_carrier = _listed(
        route_carriers,
        ["origin", "dest"],
        [-F.col("flights"), F.col("carrier")],
        F.struct("carrier", round6(F.col("delay_rate")).alias("delay_rate")),
        "by_carrier",
    )
    return routes.join(by_carrier, ["origin", "dest"], "left").select(
        "origin",
        "dest",
        round6(F.col("delay_rate")).alias("delay_rate"),
        "flights",
        round6(F.col("avg_delay_min")).alias("avg_delay_min"),
        "by_carrier",
    )


def lookup(documents: DataFrame, **keys: str) -> DataFrame:
    """Rows with the given key values; codes are matched in upper case."""
    for column, value in keys.items():
        documents = documents.where(F.col(column) == value.upper())
    return documents


def airport_documents(
    dim: DataFrame, airports: DataFrame, hourly: DataFrame, worst: DataFrame, congestion: DataFrame
) -> DataFrame:
    """One document per airport: position, history and the traffic around it now."""
    by_hour = _listed(
        hourly,
        ["origin"],
        [F.col("hour")],
        F.struct("hour", round6(F.col("delay_rate")).alias("delay_rate")),
        "by_hour",
    )
    worst_routes = _listed(
        worst,
        ["origin"],
        [F.col("rnk")],
        F.struct("dest", round6(F.col("delay_rate")).alias("delay_rate")),
        "worst_routes",
    )
    history = (
        airports.select("origin", round6(F.col("overall_delay_rate")).alias("overall_delay_rate"))
        .join(by_hour, "origin", "left")
        .join(worst_routes, "origin", "left")
        .withColumnRenamed("origin", "iata")
    )
    live = congestion.select("iata", "aircraft_nearby", "level")
    empty = F.array()
    return (
        dim.join(history, "iata", "left")
        .join(live, "iata", "left")
        .select(
            "iata",
            "name",
            "lat",
            "lon",
            F.struct(
                "overall_delay_rate",
                F.coalesce("by_hour", empty).alias("by_hour"),
                F.coalesce("worst_routes", empty).alias("worst_routes"),
            ).alias("historical"),
            F.struct(
                F.coalesce("aircraft_nearby", F.lit(0).cast("bigint")).alias("aircraft_nearby"),
                F.coalesce("level", F.lit("low")).alias("level"),
            ).alias("live_congestion"),
        )
    )


def request_features(
    requests: DataFrame,
    dim: DataFrame,
    medians: DataFrame,
    routes: DataFrame | None,
    airports: DataFrame | None,
    carriers: DataFrame | None,
    base_rates: DataFrame,
    prior: Column,
    weather: DataFrame | None,
    holiday_years: tuple[int, int] = HOLIDAY_YEARS,
    hour: Column | None = None,
    as_of: DataFrame | None = None,
) -> DataFrame:
    """All model features for a table of requested flights.

    Requests have (request_id, origin, dest, carrier, flight_date, dep_hour).  A route
    without history falls back to the great-circle distance and then to a fixed one;
    rates fall back from the mart to the training base rate to the overall rate.

    With ``as_of``, the daily totals of ``history.entity_days``, the rates are those of the days
    before each request's own date instead of the marts', as the training rows have them, so
    that back-dated requests can be scored without looking ahead; the three marts may be None.
    Without ``weather`` every end has the default weather.
    """
    asked = requests.withColumns(
        {c: request_code(F.col(c)) for c in ("origin", "dest", "carrier")}
    )
    if as_of is not None:
        asked = rates_as_of(asked, as_of).withColumnsRenamed(
            {f"{e}_hist_delay_rate": f"_{e}" for e in ("route", "origin", "carrier")}
        )
    # What is known per route and per origin is put together first: these tables have a
    # row per route or airport, so the requests are joined with each kind only once.
    per_route = medians.join(base_rates.select("origin", "dest", "base_rate"), ["origin", "dest"], "full")
    spot = dim.select(
        F.col("iata").alias("origin"),
        F.col("lat").alias("_origin_lat"),
        F.col("lon").alias("_origin_lon"),
    )
    per_origin = spot
    if as_of is None:
        mean = round6(F.col("delay_rate"))
        per_route = per_route.join(routes.select("origin", "dest", mean.alias("_route")), ["origin", "dest"], "full")
        overall = round6(F.col("overall_delay_rate")).alias("_origin")
        per_origin = airports.select("origin", overall).join(spot, "origin", "full")
        asked = asked.join(carriers.select("carrier", mean.alias("_carrier")), "carrier", "left")
    per_dest = dim.select(
        F.col("iata").alias("dest"), F.col("lat").alias("_dest_lat"), F.col("lon").alias("_dest_lon")
    )
    rows = (
        asked.join(per_route, ["origin", "dest"], "left")
        .join(per_origin, "origin", "left")
        .join(per_dest, "dest", "left")
        .withColumn("baseline_probability", F.coalesce(F.col("base_rate"), prior))
    )
    great_circle = F.round(
        haversine_miles(
            F.col("_origin_lat"), F.col("_origin_lon"), F.col("_dest_lat"), F.col("_dest_lon")
        ),
        0,
    )
    day, at = F.col("flight_date"), F.col("dep_hour")
    rows = rows.withColumn(
        "distance",
        F.coalesce(
            round6(F.col("median_distance")), great_circle, F.lit(DEFAULT_DISTANCE_MILES)
        ),
    ).withColumns(
        {
            "crs_elapsed_time": F.coalesce(
                round6(F.col("median_crs_elapsed_time")), elapsed_estimate(F.col("distance"))
            ),
            "day_of_week": iso_weekday(day),
            "month": F.month(day),
            "time_of_day_bucket": day_part(at),
            "is_holiday_window": holiday_flag("flight_date", *holiday_years).cast("double"),
            "route_hist_delay_rate": F.coalesce("_route", "baseline_probability"),
            "origin_hist_delay_rate": F.coalesce(F.col("_origin"), prior),
            "carrier_hist_delay_rate": F.coalesce(F.col("_carrier"), prior),
            "weather_hour_key": hour_key(day, at) if hour is None else hour,
        }
    )
    if weather is None:
        rows = rows.withColumns({f"{end}_{n}": F.lit(v) for end in ("origin", "dest") for n, v in REQUEST_WEATHER_FILL.items()})
    else:
        rows = readings_at_ends(rows, weather, fill=REQUEST_WEATHER_FILL)
    return rows.select("request_id", "flight_date", *FEATURES, "baseline_probability")


def forecast_features(
    features: DataFrame,
    forecasts: DataFrame,
    today: Column,
    day: Column | None = None,
    horizon: int = FORECAST_HORIZON_DAYS,
    fill: dict[str, float] = REQUEST_WEATHER_FILL,
) -> DataFrame:
    """``features`` with the weather forecast at both ends, and ``weather_ok``.

    ``forecasts`` has one (iata, forecast) per airport (``documents.forecast_of``).  A day
    before ``today`` or more than ``horizon`` days after it has no forecast; there, and where
    hour or value are missing, the fill stays.  ``weather_ok`` says whether either end has any
    forecast value.  The documents become rows of an hour each, of which a request is joined
    with one at either end.
    """
    at = F.col("flight_date") if day is None else day
    names = {v: suffix for v, (suffix, _) in WEATHER.items()}
    rows, reach = features, forecast_in_reach(at, today, horizon)
    ends = {"origin": "_origin", "dest": "_dest"}
    for end, out in ends.items():
        rows = forecast_at(rows, forecasts, end, at, F.col("dep_hour").cast("int"), names, out, reach)
    known = [F.coalesce(*[F.col(f"_{end}.{n}") for n in fill]).isNotNull() for end in ("origin", "dest")]
    values = {f"{end}_{n}": F.coalesce(F.col(f"_{end}.{n}"), F.lit(v)) for end in ("origin", "dest") for n, v in fill.items()}
    return rows.withColumns({**values, "weather_ok": known[0] | known[1]}).drop(*ends.values())


def weather_summary(features: DataFrame) -> DataFrame:
    """Rounded weather of both ends of the flight as one struct."""
    def end(side: str) -> Column:
        return F.struct(
            F.round(f"{side}_temp_2m", 1).alias("temp_c"),
            F.round(f"{side}_precip", 2).alias("precip_mm"),
            F.round(f"{side}_wind_gusts", 1).alias("wind_gusts"),
        ).alias(side)

    return features.withColumn("weather_summary", F.struct(end("origin"), end("dest")))


def choose_snapshot(candidates: DataFrame, now: Column, keys: tuple[str, ...] = ("feed",)):
    """Best non-empty snapshot per feed: latest, then cached, then the bundled sample.

    ``candidates`` has (tier, as_of, count) with tier 1 to 3.  What is shown as live
    depends on its age alone, whichever tier it came from; a sample has no age.
    """
    best = first_by_key(candidates.where(F.col("count") > 0), list(keys), ["tier"])
    # No time at all means just taken; a zero is a clock that was never set.
    age = F.when(F.col("as_of").isNull(), F.lit(0)).when(
        F.col("as_of") != 0, F.greatest(F.lit(0), now - F.col("as_of"))
    )
    sample = F.col("tier") == 3
    return best.withColumns(
        {
            "stale_seconds": F.when(sample, 0).otherwise(F.coalesce(age, F.lit(0))).cast("bigint"),
            "source": F.when(sample, "sample")
            .when(age <= FRESH_SECONDS, "live")
            .otherwise("cached"),
        }
    )
