"""Joins of facts with dimensions, hourly tables and nearby positions.

None of them forces a broadcast.  Catalyst broadcasts a side whose size it knows to
be under ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join shuffles and
adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from punctua.contract import NEARBY_DEGREES, WEATHER, WEATHER_FILL
from punctua.functions.geo import Grid, congestion_level


def keep_known(facts: DataFrame, dim: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Facts whose every listed column holds a key of ``dim`` (semi joins)."""
    for i, column in enumerate(columns):
        alias = f"_known_{i}"
        facts = facts.join(
            dim.select(F.col(key).alias(alias)), F.col(column) == F.col(alias), "left_semi"
        )
    return facts


def days_of_readings(hourly: DataFrame, key: str = "weather_hour_key") -> DataFrame:
    """``(place, day, readings)``: the hours of one place and day as one list.

    A twenty-fourth of the rows of ``hourly``, so a join with it compares and ships fewer
    keys, and more often fits a broadcast.  Readings are doubles by their short names.
    """
    reading = F.struct(
        (F.col(key) % 100).alias("hour"),
        *[F.col(v).cast("double").alias(suffix) for v, (suffix, _) in WEATHER.items()],
    )
    return hourly.groupBy(
        F.col("iata").alias("place"), F.expr(f"{key} div 100").alias("day")
    ).agg(F.collect_list(reading).alias("readings"))


def readings_at_ends(
    trips: DataFrame,
    hourly: DataFrame,
    ends: Sequence[str] = ("origin", "dest"),
    key: str = "weather_hour_key",
    fill: dict[str, float] = WEATHER_FILL,
) -> DataFrame:
    """What was read at every end of a trip in the hour of ``key``, as ``{end}_{name}`` columns.

    An hour or a value that is not known gives the ``fill`` of its name.
    """
    days = days_of_readings(hourly, key)
    for end in ends:
        own = days.select(*[F.col(c).alias(f"_{end}_{c}") for c in days.columns])
        same = (F.col(end) == F.col(f"_{end}_place")) & (F.expr(f"{key} div 100") == F.col(f"_{end}_day"))
        trips = trips.join(own, same, "left").drop(f"_{end}_place", f"_{end}_day")
    then = {
        f"_{end}_now": F.get(F.filter(f"_{end}_readings", lambda r: r["hour"] == F.col(key) % 100), F.lit(0))
        for end in ends
    }
    values = {f"{end}_{name}": F.coalesce(F.col(f"_{end}_now.{name}"), F.lit(value)) for end in ends for name, value in fill.items()}
    return trips.withColumns(then).withColumns(values).drop(*then, *[f"_{end}_readings" for end in ends])


def key_volume(facts: DataFrame, columns: Sequence[str], out: str = "flights") -> DataFrame:
    """How often each value occurs over all the listed columns together."""
    values = facts.select(F.explode(F.array(*columns)).alias("iata"))
    return values.where(F.col("iata").isNotNull()).groupBy("iata").agg(F.count("*").alias(out))


def airports_in_use(facts: DataFrame | None, dim: DataFrame, top_n: int | None = None) -> DataFrame:
    """Dimension rows used as origin or destination, busiest first when limited.

    Without any facts the whole dimension counts as in use.
    """
    if facts is None:
        return dim
    volume = key_volume(facts, ["origin", "dest"])
    used = dim.join(volume, "iata", "inner")
    nothing = facts.limit(1).agg(F.count("*").alias("n")).scalar()
    everything = dim.where(nothing == 0).withColumn("flights", F.lit(0).cast("bigint"))
    scoped = used.unionByName(everything)
    if top_n is not None:
        scoped = scoped.orderBy(F.col("flights").desc(), "iata").limit(top_n)
    return scoped


def named(rows: DataFrame, names: DataFrame, code: str, name: str = "name") -> DataFrame:
    """Display name from a (code, name) dimension, the code itself where unknown."""
    found = names.select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (
        rows.join(found, F.col(code) == F.col("_code"), "left")
        .withColumn(name, F.coalesce("_name", code))
        .drop("_code", "_name")
    )


def nearby_counts(
    places: DataFrame,
    positions: DataFrame,
    radius: float = NEARBY_DEGREES,
    key: str = "iata",
    parts: int = 4,
) -> DataFrame:
    """Positions within ``radius`` degrees on both axes of every place.

    A range join made equality joins on a grid of ``parts`` cells to the radius.  Cells
    wholly inside a place's reach add their number of positions, counted before the join,
    so a crowded cell costs one row; only cells on the border meet positions, equal ones
    counted together, under the exact test.  Places without any position stay with zero;
    places or positions without both coordinates count nothing.
    """
    grid, cell = Grid(radius / parts), ["_row", "_col"]
    known = [~F.isnan(c) & F.col(c).isNotNull() for c in ("lat", "lon")]
    spots = (
        positions.where(known[0] & known[1])
        .groupBy(grid.index(F.col("lat")).alias("_row"), grid.index(F.col("lon")).alias("_col"), "lat", "lon")
        .agg(F.count("*").alias("_n"))
    )
    near = (
        places.where(known[0] & known[1])
        .select(key, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.explode(grid.reach(F.col("lat"), radius)).alias("_row"))
        .select("*", F.explode(grid.reach(F.col("_lon"), radius)).alias("_col"))
        .select(
            key, "_lat", "_lon", F.col("_row.cell").alias("_row"), F.col("_col.cell").alias("_col"),
            (F.col("_row.inside") & F.col("_col.inside")).alias("_inside"),
        )
    )
    crowds = spots.groupBy(*cell).agg(F.sum("_n").alias("_n"))
    inner = near.where("_inside").join(crowds, cell).select(key, "_n")
    border = near.where("not _inside").join(spots, cell).where(
        (F.abs(F.col("lat") - F.col("_lat")) <= radius) & (F.abs(F.col("lon") - F.col("_lon")) <= radius)
    )
    counts = inner.unionByName(border.select(key, "_n")).groupBy(key).agg(F.sum("_n").alias("aircraft_nearby"))
    nearby = F.coalesce("aircraft_nearby", F.lit(0).cast("bigint"))
    return places.join(counts, key, "left").withColumns(
        {"aircraft_nearby": nearby, "level": congestion_level(nearby)}
    )
