"""JSON documents in, rows out; and rows back into keyed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from punctua.contract import (
    AIRCRAFT_FIELDS,
    MESSAGE_FIELDS,
    STATE_SLOTS,
    WEATHER_VARS,
)
from punctua.functions.text import clean_callsign

HOURLY_SCHEMA = (
    "hourly struct<time: array<string>, "
    + ", ".join(f"{v}: array<double>" for v in WEATHER_VARS)
    + ">"
)
STATES_SCHEMA = "time bigint, states array<array<string>>"


def parse_hourly_weather(
    docs: DataFrame, doc: str = "doc", keys: tuple[str, ...] = ("iata",)
) -> DataFrame:
    """One row per hour from a document of parallel arrays.

    A series that is missing or short gives nulls; an unreadable document gives no
    rows.
    """
    parsed = docs.select(*keys, F.from_json(doc, HOURLY_SCHEMA)["hourly"].alias("h"))
    hours = parsed.select(
        *keys, F.col("h"), F.posexplode(F.col("h")["time"]).alias("i", "stamp")
    )
    return hours.select(
        *keys,
        F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd'T'HH:mm")).alias("time"),
        *[F.get(F.col("h")[v], F.col("i")).alias(v) for v in WEATHER_VARS],
    )


def state_fields(state: Column) -> list[Column]:
    """Typed aircraft fields from one positional state vector."""
    slot = {
        name: F.get(state, F.lit(k)).try_cast(kind) for k, (name, kind) in STATE_SLOTS.items()
    }
    slot["callsign"] = clean_callsign(slot["callsign"])
    slot["altitude"] = F.coalesce(slot["geo_altitude"], slot["baro_altitude"])
    slot["on_ground"] = F.coalesce(slot["on_ground"], F.lit(False))
    return [slot[name].alias(name) for name in AIRCRAFT_FIELDS]


def parse_state_vectors(
    docs: DataFrame, doc: str = "doc", keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row per aircraft of a snapshot document; entries without a position drop."""
    parsed = docs.select(*keys, F.from_json(doc, STATES_SCHEMA).alias("d"))
    states = parsed.select(
        *keys, F.col("d.time").alias("snapshot_time"), F.explode("d.states").alias("s")
    )
    rows = states.select(*keys, "snapshot_time", *state_fields(F.col("s")))
    return rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def event_messages(positions: DataFrame) -> DataFrame:
    """``key``/``value`` messages with exactly the contract fields, nulls kept.

    The key is the aircraft id, so that a broker keeps each aircraft in order; rows
    without an id cannot be keyed and are left out.
    """
    value = F.to_json(F.struct(*MESSAGE_FIELDS), {"ignoreNullFields": "false"})
    keyed = positions.where(F.col("icao24").isNotNull() & (F.col("icao24") != ""))
    return keyed.select(F.col("icao24").alias("key"), value.alias("value"))


def snapshot_payload(
    snapshots: DataFrame,
    now: Column,
    as_of: str = "as_of",
    aircraft: str = "aircraft",
    source: str = "live",
) -> DataFrame:
    """Snapshot rows with an aircraft array to the published payload.

    Entries are cut down to the contract fields inside the array; the count and the
    age are derived.  A snapshot without a time, or with time 0, counts as taken now.
    """
    entries = F.coalesce(F.col(aircraft), F.array())
    taken = F.coalesce(F.nullif(F.col(as_of), F.lit(0)), now).cast("bigint")
    trimmed = F.transform(
        entries, lambda a: F.struct(*[a[f].alias(f) for f in AIRCRAFT_FIELDS])
    )
    others = [c for c in snapshots.columns if c not in (as_of, aircraft)]
    return snapshots.select(
        *others,
        taken.alias("as_of"),
        F.greatest(F.lit(0), now - taken).cast("bigint").alias("stale_seconds"),
        F.lit(source).alias("source"),
        F.size(entries).alias("count"),
        trimmed.alias("aircraft"),
    )


def forecast_in_reach(day: Column, today: Column, horizon: int) -> Column:
    """Whether a forecast exists for ``day``: not past and not beyond the horizon."""
    return F.datediff(day, today).between(0, horizon)


def forecast_of(docs: DataFrame, doc: str = "doc", keys: tuple[str, ...] = ("iata",)) -> DataFrame:
    """``(*keys, forecast)``: each document's parallel arrays, read once; null if unreadable."""
    return docs.select(*keys, F.from_json(doc, HOURLY_SCHEMA)["hourly"].alias("forecast"))


def forecast_hours(docs: DataFrame, names: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """``(*keys, _hour, _values)``: every hour that a document lists, at its first place in the list of times.

    ``names`` maps variables to the fields of ``_values``; short or missing series give nulls.
    """
    hours = docs.select(*keys, "forecast", F.posexplode("forecast.time").alias("_place", "_stamp"))
    values = F.struct(*[F.get(F.col("forecast")[v], F.col("_place")).alias(name) for v, name in names.items()])
    return (
        hours.where(F.col("_stamp").isNotNull())
        .select(*keys, F.left("_stamp", F.lit(16)).alias("_hour"), "_place", values.alias("_values"))
        .groupBy(*keys, "_hour")
        .agg(F.min_by("_values", "_place").alias("_values"))
    )


def forecast_at(
    rows: DataFrame, forecasts: DataFrame, place: str, day: Column, hour: Column, names: dict[str, str], out: str, known: Column
) -> DataFrame:
    """``rows`` with one hour of the forecast of their ``place`` as the struct ``out``.

    ``forecasts`` has (iata, forecast).  Documents become rows of an hour each, so that a row meets
    five numbers by an equality join instead of carrying arrays and searching them.  Null where
    ``known`` does not hold or the hour is not listed.  A place with several documents gives a
    row for each, as a join with the documents does.
    """
    lists = forecasts.groupBy("iata").agg(F.collect_list(F.struct("forecast")).alias("_docs"))
    numbered = lists.select(F.col("iata").alias("_iata"), F.posexplode("_docs").alias("_nth", "_doc"))
    hours = forecast_hours(numbered.select("_iata", "_nth", "_doc.forecast"), names, ["_iata", "_nth"]).select(
        F.col("_iata").alias("_at"), F.col("_nth").alias("_of"), "_hour", F.col("_values").alias(out)
    )
    wanted = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
    rows = rows.withColumn("_wanted", F.when(known, wanted)).join(
        numbered.select("_iata", "_nth"), F.col(place) == F.col("_iata"), "left"
    )
    same = (F.col("_iata") == F.col("_at")) & (F.col("_nth") == F.col("_of")) & (F.col("_wanted") == F.col("_hour"))
    return rows.join(hours, same, "left").drop("_wanted", "_iata", "_nth", "_at", "_of", "_hour")
