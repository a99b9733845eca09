"""Silver to gold: the feature table a model is trained on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from punctua.contract import BANNED_RAW, GOLD_COLUMNS, HISTORY, WEATHER_FILL
from punctua.functions.text import snake_name
from punctua.functions.timeparts import hour_key_of
from punctua.operators.history import with_history
from punctua.operators.joins import readings_at_ends


HISTORY_COLUMNS = tuple(HISTORY)


def gold_features(
    flights: DataFrame,
    weather: DataFrame,
    hour: Column | None = None,
    fill: dict[str, float] = WEATHER_FILL,
    prior_years: tuple[int, ...] | None = None,
) -> DataFrame:
    """Features known before departure, the label and the identity columns.

    ``hour`` is the weather hour key of a flight.  The default takes the scheduled
    departure hour as if it were UTC for both ends of the flight; pass
    ``hour_key_utc`` over a zone column to shift it.
    """
    key = hour_key_of(F.col("flight_ts")) if hour is None else hour
    rows = with_history(flights, prior_years=prior_years).withColumn("weather_hour_key", key)
    rows = readings_at_ends(rows, weather, fill=fill)
    return assert_contract(rows.select(*GOLD_COLUMNS), GOLD_COLUMNS)


def assert_contract(
    df: DataFrame, expected: Iterable[str], banned: Iterable[str] = BANNED_RAW
) -> DataFrame:
    """Exactly the expected columns and none that is known only after the fact."""
    want, have = set(expected), set(df.columns)
    if want != have:
        raise AssertionError(
            f"columns differ from the contract: missing {sorted(want - have)}, "
            f"unexpected {sorted(have - want)}"
        )
    leaked = have & {snake_name(b) for b in banned}
    if leaked:
        raise AssertionError(f"columns known only after departure: {sorted(leaked)}")
    return df
