"""String keys and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def clean_callsign(raw: Column) -> Column:
    return F.nullif(F.trim(raw), F.lit(""))


def route_key(origin: Column, dest: Column) -> Column:
    return F.concat_ws("|", origin, dest)


def cell_key(lat: Column, lon: Column) -> Column:
    return F.concat_ws(":", lat.cast("string"), lon.cast("string"))


def request_code(raw: Column) -> Column:
    return F.upper(raw)


_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+")


def snake_name(raw: str) -> str:
    """Column name in snake case: ``CRSElapsedTime`` becomes ``crs_elapsed_time``."""
    return "_".join(_WORDS.findall(raw)).lower()
