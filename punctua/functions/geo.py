"""Positions on the globe."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from punctua.contract import US_BOX

EARTH_RADIUS_MILES = 3958.8


def in_box(lat: Column, lon: Column, box: tuple = US_BOX) -> Column:
    """Inside the box, borders included."""
    south, west, north, east = box
    return lat.between(south, north) & lon.between(west, east)


def cell(degrees: Column, size: float) -> Column:
    """Lower edge of the grid cell, rounding towards minus infinity."""
    return F.floor(degrees / F.lit(size)) * F.lit(size)


@dataclass(frozen=True)
class Grid:
    """Square cells of ``degrees`` on a side; with a box, only what lies inside it has a cell."""

    degrees: float
    box: tuple | None = None

    def index(self, c: Column) -> Column:
        return F.floor(c / F.lit(self.degrees))

    def reach(self, c: Column, radius: float) -> Column:
        """The cells of an axis that ``radius`` around ``c`` meets: (cell, whether it lies wholly inside).

        A thousandth of a cell at either end counts as outside, so rounding never makes a
        cell inside that is not; cells met by that margin alone are listed as well.
        """
        low, high, slack = c - F.lit(radius), c + F.lit(radius), self.degrees / 1000
        cells = F.sequence(self.index(low - slack), self.index(high + slack))
        return F.transform(
            cells,
            lambda k: F.struct(
                k.alias("cell"),
                ((k * self.degrees >= low + slack) & ((k + 1) * self.degrees <= high - slack)).alias("inside"),
            ),
        )

    def put(self, rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """``rows`` that have a cell, with its lower edges as ``cell_lat`` and ``cell_lon``."""
        edges = {f"cell_{axis}": cell(F.col(c), self.degrees) for axis, c in (("lat", lat), ("lon", lon))}
        placed = rows.withColumns(edges)
        return placed.where(in_box(F.col(lat), F.col(lon), self.box)) if self.box else placed


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    )
    return F.asin(F.sqrt(a)) * (2 * EARTH_RADIUS_MILES)


def congestion_level(nearby: Column) -> Column:
    return F.when(nearby >= 30, "high").when(nearby >= 10, "moderate").otherwise("low")
