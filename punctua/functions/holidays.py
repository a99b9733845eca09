"""Observed US federal holidays, by rule."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

from punctua.contract import HOLIDAY_YEARS

# Fixed values: (month, day, first year) of holidays tied to a date ...
FIXED_DAYS = ((1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))
# ... and (month, weekday with Monday = 0, which one) of floating holidays.
FLOATING_DAYS = ((1, 0, 3), (2, 0, 3), (5, 0, -1), (9, 0, 1), (10, 0, 2), (11, 3, 4))
# Days flagged besides their observed day.
ALSO_OBSERVED = (date(2022, 1, 1),)


def _observed(day: date) -> date:
    """Saturday holidays are taken on Friday, Sunday holidays on Monday."""
    return day + timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def _floating(year: int, month: int, weekday: int, nth: int) -> date:
    if nth > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (nth - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


def federal_holidays(first: int = HOLIDAY_YEARS[0], last: int = HOLIDAY_YEARS[1]) -> list[date]:
    days = {d for d in ALSO_OBSERVED if first <= d.year <= last}
    for year in range(first, last + 1):
        days |= {_observed(date(year, m, d)) for m, d, since in FIXED_DAYS if year >= since}
        days |= {_floating(year, *rule) for rule in FLOATING_DAYS}
    return sorted(days)


def holiday_window_dates(
    first: int = HOLIDAY_YEARS[0], last: int = HOLIDAY_YEARS[1], days: int = 2
) -> list[date]:
    reach = range(-days, days + 1)
    return sorted({h + timedelta(days=k) for h in federal_holidays(first, last) for k in reach})


def holiday_flag(
    day: str, first: int = HOLIDAY_YEARS[0], last: int = HOLIDAY_YEARS[1], days: int = 2
) -> Column:
    """1 when the date column ``day`` lies within ``days`` of an observed holiday, else 0.

    About fifty dates a year: a literal set that compiles to one hash probe per row,
    with no join and nothing to ship but the plan itself.  Written as one SQL
    expression because hundreds of literal columns are slow to build from Python.
    """
    dates = ", ".join(f"DATE'{d}'" for d in holiday_window_dates(first, last, days))
    return F.expr(f"CASE WHEN `{day}` IN ({dates}) THEN 1 ELSE 0 END")
